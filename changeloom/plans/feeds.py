"""Change feeds derived from the relational tables.

Each entity's rows are computed from the given tables, wrapped as change
envelopes and, for the large entities, damaged in known ways, so that the
decode path can be checked against plain SQL over the same tables.
``off`` stands for the position in the change log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.entities import (
    DOUBLE,
    PAYMENTS,
    PRODUCTS,
    SHIPPINGS,
    STRING,
    TRANSACTIONS,
    USERS,
    Entity,
)
from changeloom.functions.columns import evaluated_once
from changeloom.sources.files import read_table, stream_table
from changeloom.sources.filesystem import stamp

EVENTS = Entity(
    name="events",
    key="event_id",
    columns={
        "event_id": STRING,
        "user_id": STRING,
        "event_type": STRING,
        "value": DOUBLE,
        "last_modified_ts": STRING,
    },
    metrics=("value",),
)

# One in twenty messages each: no row image, no key, cut-off row image,
# unreadable envelope, no message at all.
FAULTS = ("delete", "keyless", "truncated", "unreadable", "tombstone")
FAULT_CYCLE = 20
TRUNCATED_LENGTH = 20


@dataclass(frozen=True)
class Feed:
    """Entity rows in source form: the entity's columns, ``off``, and ``fault``."""

    entity: Entity
    rows: DataFrame

    @property
    def raw(self) -> DataFrame:
        """The rows as change messages: ``(value, off)``.

        Made in a step of its own: ``from_json`` runs outside generated code, and would
        interpret the making of a message for each row if that were its argument.
        """
        columns = list(self.entity.columns)
        image = F.to_json(F.struct(*columns))
        keyless = F.to_json(F.struct(*(name for name in columns if name != self.entity.key)))
        after = (
            F.when(_fault("delete"), F.lit(None))
            .when(_fault("keyless"), keyless)
            .when(_fault("truncated"), F.substring(image, 1, TRUNCATED_LENGTH))
            .otherwise(image)
        )
        message = F.to_json(F.struct(F.struct(after.alias("after")).alias("payload")))
        value = (
            F.when(_fault("unreadable"), F.lit('{"payload":'))
            .when(_fault("tombstone"), F.lit(None))
            .otherwise(message)
        )
        return evaluated_once(self.rows, "value", value, "off").select("value", "off")


def _fault(kind: str) -> Column:
    return F.col("fault") == FAULTS.index(kind)


def _text(timestamp: str) -> Column:
    """A zoneless timestamp as text with six fraction digits, in any session zone."""
    text = F.col(timestamp).cast("string")
    whole = F.length(text) == len("2024-01-01 00:00:00")
    return F.rpad(
        F.when(whole, F.concat(text, F.lit("."))).otherwise(text),
        len("2024-01-01 00:00:00.000000"),
        "0",
    )


def _versions(rows: DataFrame, key: str) -> DataFrame:
    """Every row once, and every tenth a second time as a later version.

    Dealt out first: the tables are small files, of which one task would make and decode
    all messages.
    """
    rows = rows.repartition(key)
    numbers = F.when(F.col(key) % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return rows.withColumn("version", F.explode(numbers)).withColumns(
        {
            "last_modified_ts": F.when(
                F.col("version") == 2, "2024-01-02 00:00:00.000000"
            ).otherwise("2024-01-01 00:00:00.000000"),
            "status": F.when(F.col("version") == 2, "UPDATE").otherwise("INSERT"),
            "off": F.col("version").cast("bigint"),
            "fault": F.lit(len(FAULTS)),
        }
    )


def _line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def _line_position() -> dict[str, Column]:
    return {
        "off": F.col("l_partkey") * 1_000_000 + F.col("l_suppkey"),
        "fault": F.col("l_partkey") % FAULT_CYCLE,
    }


def _as_entity(rows: DataFrame, entity: Entity, **columns: Column) -> Feed:
    typed = [columns[name].cast(kind).alias(name) for name, kind in entity.columns.items()]
    return Feed(
        entity,
        rows.select(*typed, columns["off"].alias("off"), columns["fault"].alias("fault")),
    )


def transactions(spark: SparkSession, folder: str) -> Feed:
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders")
    return _as_entity(
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]),
        TRANSACTIONS,
        transaction_id=_line_id(),
        user_id=F.col("o_custkey"),
        product_id=F.col("l_partkey"),
        payment_id=F.col("o_orderpriority"),
        shipping_id=_line_id(),
        quantity=F.col("l_quantity"),
        discount=F.round(F.col("l_discount") * 100),
        last_modified_ts=_text("l_shipdate"),
        status=F.lit("INSERT"),
        **_line_position(),
    )


def shippings(spark: SparkSession, folder: str) -> Feed:
    return _as_entity(
        read_table(spark, folder, "lineitem"),
        SHIPPINGS,
        shipping_id=_line_id(),
        shipping_address=F.concat(F.lit("ADDR-"), F.col("l_suppkey").cast("string")),
        shipping_cost=F.round(F.col("l_tax") * 100),
        shipping_status=F.when(F.col("l_returnflag") == "A", "Delivered")
        .when(F.col("l_returnflag") == "N", "In-Transit")
        .otherwise("Delay"),
        status=F.lit("INSERT"),
        last_modified_ts=_text("l_shipdate"),
        **_line_position(),
    )


def products(spark: SparkSession, folder: str) -> Feed:
    return _as_entity(
        _versions(read_table(spark, folder, "part"), "p_partkey"),
        PRODUCTS,
        product_id=F.col("p_partkey"),
        product_name=F.col("p_name"),
        category=F.col("p_type"),
        unit_price=F.col("p_retailprice") + F.col("version") - 1,
        merchant_name=F.col("p_brand"),
        rating=F.col("p_size") / F.lit(10.0),
        last_modified_ts=F.col("last_modified_ts"),
        status=F.col("status"),
        off=F.col("off"),
        fault=F.col("fault"),
    )


def users(spark: SparkSession, folder: str) -> Feed:
    customers = read_table(spark, folder, "customer")
    nations = read_table(spark, folder, "nation")
    missing = F.lit(None)
    return _as_entity(
        _versions(
            customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"]),
            "c_custkey",
        ),
        USERS,
        user_id=F.col("c_custkey"),
        full_name=F.col("c_name"),
        phone_number=missing,
        sex=missing,
        address=F.col("n_name"),
        birthdate=missing,
        email=F.concat(F.col("c_custkey").cast("string"), F.lit("@example.com")),
        job=F.when(F.col("version") == 2, "RETIRED").otherwise(F.col("c_mktsegment")),
        last_modified_ts=F.col("last_modified_ts"),
        status=F.col("status"),
        off=F.col("off"),
        fault=F.col("fault"),
    )


def payments(spark: SparkSession, folder: str) -> Feed:
    methods = read_table(spark, folder, "orders").select("o_orderpriority").distinct()
    return _as_entity(
        methods,
        PAYMENTS,
        payment_id=F.col("o_orderpriority"),
        payment_method=F.col("o_orderpriority"),
        currency=F.lit("USD"),
        last_modified_ts=F.lit("2024-01-01 00:00:00.000000"),
        status=F.lit("INSERT"),
        off=F.lit(0).cast("bigint"),
        fault=F.lit(len(FAULTS)),
    )


def _events(table: DataFrame) -> Feed:
    return _as_entity(
        table,
        EVENTS,
        event_id=F.col("event_id"),
        user_id=F.col("user_id"),
        event_type=F.col("event_type"),
        value=F.col("value"),
        last_modified_ts=_text("ts"),
        off=F.col("event_id"),
        fault=F.col("event_id") % FAULT_CYCLE,
    )


def events(spark: SparkSession, folder: str) -> Feed:
    return _events(read_table(spark, folder, "events"))


def event_stream(spark: SparkSession, folder: str) -> Feed:
    return _events(stream_table(spark, folder, "events"))


#: The tables that the feeds are computed from.
SOURCES = ("lineitem", "orders", "part", "customer", "nation")


def signature(spark: SparkSession, folder: str) -> tuple:
    """Sizes and times of the source tables: another one whenever their files change."""
    return tuple(stamp(spark, f"{folder}/{name}.parquet") for name in SOURCES)


FEEDS = {
    "users": users,
    "products": products,
    "payments": payments,
    "transactions": transactions,
    "shippings": shippings,
}
