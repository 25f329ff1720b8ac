"""Query shapes over latest-state tables, and their registration for SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.entities import DATE_COLUMN, TRANSACTIONS
from changeloom.operators.join import heavy_keys, lookup
from changeloom.sources.fileindex import FileIndex


def pushed_filters(table: DataFrame) -> str:
    """The filters that reach the scan, as the physical plan names them."""
    plan = table._jdf.queryExecution().sparkPlan().toString()
    return " ".join(part.split("]")[0] for part in plan.split("PushedFilters: [")[1:])


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose tables to ``spark.sql`` under their entity names."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def find(table: DataFrame, **equals: object) -> DataFrame:
    """Rows whose columns equal the given values, or one of a list of values.

    Plain equality reaches the scan as a pushed filter, where bloom filters and
    statistics skip files.
    """
    for name, wanted in equals.items():
        several = isinstance(wanted, (list, tuple, set))
        table = table.filter(F.col(name).isin(*wanted) if several else F.col(name) == wanted)
    return table


def recent(
    table: DataFrame, time: str, start: str, end: str, limit: int, tie_break: str
) -> DataFrame:
    """The newest ``limit`` rows with ``start <= time <= end``.

    Each task keeps its own newest ``limit`` rows, so only those are gathered.
    """
    return (
        table.filter(F.col(time).between(start, end))
        .orderBy(F.col(time).desc(), F.col(tie_break).desc())
        .limit(limit)
    )


def find_indexed(index: FileIndex, **equals: object) -> DataFrame:
    """``find`` that opens only the files which can hold a wanted row."""
    return find(index.read(index.candidates(**equals)), **equals)


def recent_indexed(
    index: FileIndex, time: str, start: str, end: str, limit: int, tie_break: str
) -> DataFrame:
    """``recent`` that opens only the files which can hold one of the newest rows."""
    return recent(index.read(index.newest(time, start, end, limit)), time, start, end, limit, tie_break)


def roll_up(
    table: DataFrame, by: Sequence[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Aggregates per combination of dimensions, combined in each task before the shuffle."""
    return table.groupBy(*by).agg(*(measure.alias(name) for name, measure in measures.items()))


def daily(table: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    return roll_up(table, [DATE_COLUMN], measures)


def cents(amount: str) -> Column:
    """A 32-bit amount as whole cents, so that sums do not depend on their order."""
    return F.round(F.col(amount).cast("double") * 100).cast("bigint")


def revenue() -> Column:
    """Price times quantity less the discount in percent, in hundredths of a cent."""
    return cents("unit_price") * F.col("quantity") * (100 - F.col("discount"))


STAR = {
    "products": ("product_id", ("category", "unit_price")),
    "payments": ("payment_id", ("payment_method", "currency")),
    "users": ("user_id", ("job", "address")),
    "shippings": ("shipping_id", ("shipping_cost", "shipping_status")),
}


# Dimensions with one transaction per row have no heavy keys.
ONE_TO_ONE = ("shippings",)


def star(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Transactions with their product, payment, user and shipping, where known.

    The transactions are read twice, once for their heavy keys: pass a stored table.
    Dimensions have one row per key, so the heavy keys found there hold for every join.
    """
    facts = tables["transactions"]
    heavy = heavy_keys(facts, *(key for name, (key, _) in STAR.items() if name not in ONE_TO_ONE))
    # One-to-one dimensions first: stored in the same buckets as the facts, they need no exchange.
    for name, (key, wanted) in sorted(STAR.items(), key=lambda entry: entry[0] not in ONE_TO_ONE):
        dimension = tables[name].select(key, *wanted)
        facts = lookup(facts, dimension, key, heavy.get(key, ()), [TRANSACTIONS.key])
    return facts


def star_revenue(tables: Mapping[str, DataFrame], by: Sequence[str]) -> DataFrame:
    return roll_up(
        star(tables),
        by,
        {
            "orders": F.count(F.lit(1)),
            "units": F.sum("quantity"),
            "revenue": F.sum(revenue()),
            "shipping_cents": F.sum(cents("shipping_cost")),
        },
    )
