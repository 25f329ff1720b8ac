"""The entity registry: schemas, keys and table settings, in one place.

Every operator takes an ``Entity`` rather than loose schemas and key names, so a
new table is one more entry here.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

STRING, INT, FLOAT, DOUBLE = StringType(), IntegerType(), FloatType(), DoubleType()

# A change message carries the new row image as JSON text (or a JSON object)
# under payload.after; nothing else in the message is read.
ENVELOPE = StructType([StructField("payload", StructType([StructField("after", STRING)]))])

DATE_COLUMN = "date"


@dataclass(frozen=True)
class Entity:
    """One change-captured table.

    ``columns`` is the decoded row in order, all nullable. ``metrics`` and
    ``times`` mark the roles columns play in the serving table; every other
    column is a dimension unless it is listed in ``unserved``.
    """

    name: str
    key: str
    columns: Mapping[str, DataType]
    metrics: tuple[str, ...] = ()
    times: tuple[str, ...] = ("last_modified_ts",)
    unserved: tuple[str, ...] = ()
    modified_at: str = "last_modified_ts"
    retention_days: int | None = None
    bloom: tuple[str, ...] = ()
    sorted_by: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType([StructField(name, kind) for name, kind in self.columns.items()])

    @property
    def dated_schema(self) -> StructType:
        """The decoded row followed by its derived date."""
        return self.schema.add(StructField(DATE_COLUMN, DateType()))

    @property
    def dimensions(self) -> tuple[str, ...]:
        other = {*self.metrics, *self.times, *self.unserved}
        return tuple(name for name in self.columns if name not in other)

    @property
    def serving_schema(self) -> StructType:
        """Dimensions, metrics, then time columns; the date is served as text."""
        names = (*self.dimensions, *self.metrics, *self.times)
        fields = [StructField(name, self.columns[name]) for name in names]
        return StructType([*fields, StructField(DATE_COLUMN, STRING)])

    def only(self, *names: str) -> Entity:
        """The same entity read through fewer columns.

        The key and the modification time always stay: routing needs the first
        and newest-wins needs the second.
        """
        keep = {self.key, self.modified_at, *names}
        unknown = keep - set(self.columns)
        if unknown:
            raise ValueError(f"{self.name} has no columns {sorted(unknown)}")

        def kept(group: tuple[str, ...]) -> tuple[str, ...]:
            return tuple(name for name in group if name in keep)

        return replace(
            self,
            columns={name: kind for name, kind in self.columns.items() if name in keep},
            metrics=kept(self.metrics),
            times=kept(self.times),
            unserved=kept(self.unserved),
            bloom=kept(self.bloom),
            sorted_by=kept(self.sorted_by),
        )


# Column names, order and types, keys, serving roles and retention
# are the data contract with producers and with readers of the tables.
TRANSACTIONS = Entity(
    name="transactions",
    key="transaction_id",
    columns={
        "transaction_id": STRING,
        "user_id": STRING,
        "product_id": STRING,
        "payment_id": STRING,
        "shipping_id": STRING,
        "quantity": INT,
        "discount": INT,
        "last_modified_ts": STRING,
        "status": STRING,
    },
    metrics=("quantity", "discount"),
    retention_days=3,
    bloom=("transaction_id", "user_id"),
    sorted_by=("last_modified_ts",),
)

USERS = Entity(
    name="users",
    key="user_id",
    columns={
        "user_id": STRING,
        "full_name": STRING,
        "phone_number": STRING,
        "sex": STRING,
        "address": STRING,
        "birthdate": STRING,
        "email": STRING,
        "job": STRING,
        "last_modified_ts": STRING,
        "status": STRING,
    },
    times=("birthdate", "last_modified_ts"),
    bloom=("user_id",),
)

PRODUCTS = Entity(
    name="products",
    key="product_id",
    columns={
        "product_id": STRING,
        "product_name": STRING,
        "category": STRING,
        "unit_price": FLOAT,
        "merchant_name": STRING,
        "rating": FLOAT,
        "last_modified_ts": STRING,
        "status": STRING,
    },
    metrics=("unit_price", "rating"),
    bloom=("product_id",),
)

PAYMENTS = Entity(
    name="payments",
    key="payment_id",
    columns={
        "payment_id": STRING,
        "payment_method": STRING,
        "currency": STRING,
        "last_modified_ts": STRING,
        "status": STRING,
    },
    bloom=("payment_id",),
)

SHIPPINGS = Entity(
    name="shippings",
    key="shipping_id",
    columns={
        "shipping_id": STRING,
        "shipping_address": STRING,
        "shipping_cost": FLOAT,
        "shipping_status": STRING,
        "status": STRING,
        "last_modified_ts": STRING,
    },
    metrics=("shipping_cost",),
    unserved=("shipping_status",),
    retention_days=3,
    bloom=("shipping_id",),
)

ENTITIES = {e.name: e for e in (USERS, PRODUCTS, PAYMENTS, TRANSACTIONS, SHIPPINGS)}
