import datetime
import json

import pytest

from changeloom.functions import change_order, with_date
from changeloom.operators import (
    from_key_value,
    null_defaults,
    serving_projection,
    serving_table,
    to_key_value,
)
from changeloom.entities import PRODUCTS, SHIPPINGS, TRANSACTIONS, USERS


@pytest.mark.parametrize(
    ("text", "day"),
    [
        ("2024-01-15 10:30:45.123456", datetime.date(2024, 1, 15)),
        ("2024-02-29 23:59:59.999999", datetime.date(2024, 2, 29)),
        ("not-a-timestamp", None),
        ("2023-02-29 00:00:00.000000", None),
        ("2024-01-15 10:30:45", None),
        ("2024-01-15", None),
        ("", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_date(spark, text, day, ansi):
    df = spark.createDataFrame([(text,)], "last_modified_ts STRING")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert with_date(df).first()["date"] == day
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_date_of_another_column_and_pattern(spark):
    df = spark.createDataFrame([("15/01/2024",)], "day STRING")
    assert with_date(df, "day", "dd/MM/yyyy").first()["date"] == datetime.date(2024, 1, 15)


def test_change_order_reads_time_not_text(spark):
    # As text, the whole second sorts before its own fraction and "9" after "10".
    texts = ["2024-01-15 10:30:45.5", "2024-01-15 10:30:45", "bad", "2024-01-15 10:30:44.999999"]
    df = spark.createDataFrame([(t,) for t in texts], "last_modified_ts STRING")
    ordered = df.orderBy(*change_order()).collect()
    assert [row[0] for row in ordered] == [
        "bad", "2024-01-15 10:30:44.999999", "2024-01-15 10:30:45", "2024-01-15 10:30:45.5",
    ]


def test_key_value(spark):
    df = spark.createDataFrame([(7, "Ada", None)], "user_id INT, full_name STRING, job STRING")
    records = to_key_value(df, "user_id")
    assert records.columns == ["key", "value"]
    row = records.first()
    assert row["key"] == "7"
    assert json.loads(row["value"]) == {"user_id": 7, "full_name": "Ada"}


def test_key_value_round_trip_to_serving_columns(spark):
    row = ("p1", "ring", "GOLD", 10.5, "m", 4.5, "2024-01-15 10:30:45.123456", "INSERT")
    df = with_date(spark.createDataFrame([row], PRODUCTS.schema))
    served = from_key_value(to_key_value(df, "product_id"), PRODUCTS)
    assert served.schema == PRODUCTS.serving_schema
    assert served.first().asDict() == {
        "product_id": "p1", "product_name": "ring", "category": "GOLD", "merchant_name": "m",
        "status": "INSERT", "unit_price": 10.5, "rating": 4.5,
        "last_modified_ts": "2024-01-15 10:30:45.123456", "date": "2024-01-15",
    }
    assert serving_projection(df, PRODUCTS).first() == served.first()


def test_shipping_status_is_not_served(spark):
    row = ("s1", "x", 1.0, "Delay", "INSERT", "2024-01-15 10:30:45.123456")
    df = with_date(spark.createDataFrame([row], SHIPPINGS.schema))
    assert serving_projection(df, SHIPPINGS).columns == [
        "shipping_id", "shipping_address", "status", "shipping_cost", "last_modified_ts", "date",
    ]


def test_null_defaults_by_role(spark):
    empty = spark.createDataFrame([("t1", *[None] * 8)], TRANSACTIONS.schema)
    served = null_defaults(serving_projection(with_date(empty), TRANSACTIONS), TRANSACTIONS)
    row = served.first().asDict()
    assert (row["quantity"], row["discount"]) == (0, 0)
    assert row["status"] == row["date"] == row["last_modified_ts"] == "null"

    empty = spark.createDataFrame([("u1", *[None] * 9)], USERS.schema)
    served = serving_projection(with_date(empty), USERS)
    assert null_defaults(served, USERS, text="?").first()["birthdate"] == "?"


def test_serving_table_is_newest_decoded_and_without_nulls(spark):
    records = spark.createDataFrame(
        [
            ("u1", '{"user_id":"u1","job":"old","last_modified_ts":"2024-01-01 00:00:00.000001"}', 1),
            ("u1", '{"user_id":"u1","job":"new","last_modified_ts":"2024-01-01 00:00:00.000001"}', 2),
        ],
        "key STRING, value STRING, off BIGINT",
    )
    table = serving_table(records, USERS, ["off"])
    assert table.columns == USERS.serving_schema.fieldNames()
    row = table.first()
    assert (row["job"], row["sex"], row["date"]) == ("new", "null", "null")
    assert table.count() == 1
