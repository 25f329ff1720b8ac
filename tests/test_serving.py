import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import heavy_keys, lookup
from changeloom.plans import feeds, queries
from changeloom.plans.serving import (
    daily,
    find,
    pushed_filters,
    recent,
    register_views,
    roll_up,
    star,
    star_revenue,
)
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def skewed(spark):
    """Facts with one key in a third of the rows, many rare keys and some without."""
    rng = random.Random(3)

    def key(i):
        if i % 3 == 0:
            return "hot"
        return None if i % 7 == 0 else f"k{rng.randrange(2000)}"

    return spark.createDataFrame(
        [(f"t{i}", key(i), i % 5) for i in range(3000)], "id STRING, k STRING, n INT"
    )


@pytest.fixture(scope="module")
def dimension(spark):
    names = ["hot", *(f"k{i}" for i in range(0, 2000, 2))]
    return spark.createDataFrame([(name, f"v-{name}") for name in names], "k STRING, v STRING")


def test_heavy_keys_names_hot_values_and_null_only(skewed):
    found = heavy_keys(skewed, "k", "n", partitions=64)
    assert sorted(found["k"], key=repr) == ["hot", None]
    assert sorted(found["n"]) == [0, 1, 2, 3, 4]
    # With few partitions a tenth of the rows makes none of them late.
    assert heavy_keys(skewed, "k", partitions=4)["k"] == ["hot"]


def test_heavy_keys_of_nothing(skewed):
    assert heavy_keys(skewed.limit(0), "k") == {"k": []}


@pytest.mark.parametrize("heavy", [[], ["hot"], ["hot", None], [None], ["k2", "absent"]], ids=str)
@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_lookup_equals_a_left_join(spark, rows, skewed, dimension, heavy, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        joined = lookup(skewed, dimension, "k", heavy, ["id"], salts=5)
        assert joined.columns == ["k", "id", "n", "v"]
        assert rows(joined) == rows(skewed.join(dimension, "k", "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_spreads_the_hot_key_and_repeats_only_its_row(spark, skewed, dimension):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(skewed, dimension, "k", ["hot", None], ["id"], salts=64)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 4
    assert max(row["count"] for row in sizes) < 3000 * 0.4


def test_lookup_without_heavy_keys_is_a_plain_join(skewed, dimension):
    plan = plan_of(lookup(skewed, dimension, "k"))
    assert "_salt" not in plan and "Generate" not in plan


def test_lookup_of_heavy_keys_needs_something_to_spread_by(skewed, dimension):
    with pytest.raises(ValueError):
        lookup(skewed, dimension, "k", ["hot"])


@pytest.fixture(scope="module")
def tables(spark):
    transactions = spark.createDataFrame(
        [
            ("t1", "u1", "p1", "c1", "s1", 2, 10, "2024-01-01 00:00:00.000000", "INSERT"),
            ("t2", "u1", "p2", "c1", "s2", 1, 0, "2024-01-01 00:00:01.000000", "UPDATE"),
            ("t3", "u9", None, "c1", "s1", 5, 0, "2024-01-02 00:00:00.000000", "INSERT"),
        ],
        "transaction_id STRING, user_id STRING, product_id STRING, payment_id STRING, "
        "shipping_id STRING, quantity INT, discount INT, last_modified_ts STRING, status STRING",
    ).withColumn("date", F.substring("last_modified_ts", 1, 10).cast("date"))
    return {
        "transactions": transactions,
        "users": spark.createDataFrame([("u1", "dev", "X")], "user_id STRING, job STRING, address STRING"),
        "products": spark.createDataFrame(
            [("p1", "GOLD", 10.1), ("p2", "TIN", 3.0)],
            "product_id STRING, category STRING, unit_price FLOAT",
        ),
        "payments": spark.createDataFrame(
            [("c1", "card", "USD")], "payment_id STRING, payment_method STRING, currency STRING"
        ),
        "shippings": spark.createDataFrame(
            [("s1", 1.5, "Delay")],
            "shipping_id STRING, shipping_cost FLOAT, shipping_status STRING",
        ),
    }


def test_find(tables, rows):
    transactions = tables["transactions"]
    assert rows(find(transactions, user_id="u1"), "transaction_id") == [("t1",), ("t2",)]
    assert rows(find(transactions, user_id=["u1", "u9"], status="INSERT"), "transaction_id") == [
        ("t1",),
        ("t3",),
    ]


def test_recent(tables):
    newest = recent(
        tables["transactions"], "last_modified_ts", "2024-01-01", "2024-01-03", 2, "transaction_id"
    )
    assert [row["transaction_id"] for row in newest.collect()] == ["t3", "t2"]
    assert "TakeOrderedAndProject" in plan_of(newest)


def test_roll_ups(tables, rows):
    by_status = roll_up(tables["transactions"], ["status"], {"units": F.sum("quantity")})
    assert rows(by_status, "status", "units") == [("INSERT", 7), ("UPDATE", 1)]
    per_day = daily(tables["transactions"], {"orders": F.count("*")})
    assert [n for _, n in rows(per_day, "date", "orders")] == [2, 1]


def test_star_keeps_facts_without_dimensions(tables, rows):
    joined = star(tables)
    assert rows(joined, "transaction_id", "category", "job", "payment_method", "shipping_status") == [
        ("t1", "GOLD", "dev", "card", "Delay"),
        ("t2", "TIN", "dev", "card", None),
        ("t3", None, None, "card", "Delay"),
    ]


def test_star_revenue(tables, rows):
    table = star_revenue(tables, ["category"])
    assert rows(table, "category", "orders", "units", "revenue", "shipping_cents") == [
        ("GOLD", 1, 2, 1010 * 2 * 90, 150),
        ("TIN", 1, 1, 300 * 1 * 100, None),
        (None, 1, 5, None, 150),
    ]


def test_lookups_reach_the_scan(spark):
    from changeloom.plans.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    for name, column in (
        ("q_point_lookup", "product_id"),
        ("q_user_lookup", "user_id"),
        ("q_filter_status", "status"),
        ("q_filter_keys", "user_id"),
        ("q_recent", "last_modified_ts"),
    ):
        assert column in pushed_filters(QUERIES[name](spark, folder))


def test_heavy_sketches_do_not_meet_in_one_task(spark, skewed, tmp_path):
    seen = heavy_keys(skewed, "k", partitions=1000)
    assert {"hot", None} <= set(seen["k"]) and len(seen["k"]) <= 1000


def test_views(spark, tables):
    register_views(tables)
    row = spark.sql(
        "SELECT count(*) AS n FROM transactions JOIN users USING (user_id) WHERE job = 'dev'"
    ).first()
    assert row["n"] == 2


def test_ranges_of_the_sorted_layout_are_found_on_a_stored_table(spark, monkeypatch):
    """Finding them reads the rows twice, which must not decode the feed twice."""
    plans, write = [], queries.write_sorted
    monkeypatch.setattr(queries, "write_sorted", lambda rows, *rest: (plans.append(plan_of(rows)), write(rows, *rest)))
    assert queries.layout_sorted(spark, "/root/testdata/sf0.001").count() > 0
    assert len(plans) == 1 and "from_json" not in plans[0] and "Window" not in plans[0]


def test_versions_of_a_small_file_are_made_by_several_tasks(spark):
    rows = feeds.products(spark, "/root/testdata/sf0.001").rows
    assert "REPARTITION_BY_COL" in plan_of(rows)
