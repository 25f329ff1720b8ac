import datetime
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeloom.entities import USERS, Entity, STRING
from changeloom.functions import change_order, with_date
from changeloom.operators import fold, latest, retain, retained_latest, stamp_status
from tests.conftest import plan_of

SCHEMA = "user_id STRING, job STRING, last_modified_ts STRING, status STRING, off BIGINT"
T1, T2 = "2024-01-15 10:30:45.000001", "2024-01-15 10:30:45.000002"


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def order():
    return change_order("last_modified_ts", "off")


def test_newest_row_replaces_the_whole_row(spark, rows):
    df = changes(spark, ("a", "x", T1, "INSERT", 1), ("a", None, T2, None, 2), ("b", "y", T1, "INSERT", 3))
    assert rows(latest(df, "user_id", order())) == [
        ("a", None, T2, None, 2),
        ("b", "y", T1, "INSERT", 3),
    ]


def test_late_change_loses_and_offset_breaks_ties(spark, rows):
    df = changes(spark, ("a", "new", T2, "s", 1), ("a", "old", T1, "s", 2), ("a", "tie", T2, "s", 3))
    assert rows(latest(df, "user_id", order()), "job") == [("tie",)]


def test_unreadable_time_is_oldest_and_whole_second_is_in_place(spark, rows):
    df = changes(
        spark,
        ("a", "bad", "zzz", "s", 9),
        ("a", "whole", "2024-01-15 10:30:46", "s", 1),
        ("a", "fraction", T2, "s", 5),
        ("b", "none", None, "s", 1),
    )
    assert rows(latest(df, "user_id", order()), "user_id", "job") == [("a", "whole"), ("b", "none")]


def test_group_limit_runs_before_the_shuffle_and_columns_are_pruned(spark, tmp_path):
    path = str(tmp_path / "changes")
    changes(spark, ("a", "x", T1, "INSERT", 1)).write.parquet(path)
    plan = plan_of(latest(spark.read.parquet(path), "user_id", order()).select("user_id", "off"))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert "job" not in plan[plan.index("ReadSchema") :]


def test_a_dominant_key_is_cut_down_before_the_shuffle(spark):
    """Every task passes on one row of a key that holds most of the changes."""
    df = spark.range(0, 8000, numPartitions=8).selectExpr(
        "IF(id % 4 = 0, concat('k', id), 'hot') AS user_id",
        "CAST(id AS STRING) AS job", f"'{T1}' AS last_modified_ts", "'s' AS status", "id AS off",
    )
    table = latest(df, "user_id", order())
    assert table.filter("user_id = 'hot'").collect()[0]["off"] == 7999
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = latest(df, "user_id", order())._jdf.queryExecution().executedPlan()
        plan.execute().count()
        while plan.nodeName() != "Exchange":
            plan = plan.children().apply(0)
        written = plan.metrics().apply("shuffleRecordsWritten").value()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert written == 2000 + 8


def test_key_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "changes")
    changes(spark, ("a", "x", T1, "INSERT", 1)).write.parquet(path)
    table = latest(spark.read.parquet(path), "user_id", order())
    assert "EqualTo(user_id,a)" in plan_of(table.filter("user_id = 'a'"))
    # A row that no longer has the value must not resurface through an old version.
    assert "EqualTo(job,x)" not in plan_of(table.filter("job = 'x'"))


times = st.sampled_from([T1, T2, "2024-01-15 10:30:46", "2024-01-12 00:00:00.000000", "bad", None])
histories = st.lists(st.tuples(st.sampled_from("abc"), times), min_size=1, max_size=25)


def with_offsets(history):
    return [(key, f"j{i}", ts, "INSERT", i) for i, (key, ts) in enumerate(history)]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(histories, st.randoms())
def test_latest_does_not_depend_on_arrival_or_batching(spark, rows, history, rng):
    numbered = with_offsets(history)
    whole = rows(latest(changes(spark, *numbered), "user_id", order()))
    rng.shuffle(numbered)
    cut = rng.randrange(len(numbered) + 1)
    empty = changes(spark)
    table = empty
    for part in (numbered[:cut], numbered[cut:], numbered[:1]):
        part_df = changes(spark, *part) if part else empty
        table = fold(table, part_df, "user_id", order())
    assert rows(table) == whole


SHORT = Entity("short", "user_id", {"user_id": STRING, "last_modified_ts": STRING}, retention_days=3)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(histories)
def test_early_filter_of_retention_changes_nothing(spark, rows, history):
    dated = with_date(changes(spark, *with_offsets(history)))
    for as_of in (datetime.date(2024, 1, 14), datetime.date(2024, 1, 17), datetime.date(2024, 1, 18)):
        after = retain(latest(dated, "user_id", order()), as_of, 3)
        assert rows(retained_latest(dated, SHORT, order(), as_of)) == rows(after)


def test_retention_bound_is_strict_and_optional(spark, rows):
    df = with_date(
        changes(
            spark,
            ("a", "x", "2024-01-10 00:00:00.000000", "s", 1),
            ("b", "x", "2024-01-11 00:00:00.000000", "s", 1),
        )
    )
    as_of = datetime.date(2024, 1, 13)
    assert rows(retained_latest(df, SHORT, order(), as_of), "user_id") == [("b",)]
    assert rows(retained_latest(df, USERS, order(), as_of), "user_id") == [("a",), ("b",)]


def test_retention_prunes_archive_partitions(spark, tmp_path):
    path = str(tmp_path / "archive")
    dated = with_date(changes(spark, ("a", "x", T1, "INSERT", 1)))
    dated.write.partitionBy("date").parquet(path)
    table = retained_latest(spark.read.parquet(path), SHORT, order(), datetime.date(2024, 1, 16))
    filters = [line for line in plan_of(table).splitlines() if "PartitionFilters" in line]
    assert filters and all("date" in line.split("PartitionFilters")[1] for line in filters)


def test_status_stamp_marks_all_but_the_first_even_for_one_dominant_key(spark, rows):
    rng = random.Random(1)
    history = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(40)}", T1) for _ in range(400)]
    numbered = with_offsets(history)
    seen, expected = set(), []
    for key, job, ts, status, off in numbered:
        expected.append((key, job, ts, "UPDATED" if key in seen else status, off))
        seen.add(key)
    rng.shuffle(numbered)
    stamped = stamp_status(changes(spark, *numbered), "user_id", order())
    assert stamped.columns == ["user_id", "job", "last_modified_ts", "status", "off"]
    assert rows(stamped) == sorted(expected, key=repr)


def test_status_stamp_with_missing_times_and_custom_stamp(spark, rows):
    df = changes(spark, ("a", "1", None, "I", 1), ("a", "2", "bad", "I", 2), ("a", "3", T1, None, 3))
    stamped = stamp_status(df, "user_id", order(), stamp="CHANGED")
    assert rows(stamped, "job", "status") == [("1", "I"), ("2", "CHANGED"), ("3", "CHANGED")]


def test_status_stamp_never_gathers_a_key(spark, tmp_path):
    path = str(tmp_path / "changes")
    changes(spark, ("a", "x", T1, "INSERT", 1)).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(stamp_status(spark.read.parquet(path), "user_id", order()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in plan
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "user_id" in join and "_moment" in join


@pytest.mark.parametrize("days", [0, 3])
def test_retain(spark, rows, days):
    df = with_date(changes(spark, ("a", "x", T1, "s", 1), ("b", "x", "bad", "s", 1)))
    kept = rows(retain(df, datetime.date(2024, 1, 15), days), "user_id")
    assert kept == ([("a",)] if days else [])
