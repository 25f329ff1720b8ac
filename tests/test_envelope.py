import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeloom.entities import PRODUCTS, TRANSACTIONS, USERS
from changeloom.operators.envelope import (
    after_images,
    dead_letters,
    good_rows,
    rejects,
    route,
    route_counts,
    split,
    unreadable_envelopes,
)
from tests.conftest import plan_of

# A row with a value of its own in every column.
USER = {name: f"{name}-{number}" for number, name in enumerate(USERS.columns)}


def message(after):
    payload = dict(after=after)
    return json.dumps(dict(payload=payload))


def raw(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value STRING")


def outcome(spark, value, entity=USERS):
    good, dead = split(raw(spark, value), entity)
    return [row.asDict() for row in good.collect()], [tuple(row) for row in dead.collect()]


def test_complete_row_is_good(spark):
    good, dead = outcome(spark, message(json.dumps(USER)))
    assert good == [USER] and dead == []


def test_missing_key_is_dead_with_exact_text(spark):
    text = json.dumps({"full_name": "Bo", "last_modified_ts": "x", "status": "INSERT"})
    assert outcome(spark, message(text)) == ([], [(text, "users")])


def test_unreadable_image_is_dead(spark):
    assert outcome(spark, message("{not json")) == ([], [("{not json", "users")])


DROPPED = {
    "null_image": message(None),
    "absent_image": '{"payload":{}}',
    "no_payload": '{"schema":{}}',
    "tombstone": None,
    "cut_envelope": '{"payload":{"after":"{}',
    "not_json": "hello",
    "empty": "",
}


@pytest.mark.parametrize("value", DROPPED.values(), ids=DROPPED.keys())
def test_dropped(spark, value):
    assert outcome(spark, value) == ([], [])


DEAD = {
    "cut_after_key": '{"user_id":"u1","full_na',
    "empty_text": "",
    "null_text": "null",
    "array_of_two": "[1,2]",
    "scalar": "7",
    "key_in_other_case": '{"USER_ID":"u1"}',
    "null_key": '{"user_id":null,"job":"x"}',
}


@pytest.mark.parametrize("after", DEAD.values(), ids=DEAD.keys())
def test_dead(spark, after):
    assert outcome(spark, message(after)) == ([], [(after, "users")])


def test_object_image_and_unknown_fields(spark):
    value = json.dumps({"schema": {"x": 1}, "payload": {"op": "c", "after": {**USER, "extra": [1]}}})
    assert outcome(spark, value) == ([USER], [])


def test_dead_object_image_is_kept_as_compact_text(spark):
    value = '{"payload": {"after": {"job": "x",  "status": "y"}}}'
    assert outcome(spark, value) == ([], [('{"job":"x","status":"y"}', "users")])


def test_empty_key_is_good(spark):
    good, dead = outcome(spark, message('{"user_id":""}'))
    assert good[0]["user_id"] == "" and dead == []


def test_repeated_field_takes_the_last(spark):
    good, _ = outcome(spark, message('{"user_id":"a","user_id":"b"}'))
    assert good[0]["user_id"] == "b"


def test_numeric_key_becomes_text(spark):
    good, _ = outcome(spark, message('{"user_id":42}'))
    assert good[0]["user_id"] == "42"


@pytest.mark.parametrize("quantity", ['"many"', "99999999999", "1.5", "[1]"])
def test_bad_field_is_null_and_row_stays_good(spark, quantity):
    text = f'{{"transaction_id":"t","quantity":{quantity},"discount":5}}'
    good, dead = outcome(spark, message(text), TRANSACTIONS)
    assert dead == []
    assert (good[0]["quantity"], good[0]["discount"]) == (None, 5)


def test_float_is_32_bit(spark):
    good, _ = outcome(spark, message('{"product_id":"p","unit_price":10.1}'), PRODUCTS)
    assert good[0]["unit_price"] == pytest.approx(10.100000381)


def test_carry_travels_with_good_rows(spark):
    df = spark.createDataFrame([(message(json.dumps(USER)), 5)], "value STRING, off BIGINT")
    good, _ = split(df, USERS, ["off"])
    assert good.columns == [*USERS.columns, "off"]
    assert good.first()["off"] == 5


def test_narrow_decode_routes_like_full_decode(spark, rows):
    df = raw(spark, *(message(text) for text in [json.dumps(USER), *DEAD.values()]))
    full, full_dead = split(df, USERS)
    narrow, narrow_dead = split(df, USERS.only("job"))
    assert rows(narrow) == rows(full, "user_id", "job", "last_modified_ts")
    assert rows(narrow_dead) == rows(full_dead)


def test_route_agrees_with_split(spark, rows):
    values = [message(json.dumps(USER)), *DROPPED.values(), *map(message, DEAD.values())]
    df = raw(spark, *values)
    good, dead = split(df, USERS)
    routed = route(df, USERS)
    assert rows(good_rows(routed)) == rows(good)
    assert rows(dead_letters(routed, USERS)) == rows(dead)
    counts = {row["route"]: row["messages"] for row in route_counts(df, USERS).collect()}
    assert counts == {"good": 1, "dead_letter": len(DEAD), "dropped": len(DROPPED)}


def test_only_broken_json_is_an_unreadable_envelope(spark):
    found = unreadable_envelopes(raw(spark, *DROPPED.values(), message("{cut")), USERS).collect()
    broken = {DROPPED[name] for name in ("cut_envelope", "not_json", "empty")}
    assert {row["raw_value"] for row in found} == broken and len(found) == 3


def test_each_json_text_is_parsed_once_and_nothing_shuffles(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, message(json.dumps(USER))).write.parquet(path)
    for output in split(spark.read.parquet(path), USERS):
        plan = plan_of(output)
        assert plan.count("from_json") == 2
        assert "Exchange" not in plan


def test_good_rows_carry_no_text(spark):
    """What the good path parses is not copied along with the rows."""
    good, dead = split(raw(spark, message(json.dumps(USER)), message("{"), message(None), None), USERS)
    generated = [line for line in plan_of(good).splitlines() if "Generate explode(array(data#" in line]
    assert len(generated) == 1 and "after#" not in generated[0]
    assert "CASE WHEN" not in plan_of(good)
    assert [row.user_id for row in good.collect()] == [USER["user_id"]]
    assert [row.raw_value for row in dead.collect()] == ["{"]


texts = st.one_of(
    st.none(),
    st.text(max_size=12),
    st.fixed_dictionaries(
        {}, optional={"user_id": st.one_of(st.none(), st.text(max_size=3)), "job": st.text(max_size=3)}
    ).map(json.dumps),
    st.integers(0, 40).map(lambda n: json.dumps(USER)[:n]),
)
values = st.one_of(st.none(), st.text(max_size=12), texts.map(message))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(values, max_size=30))
def test_every_message_takes_exactly_one_route(spark, batch):
    batch = [v if v is None else v.encode("utf-8", "ignore").decode() for v in batch]
    df = raw(spark, *batch)
    good, dead = split(df, USERS)
    counts = {row["route"]: row["messages"] for row in route_counts(df, USERS).collect()}
    assert good.count() == counts.get("good", 0)
    assert dead.count() == counts.get("dead_letter", 0)
    assert after_images(df).count() == good.count() + dead.count()
    assert sum(counts.values()) == len(batch)


def test_rejects_are_dead_letters_and_unreadable_envelopes_in_one_pass(spark, rows):
    twice = '{"payload":{"after":"{}"},"payload":{"after":"{}"}}'
    values = [message(json.dumps(USER)), twice, *DROPPED.values(), *map(message, DEAD.values())]
    df = raw(spark, *values)
    found = rejects(df, USERS)
    apart = split(df, USERS)[1].unionByName(unreadable_envelopes(df, USERS))
    assert found.columns == apart.columns and rows(found) == rows(apart)
    assert len(rows(found)) >= len(DEAD) + 3
    assert "Union" not in plan_of(found) and plan_of(found).count("Scan") == 1


def test_the_query_of_rejects_reads_each_feed_once(spark):
    from changeloom.plans.queries import cdc_dead_letter_envelope

    plan = cdc_dead_letter_envelope(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_partkey#") and len([x for x in plan.splitlines() if "Relation" in x]) == 4
