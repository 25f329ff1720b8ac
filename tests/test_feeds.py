import json

from pyspark.sql import functions as F

from changeloom.operators.envelope import split
from changeloom.plans.feeds import EVENTS, FAULTS, Feed
from tests.conftest import plan_of


def feed(spark):
    rows = [(str(n), "u", "view", 1.5, "2024-01-15 10:30:45.000000", n, n) for n in range(len(FAULTS) + 1)]
    names = [*EVENTS.columns, "off", "fault"]
    kinds = "event_id STRING, user_id STRING, event_type STRING, value DOUBLE, last_modified_ts STRING"
    return Feed(EVENTS, spark.createDataFrame(rows, f"{kinds}, off BIGINT, fault BIGINT").select(*names))


def test_messages_are_made_before_they_are_parsed(spark):
    """``from_json`` interprets its argument for each row, so that must be a column."""
    plan = plan_of(split(feed(spark).raw, EVENTS, ["off"])[0])
    parsing = [line for line in plan.splitlines() if "from_json(" in line]
    assert len(parsing) == 2 and not any("StructsToJson" in line for line in parsing)
    assert plan.count("Exchange") == 0


def test_messages_of_every_fault(spark):
    values = [row.value for row in feed(spark).raw.orderBy("off").collect()]
    row = {"event_id": "0", "user_id": "u", "event_type": "view", "value": 1.5}
    row["last_modified_ts"] = "2024-01-15 10:30:45.000000"
    assert values[0] == '{"payload":{}}' and values[3] == '{"payload":' and values[4] is None
    keyless, cut, whole = (json.loads(values[n])["payload"]["after"] for n in (1, 2, 5))
    assert json.loads(keyless) == {name: value for name, value in row.items() if name != "event_id"}
    assert json.loads(whole) == {**row, "event_id": "5"} and cut == json.dumps({"event_id": "2", "user_id": "u"}, separators=(",", ":"))[:20]
    good, dead = split(feed(spark).raw, EVENTS, ["off"])
    assert [r.off for r in good.select(F.col("off")).collect()] == [5]
    assert dead.count() == 2
