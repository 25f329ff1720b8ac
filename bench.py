"""Time the headline operators and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The change messages are derived from the tables and stored first, outside the
timing, since a deployment receives them ready-made. Every measured run starts
from those messages (or, for the query shapes, from stored latest-state tables)
and computes its whole result; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.entities import ENTITIES, SHIPPINGS, TRANSACTIONS
from changeloom.functions import change_order, with_date
from changeloom.operators import (
    latest,
    latest_stream,
    retained_latest,
    split,
    stamp_status,
    to_key_value,
)
from changeloom.plans.feeds import EVENTS, FEEDS, events
from changeloom.plans.queries import AS_OF
from changeloom.plans.serving import STAR, daily, find, recent, star_revenue
from changeloom.session import build_session, scratch_dir, stored
from changeloom.sources.layout import write_indexed, write_sorted
from changeloom.streaming import FanOutTargets, FileSink, compact, drain, read_upserts, start_upserts
from changeloom.streaming.job import start_fan_outs, start_separate
from changeloom.streaming.lifecycle import ONCE

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RAW = "value STRING, off BIGINT"


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


class Bench:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.messages = scratch_dir(spark, "bench_messages")
        for name, feed in {**FEEDS, "events": events}.items():
            files = int(CPUS) if name in ("transactions", "shippings", "events") else 1
            feed(spark, FOLDER).raw.repartition(files).write.parquet(f"{self.messages}/{name}")
        # Latest state in its serving layout, for the query shapes.
        self.table = self.served("transactions")
        self.tables = {**{name: self.served(name) for name in STAR}, "transactions": self.table}

    def served(self, name: str) -> DataFrame:
        entity, path = ENTITIES[name], scratch_dir(self.spark, f"bench_{name}")
        state = stored(with_date(self.current(name)), f"bench_state_{name}")
        (write_sorted if entity.sorted_by else write_indexed)(state, path, entity)
        return self.spark.read.schema(state.schema).parquet(path)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW).parquet(f"{self.messages}/{name}")

    def stream(self, entity) -> DataFrame:
        return self.spark.readStream.schema(RAW).parquet(f"{self.messages}/{entity.name}")

    def order(self):
        return change_order("last_modified_ts", "off")

    def good(self, name: str, *columns: str) -> DataFrame:
        entity = ENTITIES[name].only(*columns) if columns else ENTITIES[name]
        return split(self.raw(name), entity, ["off"])[0]

    def current(self, name: str, *columns: str) -> DataFrame:
        return latest(self.good(name, *columns), ENTITIES[name].key, self.order())

    def targets(self) -> FanOutTargets:
        root = scratch_dir(self.spark, "bench_out")
        return FanOutTargets(
            f"{root}/archive", f"{root}/dlq", FileSink(f"{root}/kv"), f"{root}/checkpoint"
        )

    # headline -------------------------------------------------------------

    def split_good(self):
        run(self.good("transactions"))

    def split_dead_letter(self):
        run(split(self.raw("transactions"), TRANSACTIONS)[1])

    def key_value(self):
        run(to_key_value(with_date(self.good("transactions").drop("off")), "transaction_id"))

    def upsert(self):
        run(self.current("transactions"))

    def retention(self):
        run(retained_latest(with_date(self.good("shippings")), SHIPPINGS, self.order(), AS_OF))

    def status_stamp(self):
        changes = stored(self.good("transactions"), "bench_stamp")
        run(stamp_status(changes, "transaction_id", self.order()))

    def star_from_tables(self):
        by = ["category", "job", "payment_method", "shipping_status"]
        run(star_revenue(self.tables, by))

    def archive_write(self):
        dated = with_date(split(self.raw("events"), EVENTS, ["off"])[0])
        path = scratch_dir(self.spark, "bench_archive")
        dated.hint("rebalance", "date").write.partitionBy("date").parquet(path)

    def stream_fan_out(self):
        drain(start_fan_outs(self.stream, [EVENTS], self.targets(), trigger=ONCE))

    def stream_upsert(self):
        """Publish a batch, fold it into the table, and read the table."""
        root = self.stream_upsert_append()
        compact(self.spark, f"{root}/table", TRANSACTIONS, self.order(), buckets=int(CPUS))
        run(read_upserts(self.spark, f"{root}/table", TRANSACTIONS, self.order()))

    def stream_upsert_append(self) -> str:
        dated = with_date(split(self.stream(TRANSACTIONS), TRANSACTIONS, ["off"])[0])
        root = scratch_dir(self.spark, "bench_upsert")
        drain(
            [start_upserts(dated, TRANSACTIONS, self.order(), f"{root}/table", f"{root}/c", ONCE)]
        )
        return root

    def query_lookup(self):
        run(find(self.table, user_id="7"))

    def query_recent(self):
        run(recent(self.table, "last_modified_ts", "1996", "2001", 100, "transaction_id"))

    def query_daily(self):
        run(daily(self.table, {"orders": F.count(F.lit(1)), "units": F.sum("quantity")}))

    # alternatives, for comparison -----------------------------------------

    def star_revenue(self):
        wanted = {
            "transactions": [key for key, _ in STAR.values()] + ["quantity", "discount"],
            **{name: list(columns) for name, (_, columns) in STAR.items()},
        }
        tables = {name: self.current(name, *columns) for name, columns in wanted.items()}
        tables["transactions"] = stored(tables["transactions"], "bench_star")
        run(star_revenue(tables, ["category", "job", "payment_method", "shipping_status"]))

    def upsert_by_aggregate(self):
        run(latest_stream(self.good("transactions"), "transaction_id", self.order()))

    def stream_separate(self):
        drain(start_separate(self.stream, [EVENTS], self.targets(), trigger=ONCE))


HEADLINE = (
    "split_good",
    "split_dead_letter",
    "key_value",
    "upsert",
    "retention",
    "status_stamp",
    "star_revenue",
    "archive_write",
    "stream_fan_out",
    "stream_upsert",
    "query_lookup",
    "query_recent",
    "query_daily",
)
ALTERNATIVES = ("upsert_by_aggregate", "stream_separate", "star_from_tables", "stream_upsert_append")


def seconds(work: Callable[[], None], runs: int = 2) -> float:
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        work()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    bench = Bench(spark)
    headline = {name: seconds(getattr(bench, name)) for name in HEADLINE}
    alternatives = {name: seconds(getattr(bench, name)) for name in ALTERNATIVES}
    messages = {name: bench.raw(name).count() for name in ("transactions", "events")}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(headline.values()), 3),
                "unit": "sec",
                "queries": headline,
                "alternatives": alternatives,
                "messages": messages,
                "upsert_messages_per_sec": round(messages["transactions"] / headline["upsert"]),
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
