"""The streaming job: every entity from its change topic to its three outputs.

    spark-submit run_streams.py --brokers host:9092 \\
        --archive s3a://transactions --dead-letters s3a://dlq --checkpoints s3a://checkpoints

Object-store settings are taken from the environment variables named in ``main``.
"""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from changeloom.entities import ENTITIES, Entity
from changeloom.functions.time import with_date
from changeloom.operators.envelope import split
from changeloom.session import ObjectStore, build_session
from changeloom.sources.kafka import Broker, read_changes
from changeloom.streaming.lifecycle import await_all
from changeloom.streaming.progress import ProgressListener
from changeloom.streaming.sinks import (
    FanOutTargets,
    KafkaSink,
    Trigger,
    fan_out,
    start_archive,
    start_dead_letters,
    start_key_values,
)

Source = Callable[[Entity], DataFrame]

# Lets the entities share the executors, so that the backlog of one does not hold
# up the batches of the others.
SHARED = {"spark.scheduler.mode": "FAIR"}


@contextmanager
def _own_pool(raw: DataFrame, entity: Entity) -> Iterator[None]:
    context = raw.sparkSession.sparkContext
    context.setLocalProperty("spark.scheduler.pool", entity.name)
    try:
        yield
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)


def start_fan_outs(
    source: Source,
    entities: Iterable[Entity],
    targets: FanOutTargets,
    carry: Sequence[str] = ("off",),
    trigger: Trigger | None = None,
) -> list[StreamingQuery]:
    """One query per entity. ``source`` gives the raw change stream of an entity."""
    queries = []
    for entity in entities:
        raw = source(entity)
        with _own_pool(raw, entity):
            queries.append(fan_out(raw, entity, targets, carry, trigger))
    return queries


def start_separate(
    source: Source,
    entities: Iterable[Entity],
    targets: FanOutTargets,
    carry: Sequence[str] = ("off",),
    trigger: Trigger | None = None,
) -> list[StreamingQuery]:
    """Three queries per entity, each with its own read, checkpoint and failure.

    Costs three reads and parses of each source; worth it where one slow or
    broken output must not hold back the others.
    """
    queries = []
    for entity in entities:
        raw = source(entity)
        good, dead = split(raw, entity, carry)
        dated = with_date(good, entity.modified_at)
        ends = (targets.checkpoints, trigger)
        with _own_pool(raw, entity):
            queries += [
                start_key_values(dated, entity, targets.key_values, *ends),
                start_archive(dated, entity, targets.archive, *ends),
                start_dead_letters(dead, entity, targets.dead_letters, *ends),
            ]
    return queries


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--brokers", required=True)
    parser.add_argument("--archive", required=True)
    parser.add_argument("--dead-letters", required=True)
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--entities", nargs="+", choices=ENTITIES, default=list(ENTITIES))
    parser.add_argument("--separate", action="store_true", help="one query per output")
    parser.add_argument(
        "--max-offsets-per-trigger",
        type=int,
        default=50_000_000,
        help="bound on a batch, so that the first catch-up is many batches (default %(default)s)",
    )
    parser.add_argument("--metrics", help="folder to which progress reports are appended")
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--interval", help='time between batches, e.g. "10 seconds"')
    return parser.parse_args(argv)


def _object_store() -> ObjectStore | None:
    endpoint = os.environ.get("OBJECT_STORE_ENDPOINT")
    if not endpoint:
        return None
    return ObjectStore(
        endpoint,
        os.environ["OBJECT_STORE_ACCESS_KEY"],
        os.environ["OBJECT_STORE_SECRET_KEY"],
        tls=endpoint.startswith("https://"),
    )


def main(argv: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    args = _arguments(argv)
    spark: SparkSession = build_session("change_streams", _object_store(), **SHARED)
    listener = ProgressListener(spark, args.metrics)
    spark.streams.addListener(listener)

    broker = Broker(args.brokers)

    def source(entity: Entity) -> DataFrame:
        return read_changes(
            spark, broker, entity, args.max_offsets_per_trigger, args.min_partitions
        )

    targets = FanOutTargets(args.archive, args.dead_letters, KafkaSink(broker), args.checkpoints)
    start = start_separate if args.separate else start_fan_outs
    trigger = {"processingTime": args.interval} if args.interval else None
    try:
        start(source, [ENTITIES[name] for name in args.entities], targets, trigger=trigger)
        await_all(spark)
    finally:
        listener.close()
