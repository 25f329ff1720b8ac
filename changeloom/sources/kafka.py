"""Kafka topics in and out. Needs the Spark Kafka package on the class path.

Clean records carry the position of their change in the change topic as a header: tasks
write side by side, so that the clean topic's own offsets do not tell which of two
changes of equal time is the newer.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.entities import Entity

# Topic names agreed with the capture side and with consumers.
CHANGE_TOPIC = "transactions_streaming.public.{name}"
CLEAN_TOPIC = "streaming_{name}"

POSITION_HEADER = "off"


@dataclass(frozen=True)
class Broker:
    """Bootstrap servers plus any further ``kafka.*`` client settings (TLS, SASL)."""

    servers: str
    client: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, **self.client}


def source_options(
    broker: Broker,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options to read a topic from its start.

    ``min_partitions`` splits large topic partitions into several tasks, so a
    topic with one partition does not limit the job to one core.
    ``max_offsets_per_trigger`` bounds a batch, e.g. during the first catch-up.
    """
    options = {**broker.options(), "subscribe": topic, "startingOffsets": "earliest"}
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def sink_options(broker: Broker, entity: Entity) -> dict[str, str]:
    return {**broker.options(), "topic": CLEAN_TOPIC.format(name=entity.name)}


def position_headers(position: str = "off") -> Column:
    """Record headers that name the position of the change."""
    value = F.col(position).cast("string").cast("binary")
    header = F.struct(F.lit(POSITION_HEADER).alias("key"), value.alias("value"))
    return F.array(header).alias("headers")


def clean_records(records: DataFrame) -> DataFrame:
    """``(key, value, off)`` of records with headers; the topic's offset where a record has none."""
    named = F.filter("headers", lambda h: h["key"] == POSITION_HEADER)
    position = F.get(named, F.lit(0))["value"].cast("string").try_cast("bigint")
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.coalesce(position, F.col("offset")).alias("off"),
    )


def read_changes(
    spark: SparkSession,
    broker: Broker,
    entity: Entity,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """The change stream of an entity: ``(value STRING, off BIGINT)``."""
    options = source_options(
        broker,
        CHANGE_TOPIC.format(name=entity.name),
        max_offsets_per_trigger,
        min_partitions,
    )
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .selectExpr("CAST(value AS STRING) AS value", "offset AS off")
    )


def read_clean(
    spark: SparkSession, broker: Broker, entity: Entity, streaming: bool = False
) -> DataFrame:
    """The cleaned records of an entity: ``(key, value, off)``.

    As a batch, what the topic holds now; as a stream, that and all that follows.
    """
    reader = spark.readStream if streaming else spark.read
    options = source_options(broker, CLEAN_TOPIC.format(name=entity.name))
    return clean_records(reader.format("kafka").options(**options, includeHeaders="true").load())
