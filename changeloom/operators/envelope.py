"""Change envelopes to typed rows and dead letters.

All functions take a batch or a streaming DataFrame with a ``value STRING``
column. ``carry`` names further input columns (say, the log offset) that should
travel with each row. No function here shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.entities import ENVELOPE, Entity
from changeloom.functions.columns import evaluated_once


GOOD, DEAD, DROPPED = "good", "dead_letter", "dropped"


def _images(raw: DataFrame, carry: Sequence[str]) -> DataFrame:
    after = F.from_json("value", ENVELOPE)["payload"]["after"]
    return evaluated_once(raw, "after", after, *carry).select("after", *carry)


def after_images(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``(after, *carry)`` for every message that holds a new row image.

    Deletes, tombstones and messages whose envelope does not parse have none.
    """
    return _images(raw, carry).filter("after IS NOT NULL")


def route(raw: DataFrame, entity: Entity, carry: Sequence[str] = ()) -> DataFrame:
    """``(route, after, data, *carry)`` for every message, parsed once.

    A message without a row image is dropped. An image is good when it yields a
    primary key, which unreadable text never does, and a dead letter otherwise.
    """
    typed = F.from_json("after", entity.schema)
    rows = evaluated_once(_images(raw, carry), "data", typed, "after", *carry)
    # Nested, so that a filter on good rows becomes one on the key and the text is not carried.
    unread = F.when(F.col("after").isNotNull(), DEAD).otherwise(DROPPED)
    way = F.when(F.col(f"data.{entity.key}").isNotNull(), GOOD).otherwise(unread)
    return rows.select(way.alias("route"), "after", "data", *carry)


def good_rows(routed: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Typed rows."""
    return routed.filter(F.col("route") == GOOD).select("data.*", *carry)


def dead_letters(routed: DataFrame, entity: Entity) -> DataFrame:
    """``(raw_value, entity)``: row images kept as text."""
    unread = routed.filter(F.col("route") == DEAD)
    return unread.select(F.col("after").alias("raw_value"), F.lit(entity.name).alias("entity"))


def unreadable_envelopes(raw: DataFrame, entity: Entity) -> DataFrame:
    """``(raw_value, entity)`` for messages that are not JSON at all.

    ``split`` drops them, as it drops deletes; this keeps them for a closer look.
    """
    broken = raw.filter(F.col("value").isNotNull() & F.try_parse_json("value").isNull())
    return broken.select(F.col("value").alias("raw_value"), F.lit(entity.name).alias("entity"))


def rejects(raw: DataFrame, entity: Entity) -> DataFrame:
    """``dead_letters`` and ``unreadable_envelopes`` of the messages, in one pass over them.

    Whether an image is dead follows from its key, so no other column is parsed.
    """
    routed = route(evaluated_once(raw, "value", F.col("value")), entity.only(), ["value"])
    dead = F.when(F.col("route") == DEAD, F.col("after"))
    broken = F.when(F.col("value").isNotNull() & F.try_parse_json("value").isNull(), F.col("value"))
    found = routed.select(F.array_compact(F.array(dead, broken)).alias("found"))
    return found.select(F.explode("found").alias("raw_value"), F.lit(entity.name).alias("entity"))


def split(
    raw: DataFrame, entity: Entity, carry: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(good, dead_letters)`` of a change stream or table."""
    routed = route(raw, entity, carry)
    return good_rows(routed, carry), dead_letters(routed, entity)


def route_counts(raw: DataFrame, entity: Entity) -> DataFrame:
    """How many messages went each way, in one pass over the input."""
    return route(raw, entity).groupBy("route").agg(F.count(F.lit(1)).alias("messages"))
