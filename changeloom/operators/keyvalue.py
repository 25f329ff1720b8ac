from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.entities import Entity
from changeloom.functions.columns import evaluated_once


def to_key_value(df: DataFrame, key: str, carry: Sequence[str] = ()) -> DataFrame:
    """``(key, value, *carry)``: the key as text and the row as JSON, NULLs left out.

    Columns to ``carry`` stand beside the JSON, not in it.

    Keyed by the primary key so that every change of a row lands, in order, in
    one topic partition.
    """
    row = F.to_json(F.struct(*(name for name in df.columns if name not in carry)))
    return df.select(
        F.col(key).cast("string").alias("key"), row.alias("value"), *carry
    )


def from_key_value(records: DataFrame, entity: Entity, carry: Sequence[str] = ()) -> DataFrame:
    """Decode key/value records into the columns the serving table exposes."""
    parsed = evaluated_once(records, "row", F.from_json("value", entity.serving_schema), *carry)
    return parsed.select("row.*", *carry)
