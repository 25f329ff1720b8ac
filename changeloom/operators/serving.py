from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.entities import DATE_COLUMN, Entity
from changeloom.functions.time import change_order
from changeloom.operators.keyvalue import from_key_value
from changeloom.operators.upsert import latest


def serving_projection(dated: DataFrame, entity: Entity) -> DataFrame:
    """The columns, order and types of the entity's serving table."""
    return dated.select(
        *(F.col(field.name).cast(field.dataType) for field in entity.serving_schema)
    )


def null_defaults(
    served: DataFrame, entity: Entity, text: str = "null", number: int = 0
) -> DataFrame:
    """Replace missing values by type, for tables served without NULLs."""
    fills = {
        name: number if name in entity.metrics else text
        for name in (*entity.dimensions, *entity.metrics, *entity.times, DATE_COLUMN)
    }
    return served.na.fill(fills)


def serving_table(records: DataFrame, entity: Entity, ties: Sequence[str]) -> DataFrame:
    """The table a reader sees: key/value records decoded, newest per key, without NULLs.

    ``ties`` names columns of ``records``, such as the position in the log, that settle
    equal times; without any, equal times would leave the row to chance.
    """
    if not ties:
        raise ValueError("name the columns that settle equal times")
    rows = from_key_value(records, entity, ties)
    newest = latest(rows, entity.key, change_order(entity.modified_at, *ties))
    return null_defaults(newest.drop(*ties), entity)
