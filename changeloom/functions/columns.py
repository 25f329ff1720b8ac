from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """``keep`` plus ``value AS name``, with ``value`` computed once per row.

    Filters and field accesses on an ordinary projection are pushed below it,
    which repeats an expensive expression such as ``from_json`` in every one of
    them. Nothing is pushed below a generator over its own output, so after
    exploding a one-element array every later step reads the finished value. The
    value itself stays in a projection of its own: the generator then runs inside
    generated code.
    """
    computed = df.select(*keep, value.alias(name))
    return computed.select(*keep, F.explode(F.array(name)).alias(name))
