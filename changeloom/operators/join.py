from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The most keys that the engine's sketches can track, enough for 125,000 partitions.
MOST_TRACKED = 1_000_000


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(facts: DataFrame, *keys: str, partitions: int | None = None) -> dict[str, list]:
    """Per key column, the values (NULL included) found in over half a partition's even share.

    The more partitions, the smaller the share that makes one of them late, so the
    threshold follows their number; at most twice as many keys can pass it, and the sketches
    track four times as many as that. One pass over the key columns, merged in two levels:
    first by groups of tasks, about as many as the square root of the partitions, so
    that no task receives the sketches of all. Counts are approximate, which is fine
    for deciding what to spread; no result depends on them.
    """
    if not keys or facts.isEmpty():
        return {key: [] for key in keys}
    partitions = partitions or partitions_of(facts.sparkSession)
    most = min(2 * partitions, 100_000)
    tracked = min(max(4 * most, 1024), MOST_TRACKED)
    # Whole tasks go to a group, so that each sends one sketch.
    group = F.spark_partition_id() % F.lit(math.isqrt(partitions) + 1)
    sketch = [F.expr(f"approx_top_k_accumulate({k}, {tracked})").alias(f"s{i}") for i, k in enumerate(keys)]
    parts = facts.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("n"), *sketch)
    whole = [
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(s{i}, {tracked}), {most})")
        for i in range(len(keys))
    ]
    summary = parts.agg(F.sum("n"), *whole).first()
    total, tops = summary[0] or 0, summary[1:]
    return {
        key: [entry["item"] for entry in top or [] if entry["count"] * 2 * partitions > total]
        for key, top in zip(keys, tops, strict=True)
    }


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    heavy: Sequence = (),
    spread_by: Sequence[str] = (),
    salts: int | None = None,
) -> DataFrame:
    """Left equi-join of facts to a dimension that has one row per ``key``.

    Facts under a ``heavy`` key, or under none if NULL is heavy, are spread over
    ``salts`` sub-keys; only the dimension rows of heavy keys are repeated to meet
    them, a bounded number. Without heavy keys this is a plain
    join. Whether the dimension is small enough to broadcast is left to the
    engine, which checks its size. The salt hashes ``spread_by`` (together unique)
    rather than drawing random numbers, so that a recomputed task sends its rows
    to the same place.
    """
    if not heavy:
        return facts.join(dimension, key, "left")
    if not spread_by:
        raise ValueError("heavy keys need columns to spread their rows by")
    if salts is None:
        salts = partitions_of(facts.sparkSession)

    is_heavy = F.col(key).isin([value for value in heavy if value is not None])
    if None in heavy:
        is_heavy = F.col(key).isNull() | is_heavy
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    every_salt = F.sequence(F.lit(0), F.lit(salts - 1))
    return (
        facts.withColumn("_salt", F.when(is_heavy, salt).otherwise(0))
        .join(
            dimension.withColumn(
                "_salt", F.explode(F.when(is_heavy, every_salt).otherwise(F.array(F.lit(0))))
            ),
            [key, "_salt"],
            "left",
        )
        .drop("_salt")
    )
