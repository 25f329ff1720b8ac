"""Sharding by balanced label propagation, with DataFrame operations only.

Documents with equal texts are linked. Every row starts with a label by hash, and each group of
linked rows asks for the shard of most of its labels among those that still have room for it
whole. A shard takes what asks for it, largest first, up to its quota; the others ask again with
what room is left. Quotas are the even counts themselves, so that counts are at most one apart
(law ``rows``), and rows without links take the places that remain.

Groups larger than any room are split, and only those: they fill the emptiest shards and put the
rest where it fits. There are fewer of them than shards, as all that is left fits into all rooms
together; they and the last ``TAIL`` groups are placed on the driver. Larger groups go first: while
the largest one left is over ``FINE`` of a quota, only those of at least half its size ask.

Groups are counted before they are joined, and a round's running sums come from counts by bucket, so
that no task sees a whole shard. Rows of large groups (at most ``1 / LARGE`` of them) find their
shard by a small table, all others by a join on the group. Labels, ties and places follow hashes
of id and text, so that the same rows get the same shards however they are dealt out.

Defined results: a null text has size 1, the checksum of no bytes, and no links. Rows
repeated in full are rows of their own. Ids can be null or repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import stored

SHARDS, PER_BUCKET, TAIL = 8, 100_000, 1000
#: Shares of a quota and of all rows: see above.
FINE, LARGE = 1 / 64, 1 / 512


def _ranked(rows: DataFrame, keys: list[str], buckets: int, name: str) -> DataFrame:
    """``name``: a gapless rank from 0 among the rows with equal ``keys``."""
    rows = rows.withColumn("bucket_", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    sizes = rows.groupBy(*keys, "bucket_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(*keys).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("base_", F.coalesce(F.sum("n_").over(before), F.lit(0))).drop("n_")
    within = Window.partitionBy(*keys, "bucket_").orderBy("key", "row_id")
    return (
        rows.withColumn("rank_", F.row_number().over(within) - 1)
        .join(sizes, [*keys, "bucket_"])
        .withColumn(name, F.col("base_") + F.col("rank_"))
        .drop("bucket_", "base_", "rank_")
    )


def _before(groups: DataFrame, buckets: int) -> DataFrame:
    """``before``: rows of the groups that come first under the same ``goal``, larger sizes first."""
    size = F.floor(F.log2("left")).cast("int")
    groups = groups.withColumn("size_", -size).withColumn("bucket_", F.pmod(F.xxhash64("group"), F.lit(buckets)))
    sums = groups.groupBy("goal", "size_", "bucket_").agg(F.sum("left").alias("n_"))
    over = Window.partitionBy("goal").orderBy("size_", "bucket_").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base_", F.coalesce(F.sum("n_").over(over), F.lit(0))).drop("n_")
    within = Window.partitionBy("goal", "size_", "bucket_").orderBy("group")
    own = F.sum("left").over(within.rowsBetween(Window.unboundedPreceding, -1))
    return (
        groups.withColumn("own_", F.coalesce(own, F.lit(0)))
        .join(sums, ["goal", "size_", "bucket_"])
        .withColumn("before", F.col("base_") + F.col("own_"))
        .drop("size_", "bucket_", "base_", "own_")
    )


def _by_shard(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def place(left: int, votes: list[int], room: list[int]) -> list[tuple[int, int]]:
    """Shards and numbers of rows for one group, and less room: whole where it was labelled most
    if it fits there, else where it fits, else over as few shards as it takes."""
    found = []
    while left:
        fits = [s for s in range(len(room)) if room[s] >= left]
        if fits:
            shard = max(fits, key=lambda s: (votes[s], -room[s], -s))
        else:
            shard = max(range(len(room)), key=lambda s: (room[s], -s))
        take = min(left, room[shard])
        found.append((shard, take))
        room[shard] -= take
        left -= take
    return found


def assign(groups: DataFrame, room: list[int], buckets: int) -> tuple[DataFrame, list[int]]:
    """``group``, ``shard``, ``start`` and ``stop`` (of the group's rows, from 0), and what room
    is left. ``groups``: ``group``, ``left`` rows, ``votes`` by shard."""
    spark, room = groups.sparkSession, list(room)
    quota, schema = max(room), "group long, shard int, start long, stop long"
    done = spark.createDataFrame([], schema)

    def on_the_driver(some: DataFrame) -> DataFrame:
        rows = []
        for row in sorted(some.collect(), key=lambda r: (-r.left, r.group)):
            start = 0
            for shard, take in place(row.left, row.votes, room):
                rows.append((row.group, shard, start, start + take))
                start += take
        return spark.createDataFrame(rows, schema)

    number = 0
    while True:
        state = groups.agg(F.count(F.lit(1)).alias("n"), F.max("left").alias("most")).first()
        if state.n <= TAIL:
            return done.union(on_the_driver(groups)), room
        if state.most > max(room):
            # Fewer than there are shards.
            done = done.union(on_the_driver(groups.filter(F.col("left") > max(room))))
            groups = groups.join(done.select("group").distinct(), "group", "left_anti")
            groups = stored(groups, "shard-groups")
            continue
        least = 1 if state.most <= quota * FINE else state.most // 2
        number += 1
        wishes = [
            F.when(
                F.lit(room[s]) >= F.col("left"),
                F.struct(F.col("votes")[s].alias("votes"), F.xxhash64("group", F.lit(s), F.lit(number)).alias("tie"), F.lit(s).alias("goal")),
            )
            for s in range(len(room))
        ]
        goal = F.array_max(F.array(*wishes))["goal"]
        asking = groups.filter(F.col("left") >= least).withColumn("goal", goal)
        fits = F.col("before") + F.col("left") <= _by_shard(room)[F.col("goal")]
        taken = stored(_before(asking, buckets).filter(fits).select("group", "goal", "left"), "shard-taken")
        for row in taken.groupBy("goal").agg(F.sum("left").alias("n")).collect():
            room[row.goal] -= row.n
        done = done.union(taken.select("group", F.col("goal").alias("shard"), F.lit(0).cast("long").alias("start"), F.col("left").alias("stop")))
        groups = stored(groups.join(taken.select("group"), "group", "left_anti"), "shard-groups")


def shard_rows(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row a document: ``id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and
    ``grown_shard``."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(F.encode(content, "utf-8")).alias("text_crc32"),
        F.when(F.col(text).isNotNull(), F.xxhash64(text, F.octet_length(text), F.crc32(F.encode(content, "utf-8")))).alias("group"),
        F.xxhash64(id, text).alias("key"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    rows = stored(rows, "shard-rows")
    n = rows.count()
    buckets = max(64, n // PER_BUCKET)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    label = F.pmod(F.xxhash64("key", F.lit("label")), F.lit(shards))
    votes = [F.count_if(label == s) for s in range(shards)]
    groups = rows.filter("group IS NOT NULL").groupBy("group").agg(F.count(F.lit(1)).alias("left"), F.array(*votes).alias("votes"))
    groups = stored(groups.filter("left > 1"), "shard-groups")
    assigned, room = assign(groups, room, buckets) if n else (groups.selectExpr("group", "0 AS shard", "0L AS start", "0L AS stop"), room)
    assigned = stored(assigned, "shard-assigned")

    # At most 1 / LARGE groups, and shards each.
    several = Window.partitionBy("group")
    parts = assigned.withColumn("parts", F.count(F.lit(1)).over(several)).withColumn("all", F.max("stop").over(several))
    large = stored(parts.filter((F.col("parts") > 1) | (F.col("all") > n * LARGE)), "shard-large")
    names = F.broadcast(large.groupBy("group").agg(F.max("parts").alias("parts"), F.min("shard").alias("only")))
    marked = rows.join(names, "group", "left")
    whole = marked.filter("parts = 1").select(*rows.columns, F.col("only").alias("shard"))
    cut = _ranked(marked.filter("parts > 1").select(rows.columns), ["group"], buckets, "place")
    cut = cut.join(F.broadcast(large.select("group", "shard", "start", "stop")), "group")
    cut = cut.filter("place >= start AND place < stop").select(*rows.columns, "shard")
    rest = marked.filter("parts IS NULL").select(rows.columns)
    small = parts.filter((F.col("parts") == 1) & (F.col("all") <= n * LARGE)).select("group", "shard")
    named = rest.filter("group IS NOT NULL").join(small, "group", "left")
    linked = named.filter("shard IS NOT NULL").select(*rows.columns, "shard")
    single = named.filter("shard IS NULL").select(rows.columns).union(rest.filter("group IS NULL"))
    single = _ranked(single.withColumn("all_", F.lit(0)), ["all_"], buckets, "place")
    ends = [sum(room[: s + 1]) for s in range(shards)]
    shard = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        shard = F.when(F.col("place") < ends[s], F.lit(s)).otherwise(shard)
    single = single.select(*rows.columns, shard.alias("shard"))
    placed = stored(whole.union(cut).union(linked).union(single), "shards")
    return _ranked(placed.withColumn("shard", F.col("shard").cast("int")), ["shard"], buckets, "slot").select(
        "id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
