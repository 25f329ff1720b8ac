"""The contract queries: one per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.entities import DATE_COLUMN, ENTITIES
from changeloom.functions.time import change_order, with_date
from changeloom.operators.envelope import after_images, rejects, route_counts, split
from changeloom.operators.keyvalue import from_key_value, to_key_value
from changeloom.operators.serving import null_defaults, serving_projection, serving_table
from changeloom.operators.status import stamp_status
from changeloom.operators.upsert import fold, latest, retained_latest
from changeloom.plans import feeds
from changeloom.plans.serving import (
    STAR,
    cents,
    daily,
    find,
    find_indexed,
    recent,
    recent_indexed,
    register_views,
    roll_up,
    star_revenue,
)
from changeloom.session import scratch_dir, stored
from changeloom.sources.files import read_archive, read_dead_letters, read_key_values, read_table
from changeloom.sources.fileindex import FileIndex
from changeloom.sources.filesystem import make_folder, matching, move
from changeloom.sources.archive import clean_archive, merge_archive
from changeloom.sources.layout import write_bucketed, write_indexed, write_sorted
from changeloom.streaming.lifecycle import ONCE, drain
from changeloom.streaming.progress import progress_table, recorded
from changeloom.streaming.sinks import (
    FanOutTargets,
    FileSink,
    fan_out,
    start_archive,
    start_dead_letters,
    start_key_values,
)
from changeloom.streaming.job import start_separate
from changeloom.streaming.rollup import compact_rollup, read_rollup, start_rollup
from changeloom.streaming.segments import clean_segments, expire, fold_segments, merge_segments, read_segments
from changeloom.streaming.serving import compact_serving, follow_records, read_serving
from changeloom.streaming.status import compact_status, read_status, start_status
from changeloom.streaming.tables import compact, read_upserts, start_upserts, vacuum

Query = Callable[[SparkSession, str], DataFrame]

# The newest modification date in the transaction feed, at every scale.
AS_OF = date(2001, 11, 4)
# Archived events before this day are replayed from the archive, later ones from the feed.
REPLAY_FROM = date(2024, 1, 15)
# Buckets of the maintained tables here, which are small.
FEW = 4
# Days that are read from a merged archive.
SINCE, UNTIL = date(2024, 1, 10), date(2024, 1, 20)
# The newest event per user: the event stream under another key.
LAST_SEEN = replace(feeds.EVENTS, name="last_seen", key="user_id")


def log_order() -> list[Column]:
    return change_order("last_modified_ts", "off")


def good(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Good rows of an entity with ``off``, decoded through the named columns only."""
    feed = feeds.FEEDS[name](spark, folder)
    entity = feed.entity.only(*columns) if columns else feed.entity
    return split(feed.raw, entity, ["off"])[0]


def current(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The latest-state table of an entity."""
    rows = good(spark, folder, name, *columns)
    return latest(rows, ENTITIES[name].key, log_order()).drop("off")


def text_date(df: DataFrame) -> DataFrame:
    """The date as text, the form in which serving tables expose it."""
    return df.withColumn(DATE_COLUMN, F.col(DATE_COLUMN).cast("string"))


# --- decoding ---------------------------------------------------------------


def cdc_after(spark: SparkSession, folder: str) -> DataFrame:
    return after_images(feeds.transactions(spark, folder).raw)


def _cdc_good(name: str) -> Query:
    return lambda spark, folder: good(spark, folder, name).drop("off")


def _over_damaged(spark: SparkSession, folder: str, query: Callable[[feeds.Feed], DataFrame]):
    damaged = (feeds.transactions, feeds.shippings, feeds.events)
    return reduce(DataFrame.unionByName, (query(feed(spark, folder)) for feed in damaged))


def cdc_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    return _over_damaged(spark, folder, lambda feed: split(feed.raw, feed.entity)[1])


def cdc_dead_letter_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Dead letters and the messages whose envelope cannot be read."""
    return _over_damaged(spark, folder, lambda feed: rejects(feed.raw, feed.entity))


def cdc_route_counts(spark: SparkSession, folder: str) -> DataFrame:
    def counts(feed: feeds.Feed) -> DataFrame:
        return route_counts(feed.raw, feed.entity).withColumn("entity", F.lit(feed.entity.name))

    return _over_damaged(spark, folder, counts)


def cdc_date(spark: SparkSession, folder: str) -> DataFrame:
    """Dates of events, with the fraction cut off for one event type: those have none."""
    feed = feeds.events(spark, folder)
    rows = split(feed.raw, feed.entity)[0]
    whole_seconds = F.substring("last_modified_ts", 1, 19)
    uneven = rows.withColumn(
        "last_modified_ts",
        F.when(F.col("event_type") == "error", whole_seconds).otherwise(F.col("last_modified_ts")),
    )
    return text_date(with_date(uneven)).select("event_id", "last_modified_ts", DATE_COLUMN)


def cdc_kv(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_date(good(spark, folder, "transactions").drop("off"))
    return to_key_value(rows, "transaction_id")


# --- serving tables ---------------------------------------------------------


def serving_ingest(spark: SparkSession, folder: str) -> DataFrame:
    entity = feeds.PRODUCTS
    records = to_key_value(with_date(good(spark, folder, "products").drop("off")), entity.key)
    return from_key_value(records, entity)


def serving_projection_query(spark: SparkSession, folder: str) -> DataFrame:
    return serving_projection(with_date(current(spark, folder, "shippings")), feeds.SHIPPINGS)


def serving_null_defaults(spark: SparkSession, folder: str) -> DataFrame:
    served = serving_projection(with_date(current(spark, folder, "users")), feeds.USERS)
    return null_defaults(served, feeds.USERS)


def serving_table_query(spark: SparkSession, folder: str) -> DataFrame:
    """The whole serving path: records as written to the clean topic, to the table read."""
    run = scratch_dir(spark, "serving_table")
    feed = replace(feeds.event_stream(spark, folder), entity=LAST_SEEN)
    dated = with_date(split(feed.raw, LAST_SEEN, ["off"])[0])
    return _served(spark, run, dated)


def _served(spark: SparkSession, run: str, dated: DataFrame) -> DataFrame:
    drain([start_key_values(dated, LAST_SEEN, FileSink(f"{run}/kv"), f"{run}/checkpoint", ONCE)])
    records = read_key_values(spark, f"{run}/kv/{LAST_SEEN.name}")
    return serving_table(records, LAST_SEEN, ["off"])


def serving_table_ties(spark: SparkSession, folder: str) -> DataFrame:
    """The same with times cut to the day, so that most users have equal newest times."""
    run = scratch_dir(spark, "serving_table_ties")
    feed = replace(feeds.event_stream(spark, folder), entity=LAST_SEEN)
    day = F.concat(F.substring("last_modified_ts", 1, 10), F.lit(" 00:00:00.000000"))
    feed = replace(feed, rows=feed.rows.withColumn("last_modified_ts", day))
    return _served(spark, run, with_date(split(feed.raw, LAST_SEEN, ["off"])[0]))


def status_stamp(spark: SparkSession, folder: str) -> DataFrame:
    changes = stored(good(spark, folder, "transactions"), "status_stamp")
    return stamp_status(changes, "transaction_id", log_order())


def _upsert(name: str) -> Query:
    return lambda spark, folder: current(spark, folder, name)


def _retention(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        dated = with_date(good(spark, folder, name))
        return text_date(
            retained_latest(dated, ENTITIES[name], log_order(), AS_OF).drop("off")
        )

    return run


def layout_sorted(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "layout_sorted")
    # Stored, as finding the ranges reads the rows once more.
    table = stored(with_date(current(spark, folder, "transactions")), "layout_sorted_state")
    write_sorted(table, path, feeds.TRANSACTIONS)
    return text_date(spark.read.schema(table.schema).parquet(path))


def layout_bloom(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "layout_bloom")
    table = current(spark, folder, "users")
    write_indexed(table, path, feeds.USERS)
    return find(spark.read.schema(table.schema).parquet(path), user_id="7")


# --- query shapes over latest state -----------------------------------------


def served(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The latest-state table of an entity, stored once a session and state of its input.

    Sorted by time where the entity says so, with bloom filters on its lookup columns
    either way, so that lookups reach the scan as pushed filters.
    """
    owner = (spark.sparkContext.applicationId, folder, name, feeds.signature(spark, folder))
    if owner not in _SERVED:
        entity, path = ENTITIES[name], scratch_dir(spark, f"served_{name}")
        if entity.sorted_by:
            write_sorted(stored(current(spark, folder, name), f"state_{name}"), path, entity)
        else:
            write_indexed(current(spark, folder, name), path, entity)
        _SERVED[owner] = path
    return spark.read.schema(ENTITIES[name].schema).parquet(_SERVED[owner])


_SERVED: dict[tuple, str] = {}


def indexed(spark: SparkSession, folder: str, name: str) -> FileIndex:
    """The index of the files of a served table, built as often as that is stored."""
    table, entity = served(spark, folder, name), ENTITIES[name]
    path = _SERVED[spark.sparkContext.applicationId, folder, name, feeds.signature(spark, folder)]
    fresh = path not in _INDEXED
    root = scratch_dir(spark, f"index_{name}") if fresh else _INDEXED[path]
    index = FileIndex(spark, root, table.schema, entity.bloom, entity.sorted_by)
    if fresh:
        index.add(path)
        _INDEXED[path] = root
    return index


_INDEXED: dict[str, str] = {}


def q_point_lookup_indexed(spark: SparkSession, folder: str) -> DataFrame:
    return find_indexed(indexed(spark, folder, "products"), product_id="10")


def q_user_lookup_indexed(spark: SparkSession, folder: str) -> DataFrame:
    return find_indexed(indexed(spark, folder, "transactions"), user_id="7")


def q_filter_keys_indexed(spark: SparkSession, folder: str) -> DataFrame:
    wanted = {"user_id": ["3", "7", "42"], "status": "INSERT"}
    return find_indexed(indexed(spark, folder, "transactions"), **wanted)


def q_recent_indexed(spark: SparkSession, folder: str) -> DataFrame:
    return recent_indexed(
        indexed(spark, folder, "transactions"),
        "last_modified_ts",
        "1996-01-01 00:00:00.000000",
        "2000-12-31 23:59:59.999999",
        100,
        "transaction_id",
    )


def q_point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return find(served(spark, folder, "products"), product_id="10")


def q_user_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return find(served(spark, folder, "transactions"), user_id="7")


def q_filter_status(spark: SparkSession, folder: str) -> DataFrame:
    return find(served(spark, folder, "products"), status="UPDATE")


def q_filter_keys(spark: SparkSession, folder: str) -> DataFrame:
    wanted = {"user_id": ["3", "7", "42"], "status": "INSERT"}
    return find(served(spark, folder, "transactions"), **wanted)


def q_recent(spark: SparkSession, folder: str) -> DataFrame:
    return recent(
        served(spark, folder, "transactions"),
        "last_modified_ts",
        "1996-01-01 00:00:00.000000",
        "2000-12-31 23:59:59.999999",
        100,
        "transaction_id",
    )


def q_metrics_by_dim(spark: SparkSession, folder: str) -> DataFrame:
    return roll_up(
        current(spark, folder, "transactions", "payment_id", "quantity", "discount", "status"),
        ["payment_id", "status"],
        {
            "orders": F.count(F.lit(1)),
            "units": F.sum("quantity"),
            "avg_discount": F.avg("discount"),
            "min_quantity": F.min("quantity"),
            "max_quantity": F.max("quantity"),
        },
    )


def q_product_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return roll_up(
        current(spark, folder, "products", "category", "unit_price", "rating"),
        ["category"],
        {
            "products": F.count(F.lit(1)),
            "price_cents": F.sum(cents("unit_price")),
            "min_price": F.min("unit_price"),
            "max_price": F.max("unit_price"),
            "max_rating": F.max("rating"),
        },
    )


def q_shipping_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return roll_up(
        current(spark, folder, "shippings", "shipping_status", "shipping_cost"),
        ["shipping_status"],
        {
            "shippings": F.count(F.lit(1)),
            "cost_cents": F.sum(cents("shipping_cost")),
            "max_cost": F.max("shipping_cost"),
        },
    )


def q_daily(spark: SparkSession, folder: str) -> DataFrame:
    days = daily(
        with_date(current(spark, folder, "transactions", "quantity", "discount")),
        {
            "orders": F.count(F.lit(1)),
            "units": F.sum("quantity"),
            "avg_discount": F.avg("discount"),
        },
    )
    return text_date(days)


def q_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The ad hoc path: SQL text over the stored tables of all entities."""
    register_views({name: served(spark, folder, name) for name in feeds.FEEDS})
    return spark.sql(
        """
        SELECT p.merchant_name, count(*) AS orders, sum(t.quantity) AS units
        FROM transactions t LEFT JOIN products p ON t.product_id = p.product_id
        GROUP BY p.merchant_name
        """
    )


def q_star_revenue(spark: SparkSession, folder: str) -> DataFrame:
    # Stored, so that the engine knows the dimensions' sizes before it plans the joins.
    tables = {name: served(spark, folder, name) for name in feeds.FEEDS}
    return star_revenue(tables, ["category", "job", "payment_method", "shipping_status"])


def q_star_colocated(spark: SparkSession, folder: str) -> DataFrame:
    """The same with transactions and shippings stored in the same buckets."""
    tables = {name: served(spark, folder, name) for name in feeds.FEEDS}
    for name in ("transactions", "shippings"):
        path = scratch_dir(spark, f"bucketed_{name}")
        tables[name] = write_bucketed(tables[name], path, "shipping_id", 8)
    return star_revenue(tables, ["category", "job", "payment_method", "shipping_status"])


# --- streams ----------------------------------------------------------------


def _event_split(spark: SparkSession, folder: str, entity=feeds.EVENTS):
    feed = replace(feeds.event_stream(spark, folder), entity=entity)
    good_events, dead = split(feed.raw, entity, ["off"])
    return with_date(good_events), dead


def stream_cdc_source(spark: SparkSession, folder: str) -> DataFrame:
    run = scratch_dir(spark, "stream_cdc_source")
    rows = _event_split(spark, folder)[0].drop("off", DATE_COLUMN)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{run}/checkpoint")
    drain([writer.trigger(**ONCE).start(f"{run}/rows")])
    return spark.read.schema(rows.schema).parquet(f"{run}/rows")


def stream_kv_sink(spark: SparkSession, folder: str) -> DataFrame:
    run = scratch_dir(spark, "stream_kv_sink")
    dated = _event_split(spark, folder)[0]
    drain([start_key_values(dated, feeds.EVENTS, FileSink(f"{run}/kv"), f"{run}/checkpoint", ONCE)])
    return read_key_values(spark, f"{run}/kv/events").select("key", "value")


def stream_archive(spark: SparkSession, folder: str) -> DataFrame:
    run = scratch_dir(spark, "stream_archive")
    dated = _event_split(spark, folder)[0]
    drain([start_archive(dated, feeds.EVENTS, f"{run}/archive", f"{run}/checkpoint", ONCE)])
    return text_date(read_archive(spark, f"{run}/archive/events", feeds.EVENTS))


def stream_dlq(spark: SparkSession, folder: str) -> DataFrame:
    run = scratch_dir(spark, "stream_dlq")
    dead = _event_split(spark, folder)[1]
    drain([start_dead_letters(dead, feeds.EVENTS, f"{run}/dlq", f"{run}/checkpoint", ONCE)])
    return read_dead_letters(spark, f"{run}/dlq/events")


def archive_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Latest state rebuilt from the archive up to a day and the change feed from it."""
    run = scratch_dir(spark, "archive_replay")
    dated = _event_split(spark, folder, LAST_SEEN)[0]
    drain([start_archive(dated, LAST_SEEN, f"{run}/archive", f"{run}/checkpoint", ONCE)])

    history = read_archive(spark, f"{run}/archive/last_seen", LAST_SEEN, until=REPLAY_FROM)
    feed = replace(feeds.events(spark, folder), entity=LAST_SEEN)
    fresh = with_date(split(feed.raw, LAST_SEEN, ["off"])[0])
    fresh = fresh.filter((F.col(DATE_COLUMN) >= F.lit(REPLAY_FROM)) | F.col(DATE_COLUMN).isNull())
    return text_date(fold(history, fresh, LAST_SEEN.key, log_order()).drop("off"))


def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    run = scratch_dir(spark, "stream_upsert")
    dated = _event_split(spark, folder, LAST_SEEN)[0]
    drain([start_upserts(dated, LAST_SEEN, log_order(), f"{run}/table", f"{run}/checkpoint", ONCE)])
    table = read_upserts(spark, f"{run}/table", LAST_SEEN, log_order())
    return text_date(table.drop("off"))


MESSAGE = "value STRING, off BIGINT"


def _messages(spark: SparkSession, folder: str, name: str, run: str) -> DataFrame:
    """The change messages of an entity, as files that arrive in a folder."""
    feeds.FEEDS[name](spark, folder).raw.write.parquet(f"{run}/{name}-messages")
    return spark.readStream.schema(MESSAGE).parquet(f"{run}/{name}-messages")


def _dealt(feed: feeds.Feed, path: str, *labels: Column) -> str:
    """The change messages of a feed, made once, in a folder for each combination of labels."""
    texts = (F.coalesce(label.cast("string"), F.lit("none")) for label in labels)
    feed.raw.withColumn("part", F.concat_ws("-", *texts)).write.partitionBy("part").parquet(path)
    return path


def _in_parts(spark: SparkSession, feed: feeds.Feed, waiting: str, run: str, parts: list[str]):
    """The decoded changes of a feed as a stream, once for each part that has arrived: its
    files move from the folder where they wait to the one that the stream reads."""
    arrived = f"{run}/messages"
    make_folder(spark, arrived)
    for part in parts:
        for dealt in matching(spark, f"{waiting}/part={part}"):
            move(spark, dealt, f"{arrived}/{dealt.rsplit('/', 1)[1]}")
        raw = spark.readStream.schema(MESSAGE).option("recursiveFileLookup", "true").parquet(arrived)
        yield split(raw, feed.entity, ["off"])[0]


def _third() -> Column:
    return F.pmod(F.xxhash64("off"), F.lit(3))


def _in_thirds(spark: SparkSession, feed: feeds.Feed, run: str, *numbers: int):
    waiting = _dealt(feed, f"{run}/waiting", _third())
    return _in_parts(spark, feed, waiting, run, [str(n) for n in numbers])


def _in_orders(spark: SparkSession, feed: feeds.Feed, purpose: str):
    """The same changes in thirds, newest first and not, then in halves, for a table each:
    (name, its folder, its streams). The halves wait where the thirds have arrived."""
    waiting = _dealt(feed, scratch_dir(spark, f"{purpose}_waiting"), _third(), F.col("off") % 2 == 1)
    for name, parts in {"thirds": ["2-*", "0-*", "1-*"], "halves": ["*-true", "*-false"]}.items():
        run = scratch_dir(spark, f"{purpose}_{name}")
        yield name, run, _in_parts(spark, feed, waiting, run, parts)
        waiting = f"{run}/messages"


def stream_upsert_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """A maintained table: three batches with compaction, retention and clean-up between."""
    run, entity = scratch_dir(spark, "stream_upsert_transactions"), feeds.TRANSACTIONS
    for rows in _in_thirds(spark, feeds.transactions(spark, folder), run, 0, 1, 2):
        ends = (f"{run}/table", f"{run}/checkpoint", ONCE)
        drain([start_upserts(with_date(rows), entity, log_order(), *ends)])
        compact(spark, f"{run}/table", entity, log_order(), AS_OF, buckets=FEW)
        vacuum(spark, f"{run}/table", entity)
    return text_date(read_upserts(spark, f"{run}/table", entity, log_order(), AS_OF).drop("off"))


def _undated(spark: SparkSession, folder: str) -> feeds.Feed:
    """Transactions of which a seventh have times without a fraction, hence no date."""
    feed = feeds.transactions(spark, folder)
    seventh = F.expr("off DIV 1000000 % 7 = 0")
    time = F.when(seventh, F.substring("last_modified_ts", 1, 19)).otherwise(F.col("last_modified_ts"))
    return replace(feed, rows=feed.rows.withColumn("last_modified_ts", time))


def stream_upsert_undated(spark: SparkSession, folder: str) -> DataFrame:
    """Compaction with retention between batches, newest first and not, with undated changes."""
    feed, entity = _undated(spark, folder), feeds.TRANSACTIONS
    tables = []
    for name, run, batches in _in_orders(spark, feed, "stream_upsert_undated"):
        for rows in batches:
            ends = (f"{run}/table", f"{run}/checkpoint", ONCE)
            drain([start_upserts(with_date(rows), entity, log_order(), *ends)])
            compact(spark, f"{run}/table", entity, log_order(), AS_OF, buckets=FEW)
            vacuum(spark, f"{run}/table", entity)
        table = read_upserts(spark, f"{run}/table", entity, log_order(), AS_OF)
        tables.append(text_date(table.drop("off")).withColumn("batches", F.lit(name)))
    return reduce(DataFrame.unionByName, tables)


def stream_upsert_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments by day: batches newest first and not, with undated changes, while the window
    moves on by days; one table merges its files between."""
    feed, entity = _undated(spark, folder), feeds.TRANSACTIONS
    tables = []
    for name, run, batches in _in_orders(spark, feed, "stream_upsert_segments"):
        for number, rows in enumerate(batches):
            ends, day = (f"{run}/table", f"{run}/checkpoint", ONCE), AS_OF - timedelta(days=9 - 2 * number)
            drain([start_upserts(with_date(rows), entity, log_order(), *ends)])
            fold_segments(spark, f"{run}/table", entity, log_order(), day, FEW)
            if name == "thirds":
                merge_segments(spark, f"{run}/table", entity, crowded=2)
        expire(spark, f"{run}/table", entity, AS_OF)
        clean_segments(spark, f"{run}/table")
        table = read_segments(spark, f"{run}/table", entity, log_order())
        tables.append(text_date(table.drop("off")).withColumn("batches", F.lit(name)))
    return reduce(DataFrame.unionByName, tables)


def serving_live(spark: SparkSession, folder: str) -> DataFrame:
    """Both hops as streams: changes to records, records to the serving table. The second
    is stopped while the first goes on, and resumes."""
    run = scratch_dir(spark, "serving_live")
    for half in _halves(spark, folder, run):
        feed = replace(feeds.event_stream(spark, half), entity=LAST_SEEN)
        dated = with_date(split(feed.raw, LAST_SEEN, ["off"])[0])
        ends = (FileSink(f"{run}/kv"), f"{run}/checkpoint-{half.rsplit('/', 1)[1]}", ONCE)
        drain([start_key_values(dated, LAST_SEEN, *ends)])
        second = (f"{run}/kv/{LAST_SEEN.name}", LAST_SEEN, f"{run}/table", f"{run}/hop", ONCE)
        drain([follow_records(spark, *second)])
        compact_serving(spark, f"{run}/table", LAST_SEEN, FEW)
    return read_serving(spark, f"{run}/table", LAST_SEEN)


def status_live(spark: SparkSession, folder: str) -> DataFrame:
    """Status stamps in three batches that mix early and late changes, state folded between."""
    run, feed = scratch_dir(spark, "status_live"), feeds.transactions(spark, folder)
    for rows in _in_thirds(spark, feed, run, 1, 2, 0):
        drain([start_status(rows, feed.entity, f"{run}/table", f"{run}/checkpoint", ONCE)])
        compact_status(spark, f"{run}/table", feed.entity, FEW)
    return read_status(spark, f"{run}/table", feed.entity)


def _live_rollup(spark: SparkSession, folder: str, run: str, by: dict, sums: dict) -> DataFrame:
    feed, names = feeds.transactions(spark, folder), (list(by), list(sums))
    for number, rows in enumerate(_in_thirds(spark, feed, run, 2, 1, 0)):
        ends = (f"{run}/table", f"{run}/checkpoint", ONCE)
        drain([start_rollup(with_date(rows), feed.entity, log_order(), by, sums, *ends)])
        if number < 2:
            compact_rollup(spark, f"{run}/table", feed.entity, log_order(), *names, FEW)
    return read_rollup(spark, f"{run}/table", *names)


def rollup_live_daily(spark: SparkSession, folder: str) -> DataFrame:
    """The daily roll-up, kept up to date over three batches with retraction."""
    sums = {name: F.col(name) for name in ("quantity", "discount")}
    run = scratch_dir(spark, "rollup_live_daily")
    days = _live_rollup(spark, folder, run, {DATE_COLUMN: F.col(DATE_COLUMN)}, sums)
    average = (F.col("discount") / F.col("rows")).alias("avg_discount")
    return text_date(days).select(DATE_COLUMN, F.col("rows").alias("orders"), F.col("quantity").alias("units"), average)


def rollup_live_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The same by payment and status; least and greatest quantity over the combinations left."""
    by = {name: F.col(name) for name in ("payment_id", "status", "quantity")}
    run = scratch_dir(spark, "rollup_live_metrics")
    parts = _live_rollup(spark, folder, run, by, {"discount": F.col("discount")})
    return roll_up(
        parts,
        ["payment_id", "status"],
        {
            "orders": F.sum("rows"),
            "units": F.sum(F.col("rows") * F.col("quantity")),
            "avg_discount": F.sum("discount") / F.sum("rows"),
            "min_quantity": F.min("quantity"),
            "max_quantity": F.max("quantity"),
        },
    )


def archive_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Some days of an archive whose batches have been merged, and of one more batch since."""
    run = scratch_dir(spark, "archive_merged")
    path = f"{run}/archive/events"
    feed = feeds.events(spark, folder)
    for number, rows in enumerate(_in_thirds(spark, feed, run, 0, 1, 2)):
        drain([start_archive(with_date(rows), feed.entity, f"{run}/archive", f"{run}/checkpoint", ONCE)])
        if number < 2:
            merge_archive(spark, path, feed.entity, crowded=2)
            clean_archive(spark, path)
    return text_date(read_archive(spark, path, feed.entity, SINCE, UNTIL))


def _targets(run: str, checkpoint: str = "checkpoint") -> FanOutTargets:
    return FanOutTargets(
        f"{run}/archive", f"{run}/dlq", FileSink(f"{run}/kv"), f"{run}/{checkpoint}"
    )


def _fan_out_events(spark: SparkSession, folder: str, run: str, checkpoint: str = "checkpoint"):
    raw = feeds.event_stream(spark, folder).raw
    return fan_out(raw, feeds.EVENTS, _targets(run, checkpoint), ["off"], trigger=ONCE)


def _published(spark: SparkSession, run: str, entity=feeds.EVENTS) -> DataFrame:
    """What a fan-out wrote, one line per record and output."""
    archived = read_archive(spark, f"{run}/archive/{entity.name}", entity)
    records = read_key_values(spark, f"{run}/kv/{entity.name}")
    dead = read_dead_letters(spark, f"{run}/dlq/{entity.name}")
    return (
        archived.select(F.lit("archive").alias("output"), F.col(entity.key).alias("content"))
        .unionByName(records.select(F.lit("key_value").alias("output"), F.col("value").alias("content")))
        .unionByName(dead.select(F.lit("dead_letter").alias("output"), F.col("raw_value").alias("content")))
    )


def stream_fanout(spark: SparkSession, folder: str) -> DataFrame:
    run = scratch_dir(spark, "stream_fanout")
    drain([_fan_out_events(spark, folder, run)])
    return _published(spark, run)


def _stream_fanout(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        run, entity = scratch_dir(spark, f"stream_fanout_{name}"), ENTITIES[name]
        raw = _messages(spark, folder, name, run)
        drain([fan_out(raw, entity, _targets(run), ["off"], trigger=ONCE)])
        return _published(spark, run, entity)

    return query


def _halves(spark: SparkSession, folder: str, run: str):
    """Folders of the events before a day and from it on."""
    table = read_table(spark, folder, "events")
    early = F.col("ts") < F.lit(REPLAY_FROM)
    for name, part in zip(("early", "late"), (early, ~early | F.col("ts").isNull()), strict=True):
        table.filter(part).write.parquet(f"{run}/{name}/events.parquet")
        yield f"{run}/{name}"


def stream_fresh_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """The checkpoint is lost between the two halves: history stays, and new changes join it."""
    run = scratch_dir(spark, "stream_fresh_checkpoint")
    for k, half in enumerate(_halves(spark, folder, run)):
        drain([_fan_out_events(spark, half, run, f"checkpoint-{k}")])
    return _published(spark, run)


def stream_mode_switch(spark: SparkSession, folder: str) -> DataFrame:
    """Three separate queries, then one fan-out, on the same targets."""
    run = scratch_dir(spark, "stream_mode_switch")
    early, late = _halves(spark, folder, run)
    source = feeds.event_stream(spark, early).raw
    drain(start_separate(lambda entity: source, [feeds.EVENTS], _targets(run), trigger=ONCE))
    drain([_fan_out_events(spark, late, run)])
    return _published(spark, run)


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Fan out half of the events, stop, add the rest and resume from the checkpoint."""
    run = scratch_dir(spark, "stream_restart")
    arriving = f"{run}/source/events.parquet"
    table = read_table(spark, folder, "events")
    early = F.col("ts") < F.lit(REPLAY_FROM)
    for part in (table.filter(early), table.filter(~early | F.col("ts").isNull())):
        part.write.mode("append").parquet(arriving)
        drain([_fan_out_events(spark, f"{run}/source", run)])
    return _published(spark, run)


def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Input rows per query, summed over the progress records of its batches."""
    run = scratch_dir(spark, "stream_progress")
    dated = _event_split(spark, folder)[0]
    with recorded(spark, f"{run}/metrics"):
        drain([start_archive(dated, feeds.EVENTS, f"{run}/archive", f"{run}/checkpoint", ONCE)])
    metrics = progress_table(spark, f"{run}/metrics")
    return metrics.groupBy("query").agg(F.sum("input_rows").alias("input_rows"))


QUERIES: dict[str, Query] = {
    "q_star_revenue": q_star_revenue,
    "q_star_colocated": q_star_colocated,
    "cdc_after": cdc_after,
    **{f"cdc_good_{name}": _cdc_good(name) for name in feeds.FEEDS},
    "cdc_dead_letter": cdc_dead_letter,
    "cdc_dead_letter_envelope": cdc_dead_letter_envelope,
    "cdc_route_counts": cdc_route_counts,
    "cdc_date": cdc_date,
    "cdc_kv": cdc_kv,
    "serving_ingest": serving_ingest,
    "serving_projection": serving_projection_query,
    "serving_null_defaults": serving_null_defaults,
    "serving_table": serving_table_query,
    "serving_table_ties": serving_table_ties,
    "status_stamp": status_stamp,
    **{f"upsert_{name}": _upsert(name) for name in feeds.FEEDS},
    "retention_transactions": _retention("transactions"),
    "retention_shippings": _retention("shippings"),
    "layout_sorted": layout_sorted,
    "layout_bloom": layout_bloom,
    "q_point_lookup": q_point_lookup,
    "q_user_lookup": q_user_lookup,
    "q_filter_status": q_filter_status,
    "q_filter_keys": q_filter_keys,
    "q_recent": q_recent,
    "q_point_lookup_indexed": q_point_lookup_indexed,
    "q_user_lookup_indexed": q_user_lookup_indexed,
    "q_filter_keys_indexed": q_filter_keys_indexed,
    "q_recent_indexed": q_recent_indexed,
    "q_metrics_by_dim": q_metrics_by_dim,
    "q_product_metrics": q_product_metrics,
    "q_shipping_metrics": q_shipping_metrics,
    "q_daily": q_daily,
    "q_sql": q_sql,
    "stream_cdc_source": stream_cdc_source,
    "stream_kv_sink": stream_kv_sink,
    "stream_archive": stream_archive,
    "stream_dlq": stream_dlq,
    "archive_replay": archive_replay,
    "stream_upsert": stream_upsert,
    "stream_upsert_transactions": stream_upsert_transactions,
    "stream_upsert_undated": stream_upsert_undated,
    "stream_upsert_segments": stream_upsert_segments,
    "serving_live": serving_live,
    "status_live": status_live,
    "rollup_live_daily": rollup_live_daily,
    "rollup_live_metrics": rollup_live_metrics,
    "archive_merged": archive_merged,
    "stream_fanout": stream_fanout,
    **{f"stream_fanout_{name}": _stream_fanout(name) for name in feeds.FEEDS},
    "stream_fresh_checkpoint": stream_fresh_checkpoint,
    "stream_mode_switch": stream_mode_switch,
    "stream_restart": stream_restart,
    "stream_progress": stream_progress,
}
