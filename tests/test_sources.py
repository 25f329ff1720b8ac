import glob

import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException

from changeloom.entities import ENTITIES, TRANSACTIONS, USERS
from changeloom.session import ObjectStore, scratch_dir, scratch_scope, stored
from changeloom.sources.files import read_table, stream_table
from changeloom.sources.kafka import Broker, read_changes, sink_options, source_options
from changeloom.sources.layout import files_for, write_indexed, write_sorted
from changeloom.streaming.job import _arguments
from changeloom.streaming.lifecycle import ONCE, drain


@pytest.fixture(scope="module")
def transactions(spark):
    return spark.range(2000).selectExpr(
        "concat('t', id) AS transaction_id",
        "concat('u', id % 50) AS user_id",
        "'p' AS product_id", "'c' AS payment_id", "'s' AS shipping_id",
        "1 AS quantity", "0 AS discount",
        # Two thirds of the rows share one modification time.
        "IF(id % 3 = 0, concat('2024-01-02 00:00:00.', lpad(id, 6, '0')), "
        "'2024-01-01 00:00:00.000000') AS last_modified_ts",
        "'INSERT' AS status",
    )


def files(path):
    return sorted(glob.glob(f"{path}/*.parquet"))


def test_sorted_files_cover_disjoint_ranges(spark, rows, transactions, tmp_path):
    path = str(tmp_path / "sorted")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted(transactions, path, TRANSACTIONS)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tables = [pq.read_table(name, columns=["last_modified_ts", "transaction_id"]) for name in files(path)]
    parts = sorted(list(zip(*t.to_pydict().values())) for t in tables if t.num_rows)
    flat = [pair for part in parts for pair in part]
    assert flat == sorted(flat)
    assert len(parts) == 4 and max(map(len, parts)) < 2000 * 0.5
    assert rows(spark.read.parquet(path)) == rows(transactions)


def bloom_columns(spark, path):
    jvm = spark._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(
        jvm.org.apache.hadoop.fs.Path(path), hadoop
    )
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    try:
        found = set()
        for block in reader.getFooter().getBlocks():
            for column in block.getColumns():
                if column.getBloomFilterOffset() >= 0:
                    found.add(column.getPath().toDotString())
        return found
    finally:
        reader.close()


def test_bloom_filters_on_lookup_columns(spark, transactions, tmp_path):
    for write in (write_sorted, write_indexed):
        path = str(tmp_path / write.__name__)
        # Dictionary-encoded chunks need no bloom filter; many distinct keys do.
        write(transactions, path, TRANSACTIONS, distinct_keys=2000)
        found = set().union(*(bloom_columns(spark, name) for name in files(path)))
        assert "transaction_id" in found and found <= {"transaction_id", "user_id"}


def test_layouts_name_existing_columns():
    for entity in ENTITIES.values():
        assert entity.key in entity.bloom
        assert {*entity.bloom, *entity.sorted_by} <= set(entity.columns)


@pytest.mark.parametrize("as_folder", [True, False])
def test_tables_stream_from_a_file_or_a_folder(spark, rows, tmp_path, as_folder):
    folder, table = str(tmp_path / "data"), spark.range(10).selectExpr("id", "id * 2 AS twice")
    if as_folder:
        table.repartition(3).write.parquet(f"{folder}/things.parquet")
    else:
        (tmp_path / "data").mkdir()
        pq.write_table(table.toArrow(), f"{folder}/things.parquet")
    stream = stream_table(spark, folder, "things", max_files_per_trigger=2)
    writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint"))
    drain([writer.trigger(**ONCE).start(str(tmp_path / "out"))])
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(read_table(spark, folder, "things"))


def test_a_table_stream_takes_its_exact_name_only(spark, tmp_path):
    for name in ("things.parquet", "things.parquet.bak", "things.parquet2"):
        spark.range(3).write.parquet(str(tmp_path / "data" / name))
    stream = stream_table(spark, str(tmp_path / "data"), "things")
    writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "checkpoint"))
    drain([writer.trigger(**ONCE).start(str(tmp_path / "out"))])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_a_sorted_table_has_the_wanted_number_of_files(spark, transactions, tmp_path):
    write_sorted(transactions, str(tmp_path / "sorted"), TRANSACTIONS, files=7)
    assert len(files(str(tmp_path / "sorted"))) == 7
    assert files_for(1) == 1 and files_for(1025, 512) == 3


def test_a_scope_leaves_no_scratch(spark):
    import os

    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    with scratch_scope(spark):
        assert stored(spark.range(5), "scoped").count() == 5
        assert set(os.listdir(root)) > before
    assert set(os.listdir(root)) == before


def test_kafka_options():
    broker = Broker("host:9092", {"kafka.security.protocol": "SSL"})
    assert source_options(broker, "changes", 1000, 8) == {
        "kafka.bootstrap.servers": "host:9092",
        "kafka.security.protocol": "SSL",
        "subscribe": "changes",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "8",
    }
    assert sink_options(Broker("h:1"), USERS) == {
        "kafka.bootstrap.servers": "h:1",
        "topic": "streaming_users",
    }


def test_kafka_without_its_package_says_so(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        read_changes(spark, Broker("h:1"), USERS)


def test_object_store_settings_come_from_the_caller():
    settings = ObjectStore("http://store:9000", "id", "secret", tls=False).settings()
    assert settings["spark.hadoop.fs.s3a.access.key"] == "id"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_scratch_is_fresh_and_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(f"{root}/x-")


def test_stored_reads_back(spark, rows):
    df = spark.range(5).selectExpr("id", "CAST(id AS STRING) AS text")
    back = stored(df, "stored")
    assert rows(back) == rows(df)
    assert "FileScan" in back._jdf.queryExecution().executedPlan().toString()


def test_job_arguments():
    args = _arguments(
        "--brokers b:1 --archive s3a://a --dead-letters s3a://d --checkpoints s3a://c".split()
    )
    assert args.entities == list(ENTITIES) and not args.separate and args.interval is None
    with pytest.raises(SystemExit):
        _arguments(["--brokers", "b:1"])
