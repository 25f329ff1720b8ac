"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from changeloom.sources.files import delete

SESSION_DEFAULTS = {
    # Text timestamps carry no zone; one fixed zone keeps dates the same everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A scan of few large files still gives every core a share.
    "spark.sql.files.maxPartitionBytes": "64m",
    # For callers that keep stream state: on local disk, uploading changes only.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class ObjectStore:
    """How to reach an S3-compatible store. Credentials come from the caller."""

    endpoint: str
    access_key: str
    secret_key: str
    tls: bool = True
    path_style: bool = True

    def settings(self) -> dict[str, str]:
        return {
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
            "spark.hadoop.fs.s3a.endpoint": self.endpoint,
            "spark.hadoop.fs.s3a.access.key": self.access_key,
            "spark.hadoop.fs.s3a.secret.key": self.secret_key,
            "spark.hadoop.fs.s3a.connection.ssl.enabled": str(self.tls).lower(),
            "spark.hadoop.fs.s3a.path.style.access": str(self.path_style).lower(),
        }


def build_session(
    app_name: str,
    object_store: ObjectStore | None = None,
    master: str | None = None,
    **settings: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    stored = object_store.settings() if object_store else {}
    for name, value in {**SESSION_DEFAULTS, **stored, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors can reach.

    Where the setting is missing, a session with all its executors in one process sets it
    to a temporary folder. Whatever is left of a fresh folder goes when the session ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="changeloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _opened.append(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.deleteOnExit(hadoop)
    return path


_opened: list[str] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders that were opened within the block, at its end."""
    before = len(_opened)
    try:
        yield
    finally:
        for path in _opened[before:]:
            delete(spark, path)
        del _opened[before:]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written as a Parquet table in scratch space and read back.

    For frames that are read several times: readers prune columns, and losing an
    executor costs no recomputation.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
