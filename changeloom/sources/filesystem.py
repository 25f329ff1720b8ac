"""Small operations on whatever file system a path is on."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    system, hadoop = _system(spark, path)
    return system.exists(hadoop)


def make_folder(spark: SparkSession, path: str) -> None:
    system, hadoop = _system(spark, path)
    system.mkdirs(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder."""
    system, hadoop = _system(spark, path)
    system.delete(hadoop, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another name on the same file system."""
    system, hadoop = _system(spark, path)
    if not system.rename(hadoop, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be moved to {to}")


def put(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears under its name with all its text, or not at all."""
    system, final = _system(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}"
    )
    stream = system.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not system.rename(hidden, final):
        system.delete(hidden, False)
        raise OSError(f"{path} could not be written")


def text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    system, hadoop = _system(spark, path)
    stream = system.open(hadoop)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The few files that match a pattern, in order."""
    system, hadoop = _system(spark, pattern)
    return sorted(found.getPath().toString() for found in system.globStatus(hadoop) or [])


def below(spark: SparkSession, folder: str, names: str = "part-*") -> list[str]:
    """The files below a folder, listed by the engine in one call."""
    if not exists(spark, folder):
        return []
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return sorted(unquote(f) for f in reader.option("pathGlobFilter", names).load(folder).inputFiles())


def path_of(spark: SparkSession, path: str) -> str:
    """The path without scheme and authority."""
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()


def stamp(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and time of change of a file or folder."""
    system, hadoop = _system(spark, path)
    content = system.getContentSummary(hadoop)
    return content.getLength(), content.getFileCount(), system.getFileStatus(hadoop).getModificationTime()
