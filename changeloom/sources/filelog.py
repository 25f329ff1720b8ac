"""An append-only log of the files that make up an output.

::

    <root>/_log/batch-<run>-<n>.json    the files of one batch, written after all of them
    <root>/_log/files/version=<v>/      all files that were live at version v, as a table
    <root>/_log/state-<v>.json          that version v counts, and which batches it covers
    <root>/_log/shared-<id>.txt         another root whose log speaks for this output too

Every entry appears in one step, so a batch is there as a whole or not at all, and a merge
replaces files in one step too. Readers take their paths from here and list no data folder:
what they open follows what they ask for, not how many batches there have been. A reader
that has its paths keeps them, so that it sees each row once while files are merged.

Batches of one run are committed in order. One process at a time may write states.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeloom.sources.filesystem import below, delete, exists, make_folder, matching, path_of, put, text

FILE = "kind STRING, part STRING, path STRING"
LINE = f"run STRING, batch BIGINT, {FILE}"
#: Kind of the line that every batch has, files or none.
BATCH = "batch"


@dataclass(frozen=True)
class State:
    """A version of the live files, and the last batch of each run that it covers."""

    version: int = 0
    covered: Mapping[str, int] = field(default_factory=dict)
    notes: Mapping[str, str] = field(default_factory=dict)


def part_of(path: str, column: str) -> str | None:
    """The value of a partition column in a path; None if it is missing or stands for NULL."""
    found = re.search(rf"/{column}=([^/]*)/", path)
    return found.group(1) if found and not found.group(1).startswith("__HIVE") else None


class FileLog:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = f"{self.root}/_log"

    def open(self) -> FileLog:
        make_folder(self.spark, self.folder)
        return self

    def exists(self) -> bool:
        return exists(self.spark, self.folder)

    # writing ----------------------------------------------------------------

    def _entry(self, run: str, batch: int) -> str:
        return f"{self.folder}/batch-{run}-{batch:012d}.json"

    def committed(self, run: str, batch: int) -> bool:
        """Whether a batch is in the log; the engine repeats a batch that it has not noted."""
        return exists(self.spark, self._entry(run, batch)) or batch <= self.state().covered.get(run, -1)

    def commit(self, run: str, batch: int, outputs: Mapping[str, str], column: str = "date") -> None:
        """Make a batch count: the files below each output's folder, by kind."""
        line = {"run": run, "batch": batch}
        lines = [{**line, "kind": BATCH}]
        for kind, folder in outputs.items():
            lines += [
                {**line, "kind": kind, "part": part_of(path, column), "path": path}
                for path in below(self.spark, folder)
            ]
        put(self.spark, self._entry(run, batch), "".join(json.dumps(x) + "\n" for x in lines))

    def replace(self, state: State, files: DataFrame) -> None:
        """Make ``files`` (kind, part, path) all that is live of what ``state`` covers."""
        path = f"{self.folder}/files/version={state.version}"
        files.select("kind", "part", "path").coalesce(8).write.mode("overwrite").parquet(path)
        put(self.spark, f"{self.folder}/state-{state.version:09d}.json", json.dumps(asdict(state)))

    def follow(self, root: str) -> None:
        """Let the log of another root speak for this one too."""
        note = f"{self.folder}/shared-{zlib.crc32(root.encode()):08x}.txt"
        if root.rstrip("/") != self.root and not exists(self.spark, note):
            put(self.spark, note, root.rstrip("/"))

    # reading ----------------------------------------------------------------

    def _lines(self) -> DataFrame:
        try:
            return self.spark.read.schema(LINE).json(f"{self.folder}/batch-*.json")
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            return self.spark.createDataFrame([], LINE)

    def followed(self) -> list[FileLog]:
        notes = matching(self.spark, f"{self.folder}/shared-*.txt")
        return [FileLog(self.spark, text(self.spark, note)) for note in notes]

    def states(self) -> list[str]:
        """The entries of all versions that are left, oldest first."""
        return matching(self.spark, f"{self.folder}/state-*.json")

    def state(self) -> State:
        entries = self.states()
        return State(**json.loads(text(self.spark, entries[-1]))) if entries else State()

    def fresh(self, state: State) -> DataFrame:
        """Lines of the batches that a state does not cover."""
        lines = self._lines()
        if not state.covered:
            return lines
        pairs = [F.lit(x) for pair in state.covered.items() for x in pair]
        last = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("run")), F.lit(-1))
        return lines.filter(F.col("batch") > last)

    def stale(self, state: State) -> DataFrame:
        """Lines of the batches that a state covers and that are still in the log."""
        lines = self._lines()
        return lines.join(self.fresh(state).select("run", "batch").distinct(), ["run", "batch"], "left_anti")

    def held(self, state: State) -> DataFrame:
        """Files (kind, part, path) of a state."""
        if not state.version:
            return self.spark.createDataFrame([], FILE)
        return self.spark.read.schema(FILE).parquet(f"{self.folder}/files/version={state.version}")

    def files(self, kind: str) -> DataFrame:
        """Live files (part, path) of a kind, those that other logs hold for this root included."""
        state = self.state()
        wanted = F.col("kind") == kind
        found = self.held(state).filter(wanted).select("part", "path")
        found = found.union(self.fresh(state).filter(wanted).select("part", "path"))
        own = f"{path_of(self.spark, self.root)}/"
        for other in self.followed():
            found = found.union(other.files(kind).filter(F.contains("path", F.lit(own))))
        return found

    def paths(self, kind: str, wanted: Column | None = None) -> list[str]:
        """Paths of the live files of a kind whose ``part`` is wanted."""
        files = self.files(kind)
        found = files if wanted is None else files.filter(wanted)
        return sorted(r.path for r in found.select("path").collect())

    def read(self, kind: str, schema: StructType, wanted: Column | None = None, format: str = "parquet") -> DataFrame:
        """The rows of those files; partition columns stand in their paths below the root."""
        return read_files(self.spark, self.paths(kind, wanted), schema, self.root, format)

    def stream(self, most: int) -> DataFrame:
        """Committed files as a stream of lines, ``most`` batches at a time."""
        frames = [
            self.spark.readStream.schema(LINE)
            .option("maxFilesPerTrigger", most)
            .option("maxFileAge", "36500d")
            .json(f"{log.folder}/batch-*.json")
            for log in (self.open(), *(other.open() for other in self.followed()))
        ]
        own = f"{path_of(self.spark, self.root)}/"
        lines = frames[0]
        for frame in frames[1:]:
            lines = lines.union(frame)
        return lines.filter(F.contains("path", F.lit(own)))

    # cleaning ---------------------------------------------------------------

    def forget(self, state: State) -> None:
        """Delete the entries of covered batches and older versions."""
        for row in self.stale(state).select("run", "batch").distinct().toLocalIterator():
            delete(self.spark, self._entry(row.run, row.batch))
        self.forget_older(state)

    def older(self, state: State) -> list[int]:
        """The versions before a state that are left."""
        versions = [int(entry.rsplit("-", 1)[1].split(".")[0]) for entry in self.states()]
        return [version for version in versions if version < state.version]

    def forget_older(self, state: State) -> None:
        for version in self.older(state):
            delete(self.spark, f"{self.folder}/state-{version:09d}.json")
            delete(self.spark, f"{self.folder}/files/version={version}")


def read_files(
    spark: SparkSession, paths: Iterable[str], schema: StructType, base: str | None = None, format: str = "parquet"
) -> DataFrame:
    paths = list(paths)
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return (reader.option("basePath", base) if base else reader).format(format).load(paths)
