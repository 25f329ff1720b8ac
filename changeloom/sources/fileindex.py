"""What each file of a table holds, asked before the files are opened.

::

    <root>/entry-<n>.json    a set of indexed files, written after what it names
    <root>/files-<id>        a row a file: path, rows, smallest and largest value by column
    <root>/bits-<id>         bloom filters of the key columns, cut across the files:
                             column, slot, word, file, bits

All files of an entry have filters of one length, which follows from the largest count of
distinct values that a sketch finds in one of them. A value has all its bits in one word, the same
in all files, and a lookup reads only that word, of all files at once: its work follows the number
of files and not the keys in them. Building makes one row a value. Only words with a bit set are
stored. They lie in slots, folders of about ``SLOT`` rows, of which a lookup opens one a value.

Tables to index are written once; files that are added later get an entry of their own with
``add``. Readers see the files of the entries and no others.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, LongType, StringType, StructType

from changeloom.sources.filelog import read_files
from changeloom.sources.filesystem import below, make_folder, matching, put, text

#: Least bits a distinct value and bits set for it: one of about 2,600 files is opened in vain.
BITS_PER_VALUE, HASHES = 32, 6
#: Of entries; those of another layout have to be built again.
LAYOUT = 2
#: Rows of filter words in one folder, about.
SLOT = 1 << 20


def _hashed(value: Column, kind: DataType) -> Column:
    """What is hashed of a value; whole numbers of all widths are alike."""
    return value.cast("long") if isinstance(kind, IntegralType) else value


def _word_bits(value: Column, kind: DataType, bits: int) -> Column:
    """The word of a value in a filter of ``bits``, a power of two, and its bits there."""
    word = F.xxhash64(_hashed(value, kind), F.lit(0)).bitwiseAND(F.lit(bits // 64 - 1))
    places = F.xxhash64(_hashed(value, kind), F.lit(1))

    def at(k: int) -> Column:
        place = F.shiftright(places, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return F.struct(word.alias("word"), reduce(Column.bitwiseOR, map(at, range(HASHES))).alias("bits"))


def _comparable(kind: DataType, value: object) -> bool:
    """Whether equality with a value compares it as it is, without a conversion of the column."""
    if isinstance(kind, StringType):
        return isinstance(value, str)
    if isinstance(kind, IntegralType):
        return isinstance(value, int) and not isinstance(value, bool) and -(1 << 63) <= value < 1 << 63
    return isinstance(kind, DateType) and isinstance(value, date) and not isinstance(value, datetime)


class FileIndex:
    """Index of the Parquet files of one table.

    ``keys`` are columns for equality (text, whole numbers, dates), ``ranges`` further columns
    of which only the extremes are kept.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], ranges: Sequence[str] = ()
    ):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.columns = list(keys), [*keys, *(x for x in ranges if x not in keys)]
        wrong = [x for x in keys if not isinstance(schema[x].dataType, (StringType, IntegralType, DateType))]
        if wrong:
            raise ValueError(f"no keys: {wrong}")

    # writing ----------------------------------------------------------------

    def add(self, files: str | Iterable[str]) -> None:
        """Index the files of a folder, or the files named. They must not be indexed yet."""
        paths = below(self.spark, files) if isinstance(files, str) else list(files)
        make_folder(self.spark, self.root)
        if not paths:
            return
        name, number = uuid.uuid4().hex, len(self._entries())
        rows = read_files(self.spark, paths, self.schema).select(F.col("_metadata.file_path").alias("path"), *self.columns)
        rows = rows.withColumn("file", F.xxhash64("path"))
        stats = [F.any_value("path").alias("path"), F.count(F.lit(1)).alias("rows")]
        for c in self.columns:
            stats += [F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"), F.count(c).alias(f"n_{c}")]
        stats += [F.approx_count_distinct(c).alias(f"distinct_{c}") for c in self.keys]
        held = f"{self.root}/files-{name}"
        # The engine gives paths with escapes; a plus sign stands for itself there.
        path = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
        rows.groupBy("file").agg(*stats).withColumn("path", path).coalesce(8).write.parquet(held)

        held = self.spark.read.parquet(held)
        most = held.agg(F.count(F.lit(1)).alias("files"), *(F.max(f"distinct_{c}").alias(c) for c in self.keys)).first()
        shape = {}
        for c in self.keys:
            bits = max(64, 1 << (max(1, most[c] or 0) * BITS_PER_VALUE - 1).bit_length())
            slots = max(1, most["files"] * (bits // 64) // SLOT)
            shape[c] = {"bits": bits, "slots": min(slots, bits // 64)}
        if shape:
            self._words(rows, shape).write.partitionBy("column", "slot").parquet(f"{self.root}/bits-{name}")
        put(self.spark, f"{self.root}/entry-{number:09d}.json", json.dumps({"layout": LAYOUT, "name": name, "shape": shape}))

    def _words(self, rows: DataFrame, shape: Mapping[str, Mapping[str, int]]) -> DataFrame:
        def of(c: str) -> Column:
            found = _word_bits(F.col(c), self.schema[c].dataType, shape[c]["bits"])
            per_slot = shape[c]["bits"] // 64 // shape[c]["slots"]
            named = F.struct(
                F.lit(c).alias("column"),
                F.floor(found["word"] / per_slot).cast("int").alias("slot"),
                found["word"].alias("word"),
                found["bits"].alias("bits"),
            )
            return F.when(F.col(c).isNotNull(), named)

        found = rows.select("file", F.array_compact(F.array(*map(of, shape))).alias("found"))
        found = found.select("file", F.inline("found"))
        merged = found.groupBy("column", "slot", "word", "file").agg(F.bit_or("bits").alias("bits"))
        return merged.repartition("column", "slot").sortWithinPartitions("column", "slot", "word")

    # reading ----------------------------------------------------------------

    def _entries(self) -> list[dict]:
        found = [json.loads(text(self.spark, x)) for x in matching(self.spark, f"{self.root}/entry-*.json")]
        if any(entry.get("layout") != LAYOUT for entry in found):
            raise ValueError(f"{self.root} was built in another layout; build it again")
        return found

    def _files(self, entry: dict) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/files-{entry['name']}")

    def _with_values(self, entry: dict, column: str, values: Sequence[object]) -> DataFrame:
        """``file`` of the files whose filters hold one of the values."""
        kind, shape = self.schema[column].dataType, entry["shape"][column]
        asked = StructType().add("value", LongType() if isinstance(kind, IntegralType) else kind)
        wanted = self.spark.createDataFrame([(x,) for x in values], asked)
        wanted = wanted.select(_word_bits(F.col("value"), kind, shape["bits"]).alias("at")).select("at.*").distinct()
        # At most as many rows as the question has values.
        wanted = wanted.withColumnRenamed("bits", "wanted").collect()
        words = sorted({r.word for r in wanted})
        per_slot = shape["bits"] // 64 // shape["slots"]
        held = self.spark.read.schema("word LONG, file LONG, bits LONG, column STRING, slot INT").parquet(
            f"{self.root}/bits-{entry['name']}"
        )
        held = held.filter(
            (F.col("column") == column)
            & F.col("slot").isin(sorted({x // per_slot for x in words}))
            & F.col("word").isin(words)
        )
        need = self.spark.createDataFrame(wanted, "word LONG, wanted LONG")
        found = held.join(need, "word").filter(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
        return found.select("file").distinct()

    def candidates(self, **equals: object) -> list[str]:
        """Files that can hold rows whose columns equal the given values, or one of a list."""
        found = []
        for entry in self._entries():
            files = self._files(entry)
            for name, wanted in equals.items():
                several = isinstance(wanted, (list, tuple, set))
                values = [x for x in (wanted if several else [wanted]) if x is not None]
                kind = self.schema[name].dataType
                if name not in self.columns or not all(_comparable(kind, x) for x in values):
                    continue
                within = F.lit(False)
                for x in values:
                    within = within | F.lit(x).between(F.col(f"low_{name}"), F.col(f"high_{name}"))
                files = files.filter(within)
                if name in self.keys and values:
                    files = files.join(self._with_values(entry, name, values), "file", "left_semi")
            found += [r.path for r in files.select("path").collect()]
        return sorted(found)

    def newest(self, time: str, start: object, end: object, limit: int) -> list[str]:
        """Files that hold the newest ``limit`` rows with ``start <= time <= end``.

        Files that lie within the range are taken by their smallest time, newest first, until
        their rows are enough: nothing older than the last smallest time is among the newest.
        """
        files = None
        for entry in self._entries():
            one = self._files(entry).select("path", f"low_{time}", f"high_{time}", f"n_{time}").toDF("path", "low", "high", "n")
            files = one if files is None else files.union(one)
        if files is None:
            return []
        files = files.filter((F.col("high") >= F.lit(start)) & (F.col("low") <= F.lit(end)))
        inside = files.filter((F.col("low") >= F.lit(start)) & (F.col("high") <= F.lit(end)))
        # Each holds a row, so that as many files as rows are always enough.
        held, sure = 0, None
        for row in inside.orderBy(F.desc("low")).limit(limit).collect():
            held += row.n
            if held >= limit:
                sure = row.low
                break
        if sure is not None:
            files = files.filter(F.col("high") >= F.lit(sure))
        return sorted(r.path for r in files.select("path").collect())

    def read(self, files: Iterable[str]) -> DataFrame:
        return read_files(self.spark, files, self.schema)
