"""Stages of the pipeline: each takes (spark, docs, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import leaks
from .jaccard import jaccard_join
from .quality import fit, graded, score
from .scratch import documents, stored
from .sentencepiece import encode
from .substring import dedup_substrings


TOKENIZERS = "TOKENIZER_FOLDER"


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Path of a vocabulary, in ``folder``, the folder that the environment names, or the
    installed package of public tokenizers."""
    folder = folder or os.environ.get(TOKENIZERS)
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose top grade is at least as likely as all others together."""
    model = fit(docs, graded(documents(spark, sf_dir, "labels")))
    return score(docs, model).filter("p_top >= 0.5").select("row.*")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class stays, once."""
    first = jaccard_join(docs).filter("key = first_key").select("key").distinct()
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    return keyed.join(first, "key", "left_semi").dropDuplicates(["key"]).drop("key")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in duplicate spans go; a document that loses none keeps its text as it was."""
    found = dedup_substrings(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    return found.select(text.alias("text"), "row").select(
        "row.doc_id", "text", "row.lang", "row.source", F.length("text").cast("long").alias("n_chars")
    )


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go in which some benchmark item is found."""
    found = leaks(docs, documents(spark, sf_dir, "benchmark")).select("key").distinct()
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    return keyed.join(found, "key", "left_anti").drop("key")


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document, and whether they decode to its text."""
    model = tokenizer_file("piece_bpe_32k.model")
    return encode(docs, model, keep=["doc_id"]).select(
        "row.doc_id", "pieces", F.size("pieces").cast("long").alias("n_pieces"), "lossless"
    )


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("sentencepiece", piece_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{k}")
    return docs
