"""One query for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import leaks
from .embeddings import embedding_links
from .jaccard import jaccard_join
from .lexical import search
from .lm_score import score as lm_score
from .quality import fit, graded, score
from .scratch import documents, scratch_dir
from .sentencepiece import encode
from .sharding import shard_rows
from .stages import tokenizer_file
from .substring import dedup_substrings
from .tokens import read_tokens, write_tokens
from .toxicity import fit as toxicity_fit
from .toxicity import held_out
from .toxicity import score as toxicity_score
from .tries import prefix_trie
from .urls import filter_urls


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    found = encode(documents(spark, folder), model, keep=["doc_id"])
    return found.select(
        "row.doc_id", F.size("pieces").cast("long").alias("n_pieces"), "ids_crc32", "lossless"
    )


def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join(documents(spark, folder))
    return found.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = fit(docs, graded(documents(spark, folder, "labels")))
    found = score(docs, model)
    return found.select(
        "row.doc_id",
        F.round("expected_grade", 6).alias("expected_grade"),
        F.round("p_top", 6).alias("p_top"),
        (F.col("p_top") >= 0.5).alias("kept"),
    )


def op4_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links(documents(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks(documents(spark, folder), documents(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "item_id",
        F.round("share", 6).alias("share"),
        F.round("answer", 6).alias("answer"),
    )


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(documents(spark, folder, "pages")).withColumnRenamed("id", "page_id")


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = dedup_substrings(documents(spark, folder))
    return found.select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op8_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    write_tokens(documents(spark, folder), path, tokenizer_file("byte_bpe_50k.json"))
    found = read_tokens(spark, path)
    return found.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    found = lm_score(documents(spark, folder), documents(spark, folder, "labels"))
    return found.select(F.col("id").alias("doc_id"), "n_tokens", F.round("score", 6).alias("score"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_rows(documents(spark, folder)).withColumnRenamed("id", "doc_id")


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = toxicity_fit(docs, documents(spark, folder, "labels"))
    found = toxicity_score(docs, model)
    return found.select(
        "row.doc_id", held_out("row.doc_id").alias("held_out"), F.round("score", 9).alias("score"), "predicted"
    )


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    found = search(documents(spark, folder), documents(spark, folder, "benchmark"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(documents(spark, folder, "conversations"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_embedding_near_dedup": op4_embedding_near_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_url_filter": op6_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_token_ids": op8_token_ids,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_sharding": op10_sharding,
    "op11_toxicity": op11_toxicity,
    "op12_lexical_search": op12_lexical_search,
    "op13_conversation_trie": op13_conversation_trie,
}
