"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm import (
    bpe,
    decontam,
    labelled,
    lexical,
    linededup,
    minhash,
    phrases,
    pii,
    quality,
    secretscan,
    substrings,
    topk,
    toxicity,
    wordtable,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
VOCABULARY_FILE = "byte_bpe_50k.json"
ACCEPT = 0.3  # a score from here on counts as label 1


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scored(docs: DataFrame, divisor: int, kept_out: int, *more: str) -> DataFrame:
    """The digest columns of a scorer's result."""
    return docs.select(
        "doc_id",
        (labelled.remainder("doc_id", divisor) == kept_out).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
        *more,
    )


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    weights = toxicity.train(docs, labels, labelled.remainder("doc_id", 4) != 2)
    return scored(toxicity.score(docs.select("doc_id", "text"), weights), 4, 2, "sentences")


@query
def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = linededup.dedupe_lines(table(spark, folder, "documents"))
    return docs.select("doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("text_sha256"))


@query
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    kinds = F.array(*map(F.lit, pii.KINDS))

    def listed(spans: Column) -> Column:
        ordered = F.array_sort(spans)
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")

    def count(kind: int) -> Column:  # a second parameter of the function would be the place in the array
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.concat("base_spans", "added_spans")).alias("spans"),
    )


@query
def op5_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, folder, "documents"))


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.find_copies(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("body")


@query
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secretscan.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "word_index", F.length("value").cast("long").alias("length"), F.sha2("value", 256).alias("value_sha256"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(RANK_FILE)
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    ids = F.array_join(F.col("tokens").cast("array<string>"), ",")
    digest = encoded.select("*", F.size("tokens").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"))
    return bpe.decode(digest, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    net = quality.train(docs, labels, labelled.remainder("doc_id", 5) != 0)
    return scored(quality.score(docs.select("doc_id", "text"), net), 5, 0)


@query
def op11_word_table(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY_FILE)
    encoded = wordtable.encode(table(spark, folder, "documents").select("doc_id", "text"), path)
    ids = F.array_join(F.col("tokens").cast("array<string>"), ",")
    digest = encoded.select("*", F.size("tokens").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"))
    return wordtable.decode(digest, path).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.mine(table(spark, folder, "documents"))


@query
def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
