"""From raw documents to token ids: five stages, each stored before the next reads it.

Each stage takes (session, documents, folder of the tables) and returns documents; the
last adds their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.llm import bpe, decontam, labelled, linededup, minhash, quality
from lacuna.llm.queries import ACCEPT, RANK_FILE, table
from lacuna.session import cut_lineage

LONG_LINE = 50  # words from which a repeated line is a passage of its own


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality network accepts."""
    net = quality.train(docs, table(spark, folder, "labels"), labelled.remainder("doc_id", 5) != 0)
    return quality.score(docs, net, into="__score").where(F.col("__score") >= ACCEPT).drop("__score")


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without later repeated runs of lines and long lines; a text of which nothing is left goes."""
    cleaned = linededup.dedupe_lines(docs, alone=LONG_LINE).where("n_deleted = 0 or n_deleted < n_lines")
    return cleaned.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The first document of every group of near copies; equal rows count once."""
    found = cut_lineage(minhash.near_duplicates(docs).where("id is not null and not kept").select("id").distinct())
    left = docs.join(found, F.col("doc_id") == F.col("id"), "left_anti")
    # only rows that repeat an id can be equal: few, so the others need no shuffle
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    again = cut_lineage(again.select(F.col("doc_id").alias("id")))
    repeats = left.join(again, F.col("doc_id") == F.col("id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return left.join(again, F.col("doc_id") == F.col("id"), "left_anti").union(repeats)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a copy of a benchmark passage."""
    found = decontam.find_copies(docs, table(spark, folder, "benchmark")).select(F.col("doc_id").alias("id"))
    found = cut_lineage(found.distinct())
    return docs.join(found, F.col("doc_id") == F.col("id"), "left_anti")


def encode_and_decode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids, their number, and the text as decoded from them."""
    path = public_tokenizers.path(RANK_FILE)
    # stored in between, so that a core has one Python process, not two
    encoded = cut_lineage(bpe.encode(docs, path, public_tokenizers.PATTERN, keep=False).drop("text"))
    decoded = bpe.decode(encoded, path)
    return decoded.select(
        "doc_id", F.col("decoded").cast("string").alias("text"), "lang", "source", "n_chars",
        F.size("tokens").cast("long").alias("n_tokens"), "tokens",
    )


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", delete_repeated_lines),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("bpe", encode_and_decode),
]

# trained network, alignment and merges are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, folder))
    return docs
