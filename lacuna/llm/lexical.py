"""Ranked lexical search by NRA ("no random access") over impact-sorted postings.

``rank`` returns the best documents of every item.  Postings of the items' terms are
dealt into shards of whole documents.  In a shard each term's list is sorted by falling
impact and read from the top in growing steps, all lists of an item side by side; no
score is ever looked up out of that order.  What was read adds up to a document's lower
bound; the next unread impact of each list bounds what the document may still get from
lists it was not seen in, which gives the upper bound.  Reading goes on until the ``k``
best by lower bound have closed intervals (final scores) and no other document with an
open interval can reach the kth score, ties included.  The shards' lists are merged by
rank.

Terms are the maximal runs of ASCII letters, ASCII digits and characters beyond ASCII;
only A-Z are lower-cased.  With N documents that hold a term and L terms in them all, a
document of n terms has m = 100 - B + (B * n * N) div L with B = 75, and a term that occurs tf times in
it adds weight * ((10^9 * tf) div (1000 * tf + 8 * m)), for each time it stands in the
item; weight = floor(1000 * ln((2 * N + 2) / (2 * df + 1))).

Defined cases: null or empty text has no terms, so such a document is never returned and
such an item has no rows; empty tables give no rows.  Every row of either table stands for
itself: rows that repeat an id are ranked as documents (items) of their own.  Equal scores
go by ascending document id, nulls last, rows that repeat an id in the order read.  Only
the named columns are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lacuna.llm import textwork as tw
from lacuna.session import cut_lineage

LENGTH_SHARE = 75  # of 100: how much a document's length counts
SHARD_POSTINGS = 1_000_000
ITEM_BLOCK = 20_000  # items searched together
FIRST_STEP, GROWTH = 64, 4
_ROW_BITS = 40


def terms(df: DataFrame, key: str, text: str, wanted: np.ndarray | None = None) -> DataFrame:
    """Terms of each row with their number of occurrences: ``row`` (a number of the row,
    unique in the frame), ``key``, ``n`` (all terms of the row), ``term``, ``mark`` (its
    fingerprint) and ``tf``; one more line per row with a null term.

    ``wanted`` is a bitmap of fingerprints: terms outside it are counted in ``n`` only.
    """
    tw.prepare(df.sparkSession)
    key_type = df.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("key", key_type),
            T.StructField("n", T.LongType()),
            T.StructField("term", T.StringType()),
            T.StructField("mark", T.LongType()),
            T.StructField("tf", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << _ROW_BITS
        for batch in batches:
            keys = batch.column("key")
            for part in tw.slices(batch.column("text")):
                found = tw.pieces(part, tw.NOT_ALNUM, True)
                n = np.diff(found.bounds)
                doc = np.repeat(np.arange(part.rows), n)
                hit = np.ones(len(doc), bool) if wanted is None else tw.in_bitmap(found.hashes, wanted)
                words = tw.strings(part, found.start[hit], found.end[hit]).dictionary_encode()
                at = words.indices.to_numpy()
                size = max(len(words.dictionary), 1)
                cells, place, tf = np.unique(doc[hit] * size + at, return_index=True, return_counts=True)
                owner = np.concatenate([np.arange(part.rows), cells // size])
                none = pa.nulls(part.rows, pa.string())
                lines = [none, words.dictionary.take(pa.array(cells % size))]
                blank = np.zeros(part.rows, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(first + owner),
                        keys.take(pa.array(part.first + owner)),
                        pa.array(n[owner]),
                        pa.concat_arrays(lines),
                        pa.array(np.concatenate([blank, tw.signed(found.hashes[hit][place])])),
                        pa.array(np.concatenate([blank, tf])),
                    ],
                    schema.names,
                )
                first += part.rows

    return df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema)


def nra(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` best of documents 0 .. size - 1, smaller numbers first among equals, their
    scores, and the number of postings read.

    ``lists`` hold each term's documents and what it adds to each, by falling addition.
    """
    lists = [entry for entry in lists if len(entry[0]) and entry[1][0] > 0]
    lower = np.zeros(size, np.int64)
    read = [0] * len(lists)
    step = FIRST_STEP
    while True:
        ahead = []
        for t, (docs, adds) in enumerate(lists):
            upto = min(read[t] + step, len(docs))
            lower[docs[read[t] : upto]] += adds[read[t] : upto]
            read[t] = upto
            ahead.append(int(adds[upto]) if upto < len(docs) else 0)
        # what a document may still get: the next addition of every list it was not seen in
        gap = np.full(size, sum(ahead), np.int64)
        for t, (docs, _) in enumerate(lists):
            if ahead[t]:
                gap[docs[: read[t]]] -= ahead[t]
        best = _best(lower, k)
        if not any(ahead):
            return best, lower[best], sum(read)
        if len(best) == k and not gap[best].any():
            others = gap > 0
            others[best] = False
            if not (lower[others] + gap[others] >= lower[best[-1]]).any():
                return best, lower[best], sum(read)
        step *= GROWTH


def _best(score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores above 0, equal ones by position."""
    if len(score) > 4 * k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        chosen = np.flatnonzero(score >= max(edge, 1))
    else:
        chosen = np.flatnonzero(score > 0)
    return chosen[np.argsort(-score[chosen], kind="stable")][:k]


def _search_shard(k: int, schema: pa.Schema):
    def search(postings: pa.Table, queries: pa.Table) -> pa.Table:
        if postings.num_rows == 0 or queries.num_rows == 0:
            return schema.empty_table()
        postings = postings.sort_by([("key", "ascending"), ("row", "ascending")])  # nulls last
        rows = postings["row"].to_numpy()
        begins = np.concatenate([[True], rows[1:] != rows[:-1]])
        doc, heads = np.cumsum(begins) - 1, np.flatnonzero(begins)
        term, impact = postings["term_id"].to_numpy(), postings["impact"].to_numpy()
        order = np.lexsort((doc, -impact, term))
        term, impact, doc = term[order], impact[order], doc[order]
        item, wanted, weight = (queries[c].to_numpy() for c in ("item", "term_id", "weight"))
        by_item = np.argsort(item, kind="stable")
        item, wanted, weight = item[by_item], wanted[by_item], weight[by_item]
        left, right = np.searchsorted(term, wanted, "left"), np.searchsorted(term, wanted, "right")
        out: list[tuple[np.ndarray, ...]] = []
        edges = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1], [True]]))
        for a, b in zip(edges[:-1], edges[1:]):
            lists = [(doc[left[t] : right[t]], impact[left[t] : right[t]] * weight[t]) for t in range(a, b)]
            best, score, _ = nra(lists, len(heads), k)
            out.append((np.full(len(best), item[a]), heads[best], score))
        items, at, score = (np.concatenate(parts) for parts in zip(*out))
        found = postings.select(["row", "key"]).take(pa.array(at))
        return pa.Table.from_arrays(
            [pa.array(items), found["row"], found["key"], pa.array(score)], schema=schema
        )

    return search


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_key: str = "doc_id",
    item_key: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: ``item_key``, ``rank`` (from 1),
    ``doc_key`` and ``score``; items are searched in blocks of ``ITEM_BLOCK``."""
    asked = cut_lineage(terms(items, item_key, text))
    words = asked.where("term is not null")
    vocabulary = cut_lineage(words.select("term", "mark").distinct().withColumn("term_id", F.monotonically_increasing_id()))
    wanted = tw.bitmap(vocabulary.select("mark"))

    held = cut_lineage(terms(docs, doc_key, text, wanted))
    whole, total = held.where("term is null").agg(
        F.coalesce(F.count_if(F.col("n") > 0), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    ).first()
    postings = held.join(vocabulary.select("term", "term_id"), "term")
    weights = cut_lineage(
        postings.groupBy("term", "term_id").agg(F.count(F.lit(1)).alias("df")).select(
            "term", "term_id", "df",
            F.floor(1000 * F.log((2.0 * whole + 2) / (2.0 * F.col("df") + 1))).alias("w"),
        )
    )
    size = weights.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_POSTINGS))
    even = f"{100 - LENGTH_SHARE} + (({LENGTH_SHARE} * n * {whole}L) div {max(total, 1)}L)"
    index = postings.selectExpr(
        f"cast(pmod(xxhash64(row), {shards}) as int) as shard", "row", "key", "term_id",
        f"(1000000000L * tf) div (1000 * tf + 8 * ({even})) as impact",
    )
    queries = cut_lineage(
        words.join(weights, "term").where("w > 0").select(
            F.col("row").alias("item"), "term_id", (F.col("w") * F.col("tf")).alias("weight"),
            F.pmod(F.xxhash64("row"), F.lit(1 << 20)).alias("deal"),
        )
    )
    n_items = queries.select("item").distinct().count()
    blocks = max(1, -(-n_items // ITEM_BLOCK))
    key_type = docs.schema[doc_key].dataType
    found_schema = T.StructType(
        [
            T.StructField("item", T.LongType()),
            T.StructField("row", T.LongType()),
            T.StructField("key", key_type),
            T.StructField("score", T.LongType()),
        ]
    )
    arrow = pa.schema(
        [("item", pa.int64()), ("row", pa.int64()), ("key", to_arrow_type(key_type)), ("score", pa.int64())]
    )
    best = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"), "row")
    if blocks > 1:
        index = cut_lineage(index)
    parts = []
    for block in range(blocks):
        own = queries.where(F.col("deal") % blocks == block).drop("deal")
        dealt = own.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        parts.append(
            index.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(_search_shard(k, arrow), found_schema)
        )
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = asked.where("term is null").select(F.col("row").alias("item"), F.col("key").alias("name"))
    return ranked.join(names, "item").select(
        F.col("name").alias(item_key), "rank", F.col("key").alias(doc_key), "score"
    )

