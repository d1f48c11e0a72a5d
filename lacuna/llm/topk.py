"""Exact top-k by inner product with KD-trees per shard.

Vectors are scaled and floored to integers, dealt to shards of about ``SHARD_ROWS`` by
a hash, and each shard becomes one KD-tree: median splits on the widest side of the
tight bounding box, down to leaves of ``LEAF_ROWS``.  Queries come in blocks.  A block
is searched best first in a shard: leaves are visited in the order of the largest inner
product any point of their box can have with the query, and the search ends where that
bound falls below the query's kth score.

The kth score travels: every query is first searched in one shard, and the k scores
found there are the starting bound in all the others.  A box that can only reach
smaller scores is skipped there without looking at its rows; at an equal score the
smaller ids of a box still count.

Scores are whole numbers, computed in 64-bit floats while they cannot exceed 2**53 and
in 64-bit integers above (a product that could exceed 2**62 is an error).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lacuna.llm import textwork as tw
from lacuna.session import cut_lineage

SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 4096, 2048, 64


class Tree:
    """Leaves of a KD-tree over integer rows: their rows, boxes and smallest ids."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order, cuts, todo = [], [0], [np.arange(len(ids))]
        while todo:
            own = todo.pop()
            lo, hi = rows[own].min(axis=0), rows[own].max(axis=0)
            side = int((hi - lo).argmax())
            if len(own) <= LEAF_ROWS or hi[side] == lo[side]:
                # rows that are all equal cannot be split: ids in order, in slices
                own = own[np.argsort(ids[own], kind="stable")]
                for at in range(0, len(own), LEAF_ROWS):
                    order.append(own[at : at + LEAF_ROWS])
                    cuts.append(cuts[-1] + len(order[-1]))
                continue
            half = len(own) // 2
            own = own[np.argpartition(rows[own, side], half)]
            todo += [own[half:], own[:half]]
        at = np.concatenate(order)
        self.ids, self.rows, self.cuts = ids[at], rows[at], np.array(cuts)
        begin = self.cuts[:-1]
        self.low = np.minimum.reduceat(self.rows, begin, axis=0)
        self.high = np.maximum.reduceat(self.rows, begin, axis=0)
        self.least_id = np.minimum.reduceat(self.ids, begin)

    def search(self, query: np.ndarray, query_id: int, k: int, bound: tuple | None, most: np.ndarray) -> list[tuple]:
        """The k best (-score, id) here that can beat ``bound``, the kth known so far.

        ``most`` has the largest possible score of each leaf.
        """
        best: list[tuple] = []
        for leaf in np.argsort(-most, kind="stable"):
            limit = bound
            if len(best) == k and (limit is None or best[-1] < limit):
                limit = best[-1]
            if limit is not None and -most[leaf] > limit[0]:
                break
            if limit is not None and -most[leaf] == limit[0] and self.least_id[leaf] > limit[1]:
                continue
            a, b = self.cuts[leaf], self.cuts[leaf + 1]
            ids, scores = self.ids[a:b], self.rows[a:b] @ query
            good = ids != query_id
            if limit is not None:
                good &= scores >= -limit[0]
            if good.any():
                best = sorted(best + list(zip((-scores[good]).tolist(), ids[good].tolist())))[:k]
        return best


def _exact(rows: np.ndarray, queries: np.ndarray) -> type:
    top = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1]
    if top >= 2.0**62:
        raise OverflowError("inner products of these vectors exceed 64-bit integers")
    return np.float64 if top < 2.0**53 else np.int64


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _search(queries: pd.DataFrame, shard: pd.DataFrame, k: int) -> pd.DataFrame:
    columns = ["query_id", "vec_id", "score"]
    if queries.empty or shard.empty:
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
    rows, asked = _matrix(shard["v"]), _matrix(queries["query"])
    kind = _exact(rows, asked)
    tree = Tree(shard["id"].to_numpy(), rows.astype(kind))
    asked = asked.astype(kind)
    up, down = np.maximum(asked, 0), np.minimum(asked, 0)
    most = up @ tree.high.T + down @ tree.low.T
    out: list[tuple] = []
    bounds = zip(queries["kth_score"], queries["kth_id"]) if "kth_score" in queries else [(None, None)] * len(queries)
    for n, (query_id, (score, last)) in enumerate(zip(queries["query_id"].to_numpy(), bounds)):
        bound = None if score is None or pd.isna(score) else (-int(score), int(last))
        for less, vec_id in tree.search(asked[n], query_id, k, bound, most[n]):
            out.append((int(query_id), int(vec_id), -int(less)))
    return pd.DataFrame(np.array(out, np.int64).reshape(-1, 3), columns=columns)


def _in_blocks(queries: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """Search results of every (block, shard) that both sides hold rows for."""
    keys = ["block", "shard"]
    return queries.groupBy(*keys).cogroup(shards.groupBy(*keys)).applyInPandas(
        lambda q, s: _search(q, s, k), "query_id long, vec_id long, score long"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vector: str = "embedding", row_id: str = "vec_id") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best rows of ``vectors`` for each query.

    Each component x becomes floor(``scale`` * x); the score is the inner product, ties
    go to the smaller id, and a query never finds rows of its own id.  Ids or vectors
    that are null, and vectors with null, non-finite or no components take no part;
    equal rows count once; vectors of different lengths do not meet.  Fewer than k
    other rows give all of them.
    """
    tw.prepare(vectors.sparkSession)
    x = F.col("x")
    usable = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(row_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"), is_query.alias("asked"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("x") > 0) & usable)
    scaled = F.transform("x", lambda c: F.floor(c * scale).cast("long"))
    rows = cut_lineage(rows.select("id", scaled.alias("v"), F.coalesce("asked", F.lit(False)).alias("asked")).distinct())
    size = F.size("v")
    sizes = rows.groupBy(size.alias("dim")).agg(F.count("*").alias("n"), F.count_if("asked").alias("q"))
    # one row per vector length: lengths are few, and each row is two numbers
    counts = cut_lineage(sizes.select(
        F.col("dim"), F.ceil(F.col("n") / SHARD_ROWS).cast("int").alias("shards"),
        F.greatest(F.ceil(F.col("q") / QUERY_ROWS), F.lit(1)).cast("int").alias("blocks"),
    ))
    placed = rows.join(counts, size == F.col("dim"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("id", F.lit(3)), "shards").cast("int"))
    placed = placed.withColumn("part", F.pmod(F.xxhash64("id", F.lit(5)), "blocks").cast("int"))

    def named(number: Column) -> Column:
        return F.struct("dim", number.alias("number"))

    shards = placed.select(
        "id", "v", named(F.col("own")).alias("shard"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )
    queries = placed.where("asked").select("id", "v", "dim", "shards", F.col("part").alias("block"))
    queries = cut_lineage(queries).toDF("query_id", "query", "dim", "shards", "block")
    # a first shard for each query, then the bound found there for all others
    first = F.pmod(F.xxhash64("block", F.lit(7)), "shards").cast("int")
    start = queries.select("query_id", "query", "block", named(first).alias("shard"))
    near = cut_lineage(_best(_in_blocks(start, shards, k), k))
    kth = near.where(F.col("rank") == k).select(
        "query_id", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("number")
    rest = queries.join(kth, "query_id", "left").select("*", first.alias("first"), other).where("number <> first")
    rest = rest.select("query_id", "query", "block", named(F.col("number")).alias("shard"), "kth_score", "kth_id")
    found = near.drop("rank").union(_in_blocks(rest, shards, k))
    return _best(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
