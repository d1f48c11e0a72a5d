"""Fitted forests as arrays of nodes: one fit answers for many settings.

The trees of a forest are drawn independently of each other, and a tree of depth d is
the top of the same tree grown deeper, once sibling leaves with one prediction are
merged as Spark merges them.  So the first n trees of a large forest, cut at depth d,
are a forest of n trees of depth d.  A search over numbers of trees and depths needs a
fit only per remaining setting, and scores all its cuts in one pass over the rows.

A forest has at most ``trees * 2 ** (depth + 1)`` nodes of 40 bytes; that bound, set by
its parameters and not by the rows, is what reaches the driver and the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.session import new_path

CELLS = 1_000_000  # rows x trees walked at once


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees, a parent before its children; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray  # share of class 1 among the rows of the node
    prediction: np.ndarray
    depth: np.ndarray

    def cut(self, depth: int) -> Forest:
        """The same trees grown to ``depth`` only."""
        own = np.arange(len(self.left))
        leaf = (self.left == own) | (self.depth >= depth)
        for at in np.flatnonzero(~leaf)[::-1]:
            a, b = self.left[at], self.right[at]
            leaf[at] = leaf[a] and leaf[b] and self.prediction[a] == self.prediction[b]
        return replace(self, left=np.where(leaf, own, self.left), right=np.where(leaf, own, self.right))

    def tree_shares(self, x: np.ndarray) -> np.ndarray:
        """Share of class 1 at the leaf of every row (first axis) in every tree."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        while True:
            below = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            if (below == at).all():
                return self.share[at]
            at = below

    def used(self) -> np.ndarray:
        """Features that some tree splits on."""
        return np.unique(self.feature[self.left != np.arange(len(self.left))])

    def trees_with(self, feature: int) -> np.ndarray:
        """Trees that split on ``feature``."""
        nodes = np.flatnonzero((self.feature == feature) & (self.left != np.arange(len(self.left))))
        return np.unique(np.searchsorted(self.roots, nodes, side="right") - 1)

    def some(self, trees: np.ndarray) -> Forest:
        return replace(self, roots=self.roots[trees])


def read_forest(model: Model) -> Forest:
    """Nodes of a fitted two-class forest over numbers, read from its saved form."""
    spark = SparkSession.active()
    path = new_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    found = (
        spark.read.parquet(f"{path}/data")
        .select(
            F.col("treeID").alias("tree"),
            node["id"].alias("id"),
            node["leftChild"].alias("left"),
            node["rightChild"].alias("right"),
            node["prediction"].alias("prediction"),
            (node["impurityStats"][1] / (node["impurityStats"][0] + node["impurityStats"][1])).alias("share"),
            node["split"]["featureIndex"].alias("feature"),
            F.coalesce(F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)).alias("threshold"),
            node["split"]["numCategories"].alias("categories"),
        )
        .toPandas()
        .sort_values(["tree", "id"])
    )
    if (found.categories >= 0).any():
        raise ValueError("only splits of numbers can be read")
    roots = np.flatnonzero(found.id.to_numpy() == 0)
    base = roots[found.tree.to_numpy()]
    own = np.arange(len(found))
    left, right = (np.where(found[c] < 0, own, found[c] + base) for c in ("left", "right"))
    depth = np.zeros(len(found), np.int32)
    for at in np.flatnonzero(left != own):
        depth[left[at]] = depth[right[at]] = depth[at] + 1
    feature = np.maximum(found.feature.to_numpy(), 0)
    return Forest(
        roots, feature, found.threshold.to_numpy(), left, right, found.share.to_numpy(), found.prediction.to_numpy(), depth
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def score_cuts(
    rows: DataFrame, forest: Forest, cuts: Sequence[tuple[int, int]], keep: Sequence[str], features: str = "features"
) -> DataFrame:
    """``keep`` and the array ``scores``: the probability of class 1 by the forest's
    first n trees cut at depth d, for each (n, d) of ``cuts``."""
    shallow = {depth: forest.cut(depth) for _, depth in cuts}
    sent = rows.sparkSession.sparkContext.broadcast(shallow)
    kept = rows.select(*keep)
    schema = T.StructType([*kept.schema.fields, T.StructField("scores", T.ArrayType(T.DoubleType()))])
    step = max(1, CELLS // len(forest.roots))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), step):
                batch = whole.slice(start, step)
                x = _matrix(batch.column("_x"))
                shares = {depth: trees.tree_shares(x) for depth, trees in sent.value.items()}
                scores = np.column_stack([shares[depth][:, :n].mean(axis=1) for n, depth in cuts])
                ends = np.arange(len(x) + 1, dtype=np.int32) * len(cuts)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(scores.ravel()))
                yield pa.RecordBatch.from_arrays([*map(batch.column, keep), lists], [*keep, "scores"])

    return rows.select(*keep, vector_to_array(features).alias("_x")).mapInArrow(work, schema)


def score_permuted(pairs: DataFrame, forest: Forest, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``feature`` and ``score`` for every feature that the forest splits on.

    ``pairs`` hold a row's features as the array ``own`` and those of the row it borrows
    from as ``other``.  For one feature after the other its value is taken from
    ``other``; only the trees that split on it are walked again.
    """
    sent = pairs.sparkSession.sparkContext.broadcast(forest)
    kept = pairs.select(*keep)
    schema = T.StructType(
        [*kept.schema.fields, T.StructField("feature", T.IntegerType()), T.StructField("score", T.DoubleType())]
    )
    step = max(1, CELLS // len(forest.roots))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = sent.value
        parts = [(int(f), at, trees.some(at)) for f in trees.used() for at in [trees.trees_with(f)]]
        for whole in batches:
            for start in range(0, len(whole), step):
                batch = whole.slice(start, step)
                own, other = _matrix(batch.column("own")).copy(), _matrix(batch.column("other"))
                base = trees.tree_shares(own)
                for feature, at, some in parts:
                    before = own[:, feature].copy()
                    own[:, feature] = other[:, feature]
                    shares = base.copy()
                    shares[:, at] = some.tree_shares(own)
                    own[:, feature] = before
                    columns = [pa.array(np.full(len(own), feature, np.int32)), pa.array(shares.mean(axis=1))]
                    yield pa.RecordBatch.from_arrays([*map(batch.column, keep), *columns], [*keep, "feature", "score"])

    return pairs.select(*keep, "own", "other").mapInArrow(work, schema)
