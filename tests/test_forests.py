"""Forests as nodes: cuts, permuted scores, and the nested search built on them."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lacuna.operators import forests, metrics, models
from lacuna.session import cut_lineage


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    made = []
    for i in range(400):
        x = [rng.gauss(0, 1) for _ in range(4)] + [1.0]
        made.append((i, i // 2, int(x[0] + x[1] * x[2] + rng.gauss(0, 0.7) > 0.4), x))
    df = spark.createDataFrame(made, "hadm_id long, subject_id long, target int, values array<double>")
    df = df.select("*", F.col("target").cast("double").alias("label"), F.lit(1.0).alias("weight"))
    return cut_lineage(df.withColumn("features", array_to_vector("values")))


def by_spark(model, rows):
    scored = model.transform(rows).select("hadm_id", vector_to_array("probability")[1].alias("p")).collect()
    return np.array([r.p for r in sorted(scored, key=lambda r: r.hadm_id)])


def by_nodes(forest, rows, cuts):
    scored = forests.score_cuts(rows, forest, cuts, ["hadm_id"]).collect()
    return np.array([r.scores for r in sorted(scored, key=lambda r: r.hadm_id)])


def test_nodes_score_as_the_model_does(rows):
    model = models.random_forest(12, 6).fit(rows)
    forest = forests.read_forest(model)
    assert len(forest.roots) == 12
    assert by_nodes(forest, rows, [(12, 6)])[:, 0] == pytest.approx(by_spark(model, rows))


@pytest.mark.parametrize("leaf", [1, 3])
def test_a_cut_tree_is_the_tree_grown_less_deep(rows, leaf):
    # one tree over all features draws nothing that depends on its depth
    grow = lambda d: models.random_forest(1, d, min_samples_leaf=leaf).setFeatureSubsetStrategy("all").fit(rows)
    forest = forests.read_forest(grow(9))
    depths = (1, 2, 3, 5, 9)
    cut = by_nodes(forest, rows, [(1, d) for d in depths])
    for k, d in enumerate(depths):
        assert cut[:, k] == pytest.approx(by_spark(grow(d), rows)), d


def test_permuted_scores_are_those_of_permuted_rows(rows):
    model = models.random_forest(9, 4).fit(rows)
    forest = forests.read_forest(model)
    pairs = cut_lineage(models.permuted_pairs(rows, 3, 42))
    keys = ["repeat", "feature"]
    mine = metrics.roc_auc(forests.score_permuted(pairs, forest, ["repeat", "target"]), within=keys)
    plain = models._scored(model, models.permuted_rows(rows, 5, 3, 42), *keys, "target")
    want = {(r.repeat, r.feature): r.roc_auc for r in metrics.roc_auc(plain, within=keys).collect()}
    got = {(r.repeat, r.feature): r.roc_auc for r in mine.collect()}
    assert set(got) == {(r, f) for r in range(3) for f in forest.used()}
    # sums of shares added in another order may part scores that tie
    assert all(want[k] == pytest.approx(v, abs=5e-3) for k, v in got.items())
    whole = metrics.roc_auc(models._scored(model, rows, "target")).first().roc_auc
    assert {f for _, f in set(want) - set(got)} == {4}  # the constant column
    assert all(want[r, 4] == pytest.approx(whole) for r in range(3))


@pytest.mark.parametrize(
    "learner, grid",
    [
        ("random_forest", {"n_estimators": (3, 6), "max_depth": (2, 4), "class_weight": (None, "balanced", {0: 0.5, 1: 2})}),
    ],
)
def test_nested_search_scores_every_row_by_one_chosen_point(spark, rows, learner, grid):
    frame = cut_lineage(rows.select("hadm_id", "subject_id", "target", "label", "values", (F.col("subject_id") % 2).cast("int").alias("fold")))
    found, scores = models.nested_search(frame, "abcde", grid, learner, k=2, inner=2)
    table = found.collect()
    points = models.grid_points(grid)
    assert len(table) == 2 * len(points)
    for fold in (0, 1):
        part = sorted((r for r in table if r.fold == fold), key=lambda r: r.point)
        best = max(part, key=lambda r: r.inner_auc)
        assert [r.point for r in part if r.chosen] == [best.point]
        if learner == "random_forest":  # after oversampling, balanced weights are all 1
            auc = {r.params: r.inner_auc for r in part}
            for p in points:
                if p["class_weight"] is None:
                    assert auc[str(p)] == auc[str(p | {"class_weight": "balanced"})]
    assert sorted(r.hadm_id for r in scores.collect()) == list(range(400))
    assert metrics.roc_auc(scores).first().roc_auc > 0.7
