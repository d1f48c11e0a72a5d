"""Ranking, splits, resampling, metrics, imputation and models."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lacuna.config import ExperimentConfig
from lacuna.functions import hashing
from lacuna.operators import impute, matrix, metrics, models, quality, ranking, sampling
from lacuna.plans import experiment
from lacuna.session import cut_lineage


def test_row_number_is_the_global_order(spark):
    df = spark.range(3000).withColumn("d", hashing.digest("id", seed=1))
    got = ranking.with_row_number(df, "d", "rn").collect()
    assert [r.rn for r in sorted(got, key=lambda r: r.d)] == list(range(3000))
    grouped = df.withColumn("g", F.col("id") % 3)
    for g in range(3):
        part = [r for r in ranking.with_row_number(grouped, "d", "rn", ["g"]).collect() if r.g == g]
        assert [r.rn for r in sorted(part, key=lambda r: r.d)] == list(range(1000))


def test_running_totals_with_skewed_and_equal_values(spark):
    rng = random.Random(3)
    values = {rng.choice([rng.random() * 1e-7, rng.random(), -rng.random() * 50]) for _ in range(900)}
    rows = [(g, v, rng.randrange(5)) for g in ("a", "b") for v in values] + [("c", 1.5, 4)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = ranking.with_running_totals(df, "v", ["n"], ["g"]).collect()
    for g in ("a", "b", "c"):
        total = 0
        for r in sorted((r for r in got if r.g == g), key=lambda r: r.v):
            total += r.n
            assert r.cum_n == total
    medians = {r.g: r.median for r in ranking.median(df, "v", ["g"]).collect()}
    assert medians["c"] == 1.5
    assert medians["a"] == pytest.approx(float(np.median(list(values))))


def labelled(spark, n=400, seed=5):
    """Subjects of very different size; one holds a third of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        subject = 0 if i % 3 == 0 else rng.randrange(1, 120)
        rows.append((i, subject, int(rng.random() < 0.2)))
    return spark.createDataFrame(rows, "hadm_id bigint, subject_id bigint, target int")


def test_folds_keep_subjects_together_and_cover_all_rows(spark):
    df = labelled(spark)
    folded = sampling.group_folds(df, k=5)
    assert folded.count() == df.count()
    assert folded.groupBy("subject_id").agg(F.count_distinct("fold").alias("n")).filter("n > 1").isEmpty()
    without_hot = sampling.group_folds(df.filter("subject_id > 0"), k=5)
    rates = [r.positive_rate for r in sampling.fold_balance(without_hot).collect()]
    whole = df.filter("subject_id > 0").agg(F.avg("target")).first()[0]
    assert len(rates) == 5 and all(abs(r - whole) < 0.1 for r in rates)


def test_oversampling_equalises_classes(spark, monkeypatch):
    monkeypatch.setattr(sampling, "DRAWS_PER_CHUNK", 16)
    df = labelled(spark)
    up = sampling.oversample(df)
    sizes = {r.target: r["count"] for r in up.groupBy("target").count().collect()}
    assert sizes[0] == sizes[1]
    assert up.filter("draw = -1").drop("draw").exceptAll(df).isEmpty()
    draws = [r.draw for r in up.filter("draw >= 0").collect()]
    assert sorted(draws) == list(range(len(draws)))
    # equal classes stay as they are
    assert sampling.oversample(sampling.undersample(df)).filter("draw >= 0").isEmpty()


def test_undersampling_and_weights(spark):
    df = labelled(spark)
    down = sampling.undersample(df)
    sizes = {r.target: r["count"] for r in down.groupBy("target").count().collect()}
    assert sizes[0] == sizes[1] == df.filter("target = 1").count()
    weighted = sampling.class_weights(df, mode="balanced")
    totals = {r.target: r.w for r in weighted.groupBy("target").agg(F.sum("weight").alias("w")).collect()}
    assert totals[0] == pytest.approx(200) and totals[1] == pytest.approx(200)
    # on equal classes balanced weights are 1
    assert sampling.class_weights(down, mode="balanced").filter("weight <> 1").isEmpty()
    with pytest.raises(ValueError):
        sampling.class_weights(df, mode="other")


def test_holdout_size(spark):
    split = sampling.holdout(labelled(spark, 101))
    assert split.filter("is_test = 1").count() == math.ceil(0.2 * 101)


def test_auc_agrees_with_spark_evaluator(spark):
    rng = random.Random(11)
    rows = [(float(y := int(rng.random() < 0.3)), round(min(max(rng.gauss(0.4 + 0.2 * y, 0.2), 0.0), 1.0), 3)) for _ in range(800)]
    df = spark.createDataFrame(rows, "target double, score double")
    expected = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="target", numBins=0
    ).evaluate(df)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(expected, abs=1e-9)
    grouped = df.withColumn("fold", F.lit(1)).unionByName(df.withColumn("fold", F.lit(2)))
    assert [r.roc_auc for r in metrics.roc_auc(grouped, within=["fold"]).collect()] == pytest.approx(
        [expected, expected]
    )
    assert metrics.roc_auc(df.filter("target = 1")).first()[0] is None


def brute_knn(rows, donors, k):
    """Reference by plain loops."""
    size = len(next(iter(rows.values())))
    out = {}
    for key, row in rows.items():
        filled = list(row)
        for f in range(size):
            if row[f] is not None:
                continue
            found = []
            for donor, other in donors.items():
                if other[f] is None:
                    continue
                shared = [(a - b) ** 2 for a, b in zip(row, other) if a is not None and b is not None]
                if shared:
                    found.append((round(math.sqrt(sum(shared) * size / len(shared)), 9), donor))
            known = [d[f] for d in donors.values() if d[f] is not None]
            if found:
                best = sorted(found)[:k]
                filled[f] = sum(donors[d][f] for _, d in best) / len(best)
            elif known:
                filled[f] = sum(known) / len(known)
        out[key] = filled
    return out


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_knn_matches_brute_force(spark, block_rows):
    rng = random.Random(21)
    rows = {
        i: [None if rng.random() < 0.35 else round(rng.uniform(0, 10), 1) for _ in range(4)] + [None]
        for i in range(60)
    }
    rows[60] = [None] * 5
    donors = {k: v for k, v in rows.items() if k % 4}
    df = spark.createDataFrame(list(rows.items()), "hadm_id bigint, values array<double>")
    got = impute.knn_impute(df, df.filter("hadm_id % 4 <> 0"), k=3, block_rows=block_rows)
    expected = brute_knn(rows, donors, 3)
    found = {r.hadm_id: r["values"] for r in got.collect()}
    assert found.keys() == expected.keys()
    for key, values in expected.items():
        assert found[key] == pytest.approx(values, abs=1e-9)


def test_vector_and_pivot_hold_the_same_cells(spark):
    rows = [(1, 7, 0, 1.5), (1, 9, 2, 2.5), (2, 9, 1, None)]
    cells = spark.createDataFrame(rows, "hadm_id bigint, itemid int, bin int, filled double")
    names = matrix.feature_columns([7, 9], 2)
    wide = {r.hadm_id: [r[n] for n in names] for r in matrix.pivot_features(cells, [7, 9], 2).collect()}
    packed = {r.hadm_id: r["values"] for r in matrix.vector_features(cells, [7, 9], 2).collect()}
    assert wide == packed == {1: [1.5, None, None, None, None, 2.5], 2: [None] * 6}


def test_duplicate_labels_fail(spark):
    rows = spark.createDataFrame([(1, 0), (1, 0), (2, 1)], "hadm_id int, target int")
    assert quality.require_unique(rows, "hadm_id").count() == 2
    clash = spark.createDataFrame([(1, 0), (1, 1)], "hadm_id int, target int")
    with pytest.raises(Exception, match="not unique"):
        quality.require_unique(clash, "hadm_id").collect()


@pytest.fixture(scope="module")
def frame(spark):
    """Feature 0 carries the label, feature 1 is noise, feature 2 has gaps."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        y = int(rng.random() < 0.3)
        gap = None if rng.random() < 0.5 else rng.random()
        rows.append((i, [y + rng.gauss(0, 0.3), rng.random(), gap]))
        labels.append((i, i // 2, y))
    features = spark.createDataFrame(rows, "hadm_id bigint, values array<double>")
    return models.training_frame(
        features, spark.createDataFrame(labels, "hadm_id bigint, subject_id bigint, target int"), k=2
    )


def forest(_):
    return models.random_forest(n_estimators=10, max_depth=3)


def test_cross_validation_scores_every_row_once(frame):
    scores = models.cross_validate(frame, "abc", forest, k=2, masks=True)
    assert scores.count() == 240 and scores.select("hadm_id").distinct().count() == 240
    folds = models.fold_metrics(scores)
    assert folds.filter("roc_auc > 0.85").count() == 2
    summary = metrics.fold_summary(folds, ("recall", "roc_auc")).collect()
    assert {r.metric for r in summary} == {"recall", "roc_auc"}


def test_importances_find_the_informative_feature(frame):
    impurity = models.impurity_importance(frame, "abc", forest, k=2)
    assert models.top_features(impurity, 1).first().feature == "a"
    shuffled = models.permutation_importance(frame, "abc", forest, k=2, repeats=2)
    top = models.top_features(shuffled).collect()
    assert top[0].feature == "a" and top[0].mean_importance > 0.1 and len(top) == 3


def test_grid_search_chooses_one_point_per_fold(frame):
    grid = {"n_estimators": (5,), "max_depth": (1, 3), "class_weight": (None, "balanced")}
    found = models.grid_search(frame, "abc", grid, k=2, inner=2)
    assert found.count() == 8
    best = found.filter("chosen = 1").collect()
    assert len(best) == 2 and all(r.outer_auc > 0.8 for r in best)
    assert len(models.grid_points(models.FOREST_GRID)) == 32


@pytest.mark.parametrize(
    "make",
    [models.logistic_regression, lambda _: models.boosted_trees(3, 2), lambda _: models.perceptron(3, (4,), 40)],
)
def test_other_learners(frame, make):
    folds = models.fold_metrics(models.cross_validate(frame, "abc", make, k=2))
    assert folds.filter("roc_auc > 0.8").count() == 2


def test_forest_parameters():
    made = models.random_forest(n_estimators=7, max_depth=4, min_samples_split=5, min_samples_leaf=None)
    assert (made.getNumTrees(), made.getMaxDepth(), made.getMinInstancesPerNode()) == (7, 4, 3)
    assert models.logistic_regression(100, "l1", 0.1).getRegParam() == pytest.approx(0.1)
    assert not models.logistic_regression(100).getStandardization()
    with pytest.raises(ValueError):
        models.logistic_regression(100, "elastic")


def test_a_learner_without_row_weights_refuses_class_weights(frame):
    make = lambda _: models.perceptron(3, (4,), 5)
    with pytest.raises(ValueError, match="no row weights"):
        models.fit_fold(frame, "abc", 0, make, weights={0: 1, 1: 2})


@pytest.mark.parametrize("feature_set", ["V", "M", "VMD"])
def test_feature_vectors_of_an_extract(spark, feature_set):
    from test_series import random_labs

    config = ExperimentConfig(feature_set=feature_set, bin_hours=24)
    labs = random_labs(spark, 3)
    names = experiment.feature_names(config, [1, 2, 3])
    rows = experiment.feature_vectors(labs, config, [1, 2, 3]).collect()
    assert len(names) == 3 * 8 * len(feature_set)
    assert len(rows) == labs.select("hadm_id").distinct().count()
    assert all(len(r["values"]) == len(names) for r in rows)
    if feature_set == "M":
        assert {x for r in rows for x in r["values"]} == {0.0, 1.0}


def test_experiment_end_to_end(spark, tmp_path):
    from test_series import random_labs

    labs = random_labs(spark, 6, admissions=60, rows=900)
    config = ExperimentConfig(bin_hours=24, folds=2, model="logistic_regression", metrics=("recall", "precision"))
    found = experiment.run_experiment(labs, config, output=str(tmp_path / "folds"))
    assert found.columns == ["fold", "recall", "f1", "roc_auc", "precision"] and found.count() == 2
    assert {r.metric for r in experiment.summarise(found, config).collect()} == {"recall", "precision"}
    with pytest.raises(ValueError):
        experiment.labels_of(labs, ExperimentConfig(label="race"))


def test_knn_rules_out_far_blocks_and_keeps_ties(spark):
    rng = np.random.default_rng(4)
    centres = rng.uniform(-1000, 1000, (12, 6))
    cells = np.round(np.repeat(centres, 50, axis=0) + rng.normal(0, 1, (600, 6)), 1)
    cells[::7, 2] = np.nan
    cells[1::50] = cells[2::50]  # equal rows: the smaller key wins
    rows = {f"k{i:03d}": [None if np.isnan(x) else float(x) for x in row] for i, row in enumerate(cells)}
    donors = {k: v for k, v in rows.items() if int(k[1:]) % 3}
    df = spark.createDataFrame(list(rows.items()), "hadm_id string, values array<double>")
    tiles: list[int] = []
    pool = df.filter("int(substring(hadm_id, 2)) % 3 <> 0")
    found = {r.hadm_id: r["values"] for r in impute.knn_impute(df, pool, k=3, block_rows=20, report=tiles).collect()}
    # string keys of one length sort as their numbers
    expected = brute_knn({k: v for k, v in rows.items() if None in v}, donors, 3)
    for key, values in expected.items():
        assert found[key] == pytest.approx(values, abs=1e-9)
    assert found.keys() == rows.keys() and tiles[0] < tiles[1] / 4


def test_box_distance_is_a_lower_bound():
    rng = np.random.default_rng(9)

    def box(x):
        seen = ~np.isnan(x)
        return np.where(seen, x, np.inf).min(0), np.where(seen, x, -np.inf).max(0), seen.all(0)

    for share in (0.0, 0.2, 0.6):
        for _ in range(100):
            a, b = (rng.normal(c, 1, (4, 5)) for c in (0, 3))
            a[rng.random(a.shape) < share], b[rng.random(b.shape) < share] = np.nan, np.nan
            assert np.sqrt(impute.lowest_distance(*box(a), *box(b))) <= impute._distances(a, b).min() + 1e-8


def test_packed_blocks_are_never_broadcast(spark, monkeypatch):
    """Their files are small, their rows are not: the plans before any run."""
    rng = random.Random(5)
    rows = [(i, [None if rng.random() < 0.5 else round(rng.uniform(0, 9), 1) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "hadm_id bigint, values array<double>")
    plans: list[str] = []

    def cut(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(frame)

    monkeypatch.setattr(impute, "cut_lineage", cut)
    got = impute.knn_impute(df, df, k=2, block_rows=10)
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in plan and "mat#" in plan for plan in plans)
    for plan in plans:
        lines = plan.splitlines()
        for at, line in enumerate(lines):
            if "BroadcastExchange" in line:
                below = lines[at + 1]
                assert not any(f"{c}#" in below for c in ("mat", "known", "fills", "ids")), below


def test_blocks_of_donors_and_pairs_of_boxes_are_not_shuffled(spark, monkeypatch):
    """Each group of receivers would get a copy of the donors, and the files grow with the pairs."""
    rng = random.Random(6)
    rows = [(i, [None if rng.random() < 0.5 else round(rng.uniform(0, 9), 1) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "hadm_id bigint, values array<double>")
    plans: list[str] = []

    def cut(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(frame)

    monkeypatch.setattr(impute, "cut_lineage", cut)
    found = {r.hadm_id: r["values"] for r in impute.knn_impute(df, df, k=2, block_rows=10).collect()}
    assert found[0] == pytest.approx(brute_knn(dict(rows), dict(rows), 2)[0], abs=1e-9)
    folds = [plan for plan in plans if "known#" in plan and "MapInArrow" in plan]
    assert len(folds) == 2 and any("low_a#" in plan for plan in plans)
    for plan in plans:
        lines = plan.splitlines()
        for at, line in enumerate(lines):
            if " Exchange " in line:
                below = lines[at + 1]
                sent = below.rpartition(")#")[2] if "MapInArrow" in below else " ".join(lines[at : at + 3])
                assert not ("low_b#" in sent or "known#" in plan and "ids#" in sent), sent
