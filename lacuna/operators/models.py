"""Classifiers over the feature matrix: cross-validation, grid search, importances.

The driver loops over folds and submits Spark jobs; rows, scores and metrics stay
in DataFrames.  Only model parameters (column medians, importances) come back.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model, Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions import hashing
from lacuna.operators import forests, metrics, sampling
from lacuna.operators.ranking import median, with_row_number
from lacuna.session import cut_lineage, new_path

LABEL, FEATURES = "label", "features"
Weights = str | Mapping[int, float] | None

# The default forest and the search grids.
FOREST = {"n_estimators": 200, "max_depth": 10, "min_samples_split": 5, "min_samples_leaf": 1}
FOREST_GRID = {
    "n_estimators": (100, 200),
    "max_depth": (5, 10),
    "min_samples_split": (2, 5),
    "min_samples_leaf": (1,),
    "class_weight": (None, "balanced", {0: 0.5, 1: 1}, {0: 0.5, 1: 2}),
}
LOGISTIC = {"penalty": "l2", "C": 1.0}
LOGISTIC_GRID = {"penalty": ("l1", "l2"), "C": (0.1, 1.0, 10.0)}


def random_forest(
    n_estimators: int = 200,
    max_depth: int = 10,
    min_samples_split: int = 2,
    min_samples_leaf: int | None = 1,
    seed: int = 42,
) -> RandomForestClassifier:
    """Forest with square-root feature sampling.

    Spark has no minimum size for splitting; a node that may not be split below
    ``s`` rows is approximated by leaves of at least ``s / 2`` rows.
    """
    leaf = max(min_samples_leaf or 1, (min_samples_split + 1) // 2)
    return RandomForestClassifier(
        labelCol=LABEL,
        featuresCol=FEATURES,
        weightCol="weight",
        numTrees=n_estimators,
        maxDepth=max_depth,
        minInstancesPerNode=leaf,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )


def logistic_regression(total_weight: float, penalty: str = "l2", C: float = 1.0) -> LogisticRegression:
    """``C`` weighs the summed loss against the penalty; Spark averages the loss,
    hence the division by the total weight of the rows.  The penalty acts on the
    coefficients of the columns as they are."""
    if penalty not in ("l1", "l2"):
        raise ValueError("penalty must be 'l1' or 'l2'")
    return LogisticRegression(
        labelCol=LABEL,
        featuresCol=FEATURES,
        weightCol="weight",
        regParam=1.0 / (C * total_weight),
        standardization=False,
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
    )


def boosted_trees(max_iter: int = 20, max_depth: int = 5, seed: int = 42) -> GBTClassifier:
    return GBTClassifier(
        labelCol=LABEL,
        featuresCol=FEATURES,
        weightCol="weight",
        maxIter=max_iter,
        maxDepth=max_depth,
        seed=seed,
    )


def perceptron(inputs: int, hidden: Sequence[int] = (16,), max_iter: int = 100, seed: int = 42) -> Pipeline:
    """Standardised inputs, one or more hidden layers, two outputs."""
    scale = StandardScaler(inputCol=FEATURES, outputCol="scaled", withMean=True)
    net = MultilayerPerceptronClassifier(
        labelCol=LABEL,
        featuresCol="scaled",
        layers=[inputs, *hidden, 2],
        maxIter=max_iter,
        seed=seed,
    )
    return Pipeline(stages=[scale, net])


def _takes_weights(estimator: Estimator) -> bool:
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else [estimator]
    return any(stage.hasParam("weightCol") for stage in stages)


def column_medians(train: DataFrame, size: int) -> list[float]:
    """Training median per feature; 0 for a feature without any value.  Only one
    number per feature comes back to the driver."""
    cells = train.select(F.posexplode("values").alias("at", "x")).filter("x IS NOT NULL")
    found = median(cells, "x", ["at"]).collect()
    medians = dict(map(tuple, found))
    return [medians.get(i, 0.0) for i in range(size)]


def to_vectors(df: DataFrame, medians: Sequence[float], masks: bool = False) -> DataFrame:
    """Feature vector per row; missing values get the median and, with ``masks``,
    a 0/1 entry that says so."""
    fallback = F.array(*[F.lit(m) for m in medians])
    cells = F.transform("values", lambda x, i: F.coalesce(x, F.get(fallback, i)))
    if masks:
        seen = F.transform("values", lambda x: x.isNotNull().cast("double"))
        cells = F.concat(cells, seen)
    return df.withColumn(FEATURES, array_to_vector(cells))


def training_frame(
    features: DataFrame, labels: DataFrame, k: int = 5, seed: int = 42
) -> DataFrame:
    """Feature rows (``values`` array) with subject, label and fold, written once
    for all fits."""
    labelled = cut_lineage(
        features.join(labels.select("hadm_id", "subject_id", "target"), "hadm_id")
    )
    folded = sampling.group_folds(labelled, k=k, seed=seed)
    return cut_lineage(folded.withColumn(LABEL, F.col("target").cast("double")))


def _scored(model: Model, rows: DataFrame, *keep: str | Column) -> DataFrame:
    scored = model.transform(rows)
    return scored.select(*keep, vector_to_array("probability")[1].alias("score"))


def fit_fold(
    frame: DataFrame,
    columns: Sequence[str],
    fold: int,
    make: Callable[[float], Estimator],
    weights: Weights = None,
    seed: int = 42,
    masks: bool = False,
) -> tuple[Model, DataFrame, DataFrame]:
    """Model of one fold, its (oversampled) training rows and its test rows.
    ``make`` gets the total weight of the training rows."""
    train = frame.filter(F.col("fold") != fold)
    medians = column_medians(train, len(columns))
    balanced = sampling.oversample(train, "target", seed=seed)
    weighted = sampling.class_weights(balanced, "target", weights)
    fitted = cut_lineage(
        to_vectors(weighted, medians, masks).select(
            "hadm_id", "subject_id", "target", LABEL, "weight", FEATURES
        )
    )
    test = to_vectors(frame.filter(F.col("fold") == fold), medians, masks)
    estimator = make(fitted.agg(F.sum("weight")).first()[0])
    if weights is not None and not _takes_weights(estimator):
        raise ValueError("this learner has no row weights")
    return estimator.fit(fitted), fitted, test


def cross_validate(
    frame: DataFrame,
    columns: Sequence[str],
    make: Callable[[int], Estimator],
    k: int = 5,
    weights: Weights = None,
    seed: int = 42,
    masks: bool = False,
) -> DataFrame:
    """Out-of-fold scores: hadm_id, fold, target, score."""
    parts = []
    for fold in range(k):
        model, _, test = fit_fold(frame, columns, fold, make, weights, seed, masks)
        parts.append(_scored(model, test, "hadm_id", "fold", "target"))
    return cut_lineage(reduce(DataFrame.unionByName, parts))


def fold_metrics(scores: DataFrame) -> DataFrame:
    """All metrics per fold."""
    within = ["fold"]
    return (
        metrics.confusion(scores, within=within)
        .join(metrics.roc_auc(scores, within=within), within)
        .join(metrics.pr_auc(scores, within=within), within)
    )


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def _candidates(learner: str, points: Sequence[dict], same: Sequence[int], seed: int) -> dict[tuple, list[tuple[int, dict]]]:
    """Points by the fit that answers for them: a forest serves every number of trees and
    depth, a regression only its own point.  ``same[i]`` is the weight column of point i."""
    fits: dict[tuple, list[tuple[int, dict]]] = {}
    for i, point in enumerate(points):
        settings = {p: v for p, v in point.items() if p != "class_weight"}
        key: tuple = (same[i], i)
        if learner == "random_forest":
            key = (same[i], random_forest(**settings, seed=seed).getMinInstancesPerNode())
        fits.setdefault(key, []).append((i, settings))
    return fits


def _estimator(learner: str, settings: Mapping, weight: str, total: float, seed: int) -> Estimator:
    made = random_forest(**settings, seed=seed) if learner == "random_forest" else logistic_regression(total, **settings)
    return made.setWeightCol(weight)


def _fit_and_score(
    learner: str, members: Sequence[tuple[int, dict]], train: DataFrame, test: DataFrame, weight: str, keep: Sequence[str], seed: int
) -> DataFrame:
    """``keep``, ``point`` and ``score`` of the test rows for all points that one fit serves."""
    total = train.agg(F.sum(weight)).first()[0]
    if learner != "random_forest":
        (point, settings), = members
        model = _estimator(learner, settings, weight, total, seed).fit(train)
        return _scored(model, test, *keep, F.lit(point).alias("point"))
    shapes = [random_forest(**settings, seed=seed) for _, settings in members]
    cuts = [(f.getNumTrees(), f.getMaxDepth()) for f in shapes]
    largest = members[0][1] | {"n_estimators": max(n for n, _ in cuts), "max_depth": max(d for _, d in cuts)}
    model = _estimator(learner, largest, weight, total, seed).fit(train)
    scored = forests.score_cuts(test, forests.read_forest(model), cuts, keep, FEATURES)
    of = F.array(*[F.lit(i) for i, _ in members])
    return scored.select(*keep, F.posexplode("scores").alias("_at", "score")).select(
        *keep, F.get(of, F.col("_at")).alias("point"), "score"
    )


def nested_search(
    frame: DataFrame,
    columns: Sequence[str],
    grid: Mapping[str, Sequence] = FOREST_GRID,
    learner: str = "random_forest",
    k: int = 5,
    inner: int = 3,
    seed: int = 42,
    parallelism: int = 8,
) -> tuple[DataFrame, DataFrame]:
    """Nested cross-validation: in every outer fold each point of the grid is scored by its
    mean ROC-AUC over inner folds, the best (the first among equals) is fitted again on the
    whole outer training part, and scores the outer test part.

    Gives ``fold, point, params, inner_auc, chosen`` and the outer scores ``hadm_id, fold,
    target, score``.  Training rows are oversampled before the inner split; copies carry
    their subject's inner fold, so no copy is validated against its original.

    A fold's training rows are stored once with a weight column per class-weight mode;
    modes that give equal weights share their fits, as do the numbers of trees and the
    depths of forests (see ``forests``).  All fits run as parallel jobs; each writes its
    scores, so nothing but one AUC per point and fold reaches the driver.
    """
    if learner not in ("random_forest", "logistic_regression"):
        raise ValueError("only forests and logistic regressions are searched")
    spark = frame.sparkSession
    points = grid_points(grid)
    modes: list[Weights] = []
    for point in points:
        if point.get("class_weight") not in modes:
            modes.append(point.get("class_weight"))
    names = [f"weight_{i}" for i in range(len(modes))]
    place = [modes.index(point.get("class_weight")) for point in points]

    def prepare(fold: int) -> tuple[DataFrame, DataFrame, list[int]]:
        train = frame.filter(F.col("fold") != fold)
        medians = column_medians(train, len(columns))
        split = cut_lineage(sampling.group_folds(train, k=inner, seed=seed, name="inner_fold"))
        rows = sampling.oversample(split, "target", seed=seed)
        for name, mode in zip(names, modes, strict=True):
            rows = sampling.class_weights(rows, "target", mode, name=name)
        stored = cut_lineage(to_vectors(rows, medians).select("inner_fold", "target", LABEL, FEATURES, *names))
        weights = stored.groupBy("target").agg(*[F.first(n).alias(n) for n in names]).orderBy("target").collect()
        per_mode = [tuple(r[n] for r in weights) for n in names]
        same = [per_mode.index(per_mode[place[i]]) for i in range(len(points))]
        return stored, to_vectors(frame.filter(F.col("fold") == fold), medians), same

    inner_path, outer_path = new_path(spark, "inner"), new_path(spark, "outer")

    def inner_fit(job: tuple) -> None:
        fold, part, key, members = job
        stored = prepared[fold][0]
        train, test = (stored.filter(F.col("inner_fold") != part), stored.filter(F.col("inner_fold") == part))
        scored = _fit_and_score(learner, members, train, test, names[key[0]], ["target"], seed)
        number = fits[fold].index((key, members))
        scored.write.parquet(f"{inner_path}/fold={fold}/inner_fold={part}/fit={number}")

    def outer_fit(fold: int) -> None:
        stored, test, same = prepared[fold]
        members = [m for _, group in fits[fold] for m in group if m[0] == best[fold]]
        scored = _fit_and_score(learner, members, stored, test, names[same[best[fold]]], ["hadm_id", "target"], seed)
        scored.drop("point").write.parquet(f"{outer_path}/fold={fold}")

    with ThreadPool(parallelism) as pool:
        run = lambda work, jobs: pool.map(inheritable_thread_target(spark)(work), jobs, chunksize=1)
        prepared = run(prepare, range(k))
        fits = [list(_candidates(learner, points, same, seed).items()) for _, _, same in prepared]
        run(inner_fit, [(f, part, *fit) for f in range(k) for fit in fits[f] for part in range(inner)])
        scores = spark.read.parquet(inner_path)
        aucs = metrics.roc_auc(scores, within=["fold", "inner_fold", "point"])
        means = {(r.fold, r.point): r.auc for r in aucs.groupBy("fold", "point").agg(F.avg("roc_auc").alias("auc")).collect()}
        best = [max(range(len(points)), key=lambda i: means[f, i]) for f in range(k)]
        run(outer_fit, range(k))
    found = spark.createDataFrame(
        [(f, i, str(p), means[f, i], int(i == best[f])) for f in range(k) for i, p in enumerate(points)],
        "fold int, point int, params string, inner_auc double, chosen int",
    )
    return found, spark.read.parquet(outer_path)


def grid_search(
    frame: DataFrame,
    columns: Sequence[str],
    grid: Mapping[str, Sequence] = FOREST_GRID,
    k: int = 5,
    inner: int = 3,
    seed: int = 42,
    parallelism: int = 8,
    learner: str = "random_forest",
) -> DataFrame:
    """``nested_search`` as one table: per outer fold the inner AUC of every grid point,
    which one won, and the AUC of its refit on the outer test part."""
    found, scores = nested_search(frame, columns, grid, learner, k, inner, seed, parallelism)
    outer = metrics.roc_auc(scores, within=["fold"]).select("fold", F.col("roc_auc").alias("outer_auc"))
    joined = found.join(F.broadcast(outer), "fold")  # a row per fold
    return joined.withColumn("outer_auc", F.when(F.col("chosen") == 1, F.col("outer_auc")))


def impurity_importance(
    frame: DataFrame,
    columns: Sequence[str],
    make: Callable[[int], Estimator],
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Impurity importance of every feature in every fold."""
    rows = []
    for fold in range(k):
        model, _, _ = fit_fold(frame, columns, fold, make, seed=seed)
        weights = model.featureImportances.toArray()
        rows += [(fold, c, float(w)) for c, w in zip(columns, weights, strict=True)]
    return frame.sparkSession.createDataFrame(rows, "fold int, feature string, importance double")


def permuted_pairs(test: DataFrame, repeats: int = 10, seed: int = 42) -> DataFrame:
    """Every test row once per repeat (``own``) beside the row it borrows values from
    (``other``).

    A repeat pairs each row, by its place in one digest order, with the row at
    that place in another digest order; both orders are numbered in parallel.
    """
    base = test.select("hadm_id", "target", vector_to_array(FEATURES).alias("own"))
    placed = with_row_number(base.withColumn("_d", hashing.digest("hadm_id", seed=seed)), "_d", "place")
    placed = placed.drop("_d")
    order = hashing.digest("hadm_id", F.col("repeat"), seed=f"{seed}p")
    drawn = with_row_number(
        base.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumn(
            "_d", order
        ),
        "_d",
        "place",
        within=["repeat"],
    ).select("repeat", "place", F.col("own").alias("other"))
    return drawn.join(placed, "place")


def permuted_rows(test: DataFrame, n_features: int, repeats: int = 10, seed: int = 42) -> DataFrame:
    """Every test row once per (repeat, feature) with that feature's value taken
    from another row."""
    paired = permuted_pairs(test, repeats, seed)
    spread = paired.withColumn("feature", F.explode(F.sequence(F.lit(0), F.lit(n_features - 1))))
    swapped = F.transform(
        "own", lambda x, i: F.when(i == F.col("feature"), F.get("other", i)).otherwise(x)
    )
    return spread.select("repeat", "feature", "target", array_to_vector(swapped).alias(FEATURES))


def permutation_importance(
    frame: DataFrame,
    columns: Sequence[str],
    make: Callable[[int], Estimator],
    k: int = 5,
    repeats: int = 10,
    seed: int = 42,
) -> DataFrame:
    """Mean loss of ROC-AUC when a feature is shuffled among the test rows, per
    fold and feature, over ``repeats`` shuffles.

    A forest's shuffled rows are scored in the tasks that hold the pairs of rows, only
    for the features it splits on; all others have importance 0.  Other learners get
    every row once per feature and repeat."""
    names = F.array(*[F.lit(c) for c in columns])
    parts = []
    for fold in range(k):
        model, _, test = fit_fold(frame, columns, fold, make, seed=seed)
        whole = metrics.roc_auc(_scored(model, test, "target")).scalar()
        unused = None
        if isinstance(model, RandomForestClassificationModel):
            forest = forests.read_forest(model)
            pairs = cut_lineage(permuted_pairs(test, repeats, seed))
            shuffled = forests.score_permuted(pairs, forest, ["repeat", "target"])
            unused = sorted(set(range(len(columns))) - set(forest.used().tolist()))
        else:
            shuffled = _scored(
                model, permuted_rows(test, len(columns), repeats, seed), "repeat", "feature", "target"
            )
        aucs = metrics.roc_auc(shuffled, within=["repeat", "feature"])
        parts.append(
            aucs.groupBy("feature")
            .agg(F.avg("roc_auc").alias("auc"))
            .select(
                F.lit(fold).alias("fold"),
                F.get(names, F.col("feature")).alias("feature"),
                (whole - F.col("auc")).alias("importance"),
            )
        )
        if unused:
            nothing = [(fold, columns[i], 0.0) for i in unused]
            parts.append(frame.sparkSession.createDataFrame(nothing, "fold int, feature string, importance double"))
    return reduce(DataFrame.unionByName, parts)


def top_features(importance: DataFrame, n: int = 10) -> DataFrame:
    """Features by mean importance over the folds."""
    return (
        importance.groupBy("feature")
        .agg(F.avg("importance").alias("mean_importance"))
        .orderBy(F.desc("mean_importance"), "feature")
        .limit(n)
    )
