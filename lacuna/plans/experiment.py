"""One experiment from a lab extract to fold metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.config import ExperimentConfig
from lacuna.operators import cohort as co
from lacuna.operators import items as it
from lacuna.operators import matrix, metrics, models, series, xmd
from lacuna.operators.quality import require_unique
from lacuna.session import tune
from lacuna.sources import tables

LABEL_SOURCES = ("target", "gender", "anchor_age", "insurance")


def item_ids(selected: DataFrame) -> list[int]:
    """The chosen items as a list: they become matrix columns, so the driver needs
    their ids (a part of the item dictionary)."""
    return [r.itemid for r in selected.select("itemid").distinct().orderBy("itemid").collect()]


def labels_of(extract: DataFrame, config: ExperimentConfig) -> DataFrame:
    """hadm_id, subject_id and the chosen binary label as ``target``; admissions
    without a label are left out."""
    if config.label not in LABEL_SOURCES:
        raise ValueError(f"a binary label is needed to train; choose one of {LABEL_SOURCES}")
    label = it.label_column(config.label, config.age_threshold, config.insurance_type)
    labels = extract.select("hadm_id", "subject_id", label.alias("target"))
    return require_unique(labels, "hadm_id").filter("target IS NOT NULL")


def feature_vectors(extract: DataFrame, config: ExperimentConfig, items: Sequence[int]) -> DataFrame:
    """The configured feature set per admission as one array, in the order of
    ``feature_names``."""
    labs = co.dedupe_labs(
        extract.na.drop(subset=["charttime", "dischtime"]), carry=["dischtime"]
    )
    parts = []
    if "V" in config.feature_set:
        dense = series.densify(series.bin_mean(labs, config.bin_hours))
        parts.append(matrix.vector_features(series.fill(dense), items, config.last_bin))
    if config.feature_set != "V":
        grid = xmd.xmd_binned(labs, items, config.bin_hours).withColumn(
            "bin", (F.col("t") / config.bin_hours).cast("int")
        )
        for value in [c for c in ("m", "delta") if c[0].upper() in config.feature_set]:
            cells = grid.select("hadm_id", "itemid", "bin", F.col(value).cast("double").alias(value))
            part = matrix.vector_features(cells, items, config.last_bin, value)
            if value == "m":
                # a bin without any measurement is a row of zeros
                zeros = F.transform("values", lambda x: F.coalesce(x, F.lit(0.0)))
                part = part.select("hadm_id", zeros.alias("values"))
            parts.append(part)
    first, *rest = parts
    for part in rest:
        joined = first.join(part.withColumnRenamed("values", "more"), "hadm_id")
        first = joined.select("hadm_id", F.concat("values", "more").alias("values"))
    return first


def feature_names(config: ExperimentConfig, items: Sequence[int]) -> list[str]:
    columns = matrix.feature_columns(items, config.last_bin)
    return [f"{letter.lower()}_{c}" for letter in config.feature_set for c in columns]


def make_learner(config: ExperimentConfig, n_features: int):
    """Estimator factory (number of training rows -> estimator)."""
    return {
        "random_forest": lambda n: models.random_forest(**models.FOREST, seed=config.seed),
        "logistic_regression": lambda n: models.logistic_regression(n, **models.LOGISTIC),
        "gbt": lambda n: models.boosted_trees(seed=config.seed),
        "mlp": lambda n: models.perceptron(n_features, seed=config.seed),
    }[config.model]


def run_experiment(
    extract: DataFrame,
    config: ExperimentConfig = ExperimentConfig(),
    items: Sequence[int] | None = None,
    output: str | None = None,
) -> DataFrame:
    """Cross-validated metrics per fold of one configuration.

    ``items`` defaults to every item of the extract; see ``select_items`` for the
    usual thresholds.  With ``output`` the fold metrics are also written as CSV.
    """
    tune(extract.sparkSession)
    if items is None:
        items = item_ids(extract.filter("itemid IS NOT NULL"))
    names = feature_names(config, items)
    frame = models.training_frame(
        feature_vectors(extract, config, items), labels_of(extract, config), config.folds, config.seed
    )
    learner = make_learner(config, len(names))
    scores = models.cross_validate(frame, names, learner, config.folds, seed=config.seed)
    found = models.fold_metrics(scores).select("fold", *dict.fromkeys(("recall", "f1", "roc_auc", *config.metrics)))
    if output:
        tables.write_fold_metrics(found, output)
    return found


def summarise(folds: DataFrame, config: ExperimentConfig = ExperimentConfig()) -> DataFrame:
    return metrics.fold_summary(folds, config.metrics)
