"""Evaluation of scored rows: every function takes columns ``label`` (0/1) and
``score`` in a DataFrame and returns one row per group of ``within``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.operators.ranking import order_statistic, with_running_totals


def _ratio(part: Column, whole: Column) -> Column:
    """0 when the denominator is 0."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _known(score: str) -> Column:
    """The score; a missing one is an error in every metric."""
    value = F.col(score).cast("double")
    missing = F.raise_error(F.lit(f"column {score!r} holds a null or NaN score")).cast("double")
    return F.when(value.isNull() | F.isnan(value), missing).otherwise(value)


def _labelled(label: str) -> Column:
    """The label; a missing one is an error in every metric."""
    missing = F.raise_error(F.lit(f"column {label!r} holds a null label")).cast("int")
    return F.when(F.col(label).isNull(), missing).otherwise(F.col(label))


def confusion(
    df: DataFrame,
    label: str = "target",
    score: str = "score",
    threshold: float = 0.5,
    within: Sequence[str] = (),
) -> DataFrame:
    """Counts at the threshold and the ratios derived from them."""
    actual, called = _labelled(label) == 1, _known(score) >= threshold
    counts = df.groupBy(*within).agg(
        F.count_if(actual & called).alias("tp"),
        F.count_if(~actual & called).alias("fp"),
        F.count_if(actual & ~called).alias("fn"),
        F.count_if(~actual & ~called).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        "*",
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2).alias("balanced_accuracy"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    )


def _by_score(df: DataFrame, label: str, score: str, within: Sequence[str]) -> DataFrame:
    """Per distinct score: positives and negatives, their running totals and the
    group totals.  The counts are stored, so the scored rows are read once."""
    actual = _labelled(label)
    counted = df.withColumn(score, _known(score)).groupBy(*within, score).agg(
        F.count_if(actual == 1).alias("pos"), F.count_if(actual == 0).alias("neg")
    )
    return with_running_totals(counted, score, ["pos", "neg"], within)


def roc_auc(
    df: DataFrame, label: str = "target", score: str = "score", within: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve; ties count half.  Null when a class is absent."""
    points = _by_score(df, label, score, within)
    below = F.col("cum_neg") - F.col("neg")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    pairs = F.max(F.col("tot_pos") * F.col("tot_neg"))
    return points.groupBy(*within).agg(F.when(pairs > 0, won / pairs).alias("roc_auc"))


def pr_points(
    df: DataFrame, label: str = "target", score: str = "score", within: Sequence[str] = ()
) -> DataFrame:
    """Precision and recall at each distinct threshold and at the next higher one
    (recall 0, precision 1 above the highest)."""
    points = _by_score(df, label, score, within)
    tp_above, fp_above = F.col("tot_pos") - F.col("cum_pos"), F.col("tot_neg") - F.col("cum_neg")
    tp, fp = tp_above + F.col("pos"), fp_above + F.col("neg")
    above = tp_above + fp_above
    return points.select(
        *within,
        F.col(score).alias("threshold"),
        (tp / (tp + fp)).alias("precision"),
        (tp / F.col("tot_pos")).alias("recall"),
        F.when(above > 0, tp_above / above).otherwise(F.lit(1.0)).alias("next_precision"),
        (tp_above / F.col("tot_pos")).alias("next_recall"),
    )


def pr_auc(
    df: DataFrame, label: str = "target", score: str = "score", within: Sequence[str] = ()
) -> DataFrame:
    """Trapezoid area under the precision-recall curve."""
    area = (
        (F.col("recall") - F.col("next_recall"))
        * (F.col("precision") + F.col("next_precision"))
        / 2
    )
    return pr_points(df, label, score, within).groupBy(*within).agg(F.sum(area).alias("pr_auc"))


def calibration(
    df: DataFrame, label: str = "target", score: str = "score", bins: int = 10
) -> DataFrame:
    """Mean score, observed rate and Brier score per score bin of equal width."""
    df = df.withColumns({score: _known(score), label: _labelled(label)})
    index = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    error = F.col(score) - F.col(label)
    return df.groupBy(index.alias("score_bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.avg(label).alias("observed_rate"),
        F.avg(error * error).alias("brier"),
    )


def conformal_sets(
    df: DataFrame,
    calibrate: Column,
    label: str = "target",
    score: str = "score",
    alpha: float = 0.1,
) -> DataFrame:
    """Split conformal prediction: which labels stay plausible for the rows not
    used to calibrate.

    The cut is the ceil((n + 1)(1 - alpha))-th smallest value of 1 - p(true label)
    on the calibration rows; with too few of them every label is kept.
    """
    df = df.withColumns({score: _known(score), label: _labelled(label)})
    p_true = F.when(F.col(label) == 1, F.col(score)).otherwise(1 - F.col(score))
    scores = df.filter(calibrate).select((1 - p_true).alias("cut"))
    found = order_statistic(scores, "cut", lambda n: F.ceil((n + 1) * (1 - alpha)))
    cut = F.coalesce(found.scalar(), F.lit(float("inf")))
    tested = df.filter(~calibrate).withColumn("_cut", cut)
    keep1 = (1 - F.col(score)) <= F.col("_cut")
    keep0 = F.col(score) <= F.col("_cut")
    covered = F.when(F.col(label) == 1, keep1).otherwise(keep0)
    return tested.select(
        *df.columns,
        keep0.cast("int").alias("in_set_0"),
        keep1.cast("int").alias("in_set_1"),
        covered.cast("int").alias("covered"),
    )


def fold_summary(folds: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation of each metric over the folds."""
    values = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    return (
        folds.select(F.explode(values).alias("p"))
        .groupBy("p.metric")
        .agg(F.avg("p.value").alias("mean"), F.stddev_samp("p.value").alias("sd"))
    )
