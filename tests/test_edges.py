"""Nulls, NaN, outliers and huge groups, which the fixture tables do not hold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lacuna import session
from lacuna.operators import items, metrics, ranking, sampling
from lacuna.sources import tables


def test_one_outlier_leaves_the_ranges_even(spark):
    df = spark.range(20_000).select((F.col("id") / 7).alias("v")).union(spark.createDataFrame([(1e12,)], "v double"))
    sizes = [r[0] for r in ranking._ranged(df, ["v"]).groupBy("_cell").count().select("count").collect()]
    assert max(sizes) <= 3 * sum(sizes) / len(sizes)
    assert ranking.median(df, "v").first()["median"] == pytest.approx(10_000 / 7)


def test_folds_count_a_huge_group_in_full_and_keep_rows_without_group(spark):
    rows = [(1, 0, k) for k in range(400)] + [(s, s % 2, 0) for s in range(2, 202)] + [(None, 1, 7), (None, 0, 8)]
    df = spark.createDataFrame(rows, "subject_id long, target int, n int")
    folded = sampling.group_folds(df, k=4)
    assert folded.count() == len(rows)
    assert folded.filter("fold is null").count() == 0
    per_subject = folded.filter("subject_id is not null").groupBy("subject_id").agg(F.count_distinct("fold").alias("c"))
    assert per_subject.filter("c > 1").count() == 0
    positives = [r.p for r in sampling.fold_balance(folded.filter("subject_id > 1")).select(F.col("positives").alias("p")).collect()]
    assert max(positives) - min(positives) <= 1


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_a_missing_score_is_an_error(spark, missing):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, missing)], "target int, score double")
    for metric in (metrics.confusion, metrics.roc_auc, metrics.pr_auc, metrics.calibration):
        with pytest.raises(Exception, match="null or NaN score"):
            metric(df).collect()


def test_nan_does_not_spoil_an_item(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (1, float("nan"))], "itemid int, valuenum double")
    z = sorted((r.z for r in items.zscore(df).collect()), key=lambda x: (x is None, x))
    assert z[0] == pytest.approx(-z[1]) and z[2] is None


def test_csv_with_a_malformed_number_is_an_error_and_nan_is_null(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("a,b\n1,2.5\nabc,3.5\n")
    (tmp_path / "nan.csv").write_text("a,b\n1,NaN\n")
    with pytest.raises(Exception, match="(?i)malformed|fail"):
        tables.read_csv(spark, str(tmp_path / "bad.csv"), "a int, b double").collect()
    assert tables.read_csv(spark, str(tmp_path / "nan.csv"), "a int, b double").first().b is None


def test_two_extracts_of_a_size_are_an_error(spark, tmp_path):
    for name in ("x_7_days_prior.parquet", "y_7_days_prior.parquet"):
        spark.range(1).write.parquet(str(tmp_path / name))
    with pytest.raises(ValueError, match="several extracts"):
        tables.read_window_file(spark, str(tmp_path), 7)


def test_stored_frames_go_below_the_warehouse_where_no_folder_is_set():
    class Bare:
        """A session without a checkpoint folder."""

        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.sql.warehouse.dir": "file:/w"}.get(key, default)

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    assert session.shared_folder(Bare) == "file:/w/_shared"


def test_missing_scores_and_labels_are_errors(spark):
    for row, problem in (((1, None), "null or NaN score"), ((1, float("nan")), "null or NaN score"), ((None, 0.5), "null label")):
        df = spark.createDataFrame([(1, 0.9), (0, 0.2), row], "target int, score double")
        for result in (
            lambda d: metrics.conformal_sets(d, F.col("score") > 2),
            lambda d: metrics.conformal_sets(d, F.lit(True)),
            metrics.confusion, metrics.roc_auc, metrics.pr_auc, metrics.calibration,
        ):
            with pytest.raises(Exception, match=problem):
                result(df).collect()
