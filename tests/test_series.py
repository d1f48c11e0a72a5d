"""Series operators against pandas and plain loops, and their invariants."""

from __future__ import annotations

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lacuna.operators import cohort as co
from lacuna.operators import items, series, xmd

DISCHARGE = dt.datetime(2024, 1, 10)
LABS = (
    "subject_id bigint, hadm_id bigint, itemid int, charttime timestamp_ntz, valuenum double, "
    "dischtime timestamp_ntz, target int"
)


def random_labs(spark, seed=1, admissions=6, rows=160, hours=168, hot=None):
    """Labs with gaps, nulls, bin edges and, with ``hot``, one crowded admission."""
    rng = random.Random(seed)
    seen, out = set(), []
    for n in range(rows):
        stay = hot if hot is not None and n % 3 == 0 else rng.randrange(admissions)
        item = rng.randrange(1, 4)
        back = rng.choice([rng.uniform(0, hours), float(rng.randrange(0, hours // 12)) * 12])
        at = DISCHARGE - dt.timedelta(seconds=round(back * 3600))
        if (stay, item, at) in seen:
            continue
        seen.add((stay, item, at))
        value = None if rng.random() < 0.2 else round(rng.uniform(0, 100), 2)
        out.append((stay // 2, stay, item, at, value, DISCHARGE, stay % 2))
    return spark.createDataFrame(out, LABS)


def pandas_means(labs, width=12):
    pdf = labs.toPandas()
    hours = (pdf.dischtime - pdf.charttime).dt.total_seconds() / 3600
    pdf["bin"] = (hours // width).astype(int)
    return pdf.groupby(["hadm_id", "itemid", "bin"])["valuenum"].mean().unstack(level=-1)


def assert_same(got, wide, column):
    expected = {
        (stay, item, b): v for (stay, item), row in wide.iterrows() for b, v in row.items()
    }
    rows = got.collect()
    assert len(rows) == len(expected)
    for r in rows:
        v = expected[(r.hadm_id, r.itemid, r.bin)]
        assert (r[column] is None) == math.isnan(v)
        if r[column] is not None:
            assert r[column] == pytest.approx(v, abs=1e-9)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fills_match_pandas(spark, seed):
    labs = random_labs(spark, seed, rows=90)
    dense = series.densify(series.bin_mean(labs)).cache()
    wide = pandas_means(labs)
    inside = wide.interpolate(method="linear", axis=1, limit_area="inside")
    assert_same(dense, wide, "mean")
    assert_same(series.fill(dense, "interpolate"), inside, "filled")
    assert_same(series.fill(dense, "ffill"), wide.ffill(axis=1), "filled")
    assert_same(series.fill(dense, "bfill"), wide.bfill(axis=1), "filled")
    assert_same(series.fill(dense), inside.ffill(axis=1).bfill(axis=1), "filled")
    assert_same(series.fill(dense, "zero"), wide.fillna(0), "filled")


def test_fill_is_idempotent_and_keeps_empty_series_empty(spark):
    dense = series.densify(series.bin_mean(random_labs(spark, 5, rows=60))).cache()
    once = series.fill(dense)
    again = series.fill(once.withColumn("mean", F.col("filled")).drop("filled"))
    assert once.select("hadm_id", "itemid", "bin", "filled").exceptAll(
        again.select("hadm_id", "itemid", "bin", "filled")
    ).isEmpty()
    per = once.groupBy("hadm_id", "itemid").agg(
        F.count("mean").alias("known"), F.count("filled").alias("filled"), F.count(F.lit(1)).alias("n")
    )
    assert per.filter("filled <> CASE WHEN known = 0 THEN 0 ELSE n END").isEmpty()


def test_fill_rejects_unknown_options(spark):
    dense = series.densify(series.bin_mean(random_labs(spark)))
    for options in ({"method": "spline"}, {"axis": "x"}, {"direction": "x"}):
        with pytest.raises(ValueError):
            series.fill(dense, **options)


def loop_delta(times, masks):
    """Time since the last observation by the step-by-step recurrence."""
    delta = [0.0]
    for i in range(1, len(times)):
        gap = times[i] - times[i - 1]
        delta.append(gap if masks[i - 1] else gap + delta[-1])
    return delta


@pytest.mark.parametrize("segment", [1.0, 24.0])
def test_irregular_grid_matches_recurrence(spark, segment):
    labs = random_labs(spark, 7, rows=300, hot=2)
    grid = xmd.xmd_irregular(labs, [1, 2, 3], segment).toPandas()
    raw = {(r.hadm_id, r.charttime, r.itemid): r.valuenum for r in labs.collect()}
    assert len(grid) == 3 * len({(k[0], k[1]) for k in raw})
    for (stay, item), part in grid.groupby(["hadm_id", "itemid"]):
        part = part.sort_values("step")
        assert list(part.step) == list(range(len(part)))
        assert part.t.is_monotonic_increasing
        masks = [(stay, at.to_pydatetime(), item) in raw for at in part.charttime]
        assert list(part.m) == [int(x) for x in masks]
        assert list(part.delta) == pytest.approx(loop_delta(list(part.t), masks), abs=1e-9)
        assert (part.delta >= 0).all()
        assert (part.x[part.m == 0] == 0).all()


def test_binned_grid_matches_recurrence(spark):
    labs = random_labs(spark, 8, rows=200)
    grid = xmd.xmd_binned(labs, [1, 2, 3], 12).toPandas()
    pdf = labs.toPandas()
    pdf["bin"] = ((pdf.dischtime - pdf.charttime).dt.total_seconds() / 3600 // 12).astype(int)
    last = pdf.sort_values("charttime").groupby(["hadm_id", "bin", "itemid"]).tail(1)
    values = {(r.hadm_id, r.bin, r.itemid): r.valuenum for r in last.itertuples()}
    for (stay, item), part in grid.groupby(["hadm_id", "itemid"]):
        part = part.sort_values("step")
        keys = [(stay, int(t // 12), item) for t in part.t]
        masks = [k in values for k in keys]
        assert list(part.m) == [int(x) for x in masks]
        assert list(part.delta) == pytest.approx(loop_delta([-t for t in part.t], masks))
        for key, x in zip(keys, part.x):
            expected = values.get(key, 0.0)
            assert (pd.isna(x) and pd.isna(expected)) or x == expected


def test_sequences_are_step_ordered(spark):
    grid = xmd.xmd_binned(random_labs(spark, 8), [1, 2, 3], 12)
    packed = xmd.sequences(grid)
    assert packed.filter("size(t) <> size(x) OR t <> array_sort(t, (a, b) -> int(b - a))").isEmpty()
    assert packed.selectExpr("sum(size(m))").first()[0] == grid.count()


def test_results_do_not_depend_on_partitioning(spark):
    """One admission holds a third of the rows; 1 and 8 shuffle partitions agree."""

    def run():
        labs = random_labs(spark, 9, rows=400, hot=1)
        means = series.fill(series.densify(series.bin_mean(labs))).collect()
        grid = xmd.xmd_irregular(labs, [1, 2, 3]).collect()
        stats = items.item_stats(labs).collect()
        return [sorted(map(str, rows)) for rows in (means, grid, stats)]

    many = run()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert many == one


def test_dedupe_keeps_smallest_value_nulls_last(spark):
    at = DISCHARGE - dt.timedelta(hours=1)
    rows = [
        (1, 1, 1, at, 5.0, DISCHARGE, 0),
        (1, 1, 1, at, None, DISCHARGE, 0),
        (1, 1, 1, at, 3.0, DISCHARGE, 0),
        (1, 1, 2, None, None, DISCHARGE, 0),
        (1, 1, 2, None, None, DISCHARGE, 0),
    ]
    found = co.dedupe_labs(spark.createDataFrame(rows, LABS), count="n").collect()
    assert {(r.itemid, r.valuenum, r.n) for r in found} == {(1, 3.0, 3), (2, None, 2)}


def test_window_ends_are_inclusive_and_preserve_all_keeps_everyone(spark):
    day = dt.timedelta(days=1)
    cohort = spark.createDataFrame(
        [(1, 10, DISCHARGE), (2, 20, DISCHARGE), (3, 30, DISCHARGE)],
        "subject_id bigint, hadm_id bigint, dischtime timestamp_ntz",
    )
    labs = spark.createDataFrame(
        [
            (1, 10, 1, DISCHARGE, 1.0),
            (1, 10, 1, DISCHARGE - 7 * day, 2.0),
            (1, 10, 1, DISCHARGE - 7 * day - dt.timedelta(microseconds=1), 3.0),
            (1, 10, 1, None, 4.0),
            (2, 20, 1, DISCHARGE + day, 5.0),
        ],
        "subject_id bigint, hadm_id bigint, itemid int, charttime timestamp_ntz, valuenum double",
    )
    kept = co.extract_labs(cohort, labs, carry=["dischtime"])
    assert sorted(r.valuenum for r in kept.filter("itemid = 1").collect()) == [1.0, 2.0, 4.0]
    assert {r.hadm_id for r in kept.collect()} == {10, 30}
    everyone = co.extract_labs(cohort, labs, carry=["dischtime"], preserve_all=True)
    assert {r.hadm_id for r in everyone.collect()} == {10, 20, 30}
    assert [r.hadm_id for r in co.lost_to_window(cohort, kept).collect()] == [20]
    assert [r.hadm_id for r in co.admissions_without_labs(kept).collect()] == [30]


def test_strict_time_parsing_fails_on_bad_text(spark):
    good = spark.createDataFrame([("2024-01-01 10:00:00",)], "charttime string")
    assert co.parse_times(good, ["charttime"]).first()[0] == dt.datetime(2024, 1, 1, 10)
    bad = spark.createDataFrame([("soon",)], "charttime string")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        co.parse_times(bad, ["charttime"]).collect()
