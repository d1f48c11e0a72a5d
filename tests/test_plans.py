"""Plan properties that matter at scale, read off executed plans."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from lacuna.operators import cohort as co
from lacuna.operators import items, lookup, ranking, sampling, series
from lacuna.plans import queries as registered
from lacuna.plans.testbed import ClinicalTables
from lacuna.session import tune
from lacuna.sources import tables

# settings under which a few hundred kilobytes count as a skewed partition
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50k",
}


@pytest.fixture()
def skewed(spark, tmp_path):
    """300,000 labs, a third of them in admission 1, and the settings above."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    labs = spark.range(300_000, numPartitions=6).selectExpr(
        "(CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END) div 2 AS subject_id",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 500 END AS hadm_id",
        "int(id % 7) AS itemid",
        "TIMESTAMP_NTZ '2024-01-09 00:00:00' - make_dt_interval(0, 0, 0, id % 500000) AS charttime",
        "double(id % 100) AS valuenum",
    )
    cohort = spark.range(500).selectExpr(
        "id div 2 AS subject_id",
        "id AS hadm_id",
        "TIMESTAMP_NTZ '2024-01-10 00:00:00' AS dischtime",
        "int(id % 2) AS target",
    )
    tables.write_parquet(labs, str(tmp_path / "labs"))
    tables.write_parquet(cohort, str(tmp_path / "cohort"))
    yield (
        tables.read_parquet(spark, str(tmp_path / "labs")),
        tables.read_parquet(spark, str(tmp_path / "cohort")),
    )
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_hot_admission_is_split_in_the_join(spark, skewed):
    tune(spark)
    labs, cohort = skewed
    found = co.dedupe_labs(co.labs_in_window(cohort, labs))
    plan = final_plan(found)
    assert "SortMergeJoin(skew=true)" in plan
    # the aggregate has a shuffle of its own, with map-side combine below it
    assert plan.count("Exchange hashpartitioning") == 3
    assert found.count() == labs.dropDuplicates(["hadm_id", "itemid", "charttime"]).join(
        cohort, ["subject_id", "hadm_id"]
    ).filter("charttime BETWEEN dischtime - INTERVAL 7 DAYS AND dischtime").count()


def test_category_tables_do_not_move_the_rows(spark, skewed):
    labs, _ = skewed
    plan = final_plan(items.zscore(labs))
    assert "Join" not in plan
    assert "Join" not in final_plan(items.keep_items(labs, items.item_stats(labs)))
    people = labs.selectExpr("hadm_id", "int(hadm_id % 2) AS target")
    assert "Join" not in final_plan(sampling.class_weights(people, mode="balanced"))


def test_matrix_needs_one_shuffle_after_binning_and_reuses_the_bins(spark):
    bed = ClinicalTables(spark, SMALL)
    means = series.bin_mean(bed.window_labs)
    filled = series.fill(series.densify(means))
    plan = final_plan(filled.groupBy("hadm_id").pivot("itemid", [1, 2]).max("filled"))
    assert "ReusedExchange" in plan
    assert plan.count("REPARTITION_BY_COL") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_columns_and_filters_reach_the_scan(spark, skewed):
    labs, cohort = skewed
    plan = co.labs_in_window(cohort, labs)
    text = plan.select("hadm_id", "itemid")._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(charttime)" in text and "valuenum" not in text


def test_bucketed_tables_join_and_aggregate_without_an_exchange(spark, skewed, tmp_path):
    labs, cohort = skewed
    stored = tables.store_by_admission(labs, "lacuna_test_labs", str(tmp_path / "b1"))
    people = tables.store_by_admission(cohort.where("hadm_id % 3 = 0"), "lacuna_test_cohort", str(tmp_path / "b2"))
    joined = co.labs_of_cohort(stored, people)
    counts = joined.groupBy(*co.KEYS).count()
    plan = final_plan(counts)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = co.labs_of_cohort(labs, cohort.where("hadm_id % 3 = 0")).groupBy(*co.KEYS).count()
    assert sorted(counts.collect()) == sorted(plain.collect()) and counts.count() > 10
    for table in ("lacuna_test_labs", "lacuna_test_cohort"):
        spark.sql(f"DROP TABLE {table}")


def test_days_in_the_join_key_spread_one_admission(spark, skewed):
    labs, cohort = skewed
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = co.labs_in_window(cohort, labs).where("hadm_id = 1")
        assert found.select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    inside = labs.join(cohort, co.KEYS).where("charttime between dischtime - interval 7 days and dischtime")
    assert co.labs_in_window(cohort, labs).count() == inside.count() > 100_000


def test_days_outside_all_windows_are_not_read(spark, skewed, tmp_path):
    labs, cohort = skewed
    dated = labs.withColumn("day", F.to_date("charttime"))
    tables.write_parquet(dated, str(tmp_path / "by_day"), partition_by=["day"])
    by_day = tables.read_parquet(spark, str(tmp_path / "by_day"))
    early = cohort.withColumn("dischtime", F.expr("TIMESTAMP_NTZ '2024-01-05 12:00:00'"))
    for found, plain in (
        (co.labs_in_window(early, by_day, day="day"), co.labs_in_window(early, labs)),
        (co.extract_labs(early, by_day, carry=("dischtime",), day="day"), co.extract_labs(early, labs, carry=("dischtime",))),
    ):
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    pruned = co.labs_in_window(early, by_day, day="day")
    formatted = spark.sparkContext._jvm.PythonSQLUtils.explainString(pruned._jdf.queryExecution(), "formatted")
    filters = [line for line in formatted.splitlines() if line.startswith("PartitionFilters")]
    assert any("day" in line and "ubquery" in line for line in filters), formatted


def test_order_statistics_neither_sort_nor_range_partition(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("rows are ranged")

    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", refuse)
    draw = random.Random(8)
    groups = {
        "wide": [draw.uniform(-1, 1) * 10 ** draw.randint(-300, 300) for _ in range(501)],
        "ties": [draw.choice([0.0, -0.0, 1.5, 1.5, -2.0]) for _ in range(400)],
        "far": [float(k) for k in range(1000)] + [1e308, -1e308, float("inf"), float("-inf")],
        "one": [7.25],
        "close": [1.0 + k * 2.0**-52 for k in range(300)],
        None: [3.0, 1.0],
    }
    rows = [(g, v) for g, some in groups.items() for v in some] + [("one", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: r.median for r in ranking.median(df, "v", ["g"]).collect()}
    assert found == {g: float(np.median(some)) for g, some in groups.items()}
    third = {r.g: r.v for r in ranking.order_statistic(df, "v", lambda n: F.lit(3), ["g"]).collect()}
    assert third == {g: sorted(some)[2] if len(some) > 2 else None for g, some in groups.items()}
    big = spark.range(1 << 60, (1 << 60) + 5001).withColumnRenamed("id", "v")
    assert ranking.order_statistic(big, "v", lambda n: F.ceil(n / 2)).first().v == (1 << 60) + 2500
    assert ranking.median(df.where("g = 'empty'"), "v").first()["median"] is None


def test_lookups_broadcast_by_counted_size_and_salt_beyond(spark, skewed, monkeypatch):
    labs, _ = skewed
    few = spark.range(5).select(F.col("id").cast("int").alias("itemid"), (F.col("id") * 2).alias("twice"))
    assert "Join" not in final_plan(lookup.attach(labs, few, "itemid"))
    some = spark.range(500).select(F.col("id").cast("int").alias("itemid"), (F.col("id") * 2).alias("twice"))
    plan = final_plan(lookup.attach(labs, some, "itemid"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    many = spark.range(100_000).select(F.col("id").cast("int").alias("itemid"), (F.col("id") * 2).alias("twice"))
    both = lookup.attach(labs, many, "itemid").where("itemid < 5")
    assert "_salt" in final_plan(both) and "BroadcastHashJoin" not in final_plan(both)
    assert both.columns == [*labs.columns, "twice"]
    expected = lookup.attach(labs, few, "itemid").where("itemid < 5")
    assert both.exceptAll(expected).isEmpty() and expected.exceptAll(both).isEmpty()
    kept = {lookup.matching(labs, few, "itemid", most=most).count() for most in (10, 1)}
    assert kept == {lookup.matching(labs, some.where("itemid < 5"), "itemid").count()} == {labs.where("itemid < 5").count()}
    monkeypatch.setattr(items, "MOST_LABELS", 3)
    with pytest.raises(ValueError, match="more than 3 labels"):
        items.encode_labels(labs, "itemid", "code")


def test_admissions_and_their_days_are_never_broadcast(spark):
    """However small the packed customer file: the plans before any run."""
    bed = ClinicalTables(spark, SMALL)
    frames = {
        "window": bed.window_labs.select("hadm_id", "itemid", "valuenum"),
        "extract": co.extract_labs(bed.cohort, bed.labevents, carry=("dischtime",), preserve_all=True),
        "semi": co.labs_of_cohort(bed.labevents, bed.cohort),
        "labels": registered.REGISTRY["label_select"](spark, SMALL),
        "cohort": registered.REGISTRY["cohort_build"](spark, SMALL),
    }
    for name, frame in frames.items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "LeftAnti" not in line]
        assert not joins and "SortMergeJoin" in plan, name
