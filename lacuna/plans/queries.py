"""Registered queries: each operator on the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions import codes, hashing, timing
from lacuna.operators import (
    cohort as co,
    impute,
    insight,
    items,
    matrix,
    metrics,
    models,
    quality,
    ranking,
    sampling,
    series,
    xmd,
)
from lacuna.config import ExperimentConfig
from lacuna.plans.experiment import run_experiment
from lacuna.plans.testbed import ITEMS, ClinicalTables
from lacuna.session import cut_lineage, new_path
from lacuna.sources import schemas, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

WIDTH = 12
LAST_BIN = 14
# settings of the registered model queries; the library defaults are larger
FOLDS = 5
TREES = {"n_estimators": 20, "max_depth": 5, "min_samples_split": 5}


def query(build: Callable[[ClinicalTables], DataFrame]) -> Callable[[ClinicalTables], DataFrame]:
    """Register under the function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(ClinicalTables(spark, folder))

    REGISTRY[build.__name__] = run
    return build


def r6(column: Column | str) -> Column:
    """Rounded to 6 digits, without negative zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6) + F.lit(0.0)


def micros(hours: str) -> Column:
    """Hours as whole microseconds: exact, so nothing sits on a rounding edge."""
    return F.round(F.col(hours) * 3.6e9).cast("bigint")


# ---- cohort and extraction -------------------------------------------------


@query
def cohort_build(t: ClinicalTables) -> DataFrame:
    views = (
        tables.register(t.cohort, "lacuna_cohort"),
        tables.register(t.admissions, "lacuna_admissions"),
        tables.register(t.patients, "lacuna_patients"),
    )
    return tables.read_query(t.spark, co.cohort_sql(*views))


@query
def extract_labs(t: ClinicalTables) -> DataFrame:
    return co.extract_labs(t.demographics, t.labevents)


@query
def extract_labs_keep_all(t: ClinicalTables) -> DataFrame:
    return co.extract_labs(t.demographics, t.labevents, preserve_all=True)


@query
def interval_join(t: ClinicalTables) -> DataFrame:
    return co.labs_in_window(t.cohort, t.labevents).distinct()


@query
def semi_join_cohort(t: ClinicalTables) -> DataFrame:
    return co.labs_of_cohort(t.labevents, t.cohort)


@query
def dedupe_labs(t: ClinicalTables) -> DataFrame:
    return co.dedupe_labs(co.labs_of_cohort(t.labevents, t.cohort), carry=(), count="n_merged")


@query
def duplicate_rows(t: ClinicalTables) -> DataFrame:
    keys = t.labevents.select("subject_id", "hadm_id", "itemid", "charttime")
    return quality.duplicate_rows(keys).withColumnRenamed("count", "n_rows")


@query
def admissions_without_labs(t: ClinicalTables) -> DataFrame:
    return co.admissions_without_labs(co.extract_labs(t.demographics, t.labevents))


@query
def filtered_out_admissions(t: ClinicalTables) -> DataFrame:
    extract = co.extract_labs(t.demographics, t.labevents, distinct=False)
    return co.lost_to_window(t.cohort, extract)


@query
def summary_counts(t: ClinicalTables) -> DataFrame:
    return co.extraction_summary(t.cohort, co.extract_labs(t.demographics, t.labevents))


@query
def reconcile_missing(t: ClinicalTables) -> DataFrame:
    return co.missing_pairs(t.extracted_list, co.extract_labs(t.demographics, t.labevents, distinct=False))


@query
def first_missing_pairs(t: ClinicalTables) -> DataFrame:
    extract = co.extract_labs(t.demographics, t.labevents, distinct=False)
    return co.first_missing_pairs(t.extracted_list, extract)


@query
def subject_list(t: ClinicalTables) -> DataFrame:
    return co.subject_list(t.cohort)


@query
def coerce_types(t: ClinicalTables) -> DataFrame:
    stay = F.col("hadm_id")
    raw = t.demographics.select(
        F.concat(F.col("subject_id").cast("string"), F.lit(".0")).alias("subject_id"),
        F.concat(stay.cast("string"), F.lit(".0")).alias("hadm_id"),
        F.when(stay % 7 == 0, "not a time").otherwise(F.col("admittime").cast("string")).alias("admittime"),
        F.when(stay % 11 == 0, "").otherwise(F.col("dischtime").cast("string")).alias("dischtime"),
        F.when(stay % 5 == 0, "n/a").otherwise(F.col("anchor_age").cast("string")).alias("anchor_age"),
        F.col("target").cast("string").alias("target"),
    )
    return co.coerce_cohort(raw)


@query
def union_batches(t: ClinicalTables) -> DataFrame:
    extract = co.extract_labs(t.demographics, t.labevents)
    path = new_path(t.spark, "batches")
    tables.write_parquet(
        extract.withColumn("batch", F.pmod("subject_id", F.lit(4))), path, partition_by=["batch"]
    )
    batches = [tables.read_parquet(t.spark, f"{path}/batch={i}") for i in range(4)]
    return co.union_batches(batches)


# ---- sources ---------------------------------------------------------------


@query
def csv_roundtrip(t: ClinicalTables) -> DataFrame:
    documents = t.table("documents").select("doc_id", "text")
    plain = new_path(t.spark, "text-csv")
    tables.write_csv(documents, plain)
    text = tables.read_csv(t.spark, plain, documents.schema, multiline=True)
    labs = t.labevents.select("labevent_id", "hadm_id", "itemid", "charttime", "valuenum")
    packed = new_path(t.spark, "labs-csv-gz")
    tables.write_csv(labs, packed, gzip=True)
    back = tables.read_csv(t.spark, packed, labs.schema, partitions=8)
    return text.select(
        F.lit("text").alias("kind"),
        F.col("doc_id").cast("string").alias("row_key"),
        F.md5("text").alias("digest"),
        F.lit(None).cast("timestamp_ntz").alias("charttime"),
        F.lit(None).cast("double").alias("valuenum"),
    ).unionByName(
        back.select(
            F.lit("labs").alias("kind"),
            F.col("labevent_id").cast("string").alias("row_key"),
            F.md5(F.concat_ws("|", "hadm_id", "itemid")).alias("digest"),
            "charttime",
            "valuenum",
        )
    )


@query
def csv_rejects(t: ClinicalTables) -> DataFrame:
    """Labs as text, some fields of which are no numbers, some rows a field too long."""
    labs = t.labevents.select("labevent_id", "hadm_id", "itemid", "valuenum")
    number = F.col("labevent_id")
    texts = labs.select(
        F.concat_ws(
            ",",
            number.cast("string"),
            F.when(number % 97 == 0, "none").otherwise(F.col("hadm_id").cast("string")),
            F.col("itemid").cast("string"),
            F.when(number % 89 == 0, "n/a").otherwise(F.coalesce(F.round("valuenum", 3).cast("string"), F.lit(""))),
            F.when(number % 83 == 0, "more"),
        ).alias("value")
    )
    path = new_path(t.spark, "labs-text")
    texts.write.text(path)
    schema = "labevent_id bigint, hadm_id bigint, itemid int, valuenum double"
    good, bad = tables.read_csv_with_rejects(t.spark, path, T._parse_datatype_string(schema), header=False)
    kept = good.select(F.lit("row").alias("kind"), "labevent_id", "hadm_id", "valuenum", F.lit("").alias("reason"))
    return kept.unionByName(
        bad.select(
            F.lit("reject").alias("kind"),
            F.substring_index("record", ",", 1).cast("bigint").alias("labevent_id"),
            F.lit(None).cast("bigint").alias("hadm_id"),
            F.lit(None).cast("double").alias("valuenum"),
            "reason",
        )
    )


@query
def bucketed_labs(t: ClinicalTables) -> DataFrame:
    """Semi-join and counts over labs and cohort stored by admission: neither is exchanged."""
    labs, cohort = (
        tables.store_by_admission(frame, f"lacuna_{name}_{uuid.uuid4().hex}", new_path(t.spark, name))
        for name, frame in (("labs", t.labevents), ("cohort", t.cohort))
    )
    return co.labs_of_cohort(labs, cohort).groupBy(*co.KEYS).agg(
        F.count(F.lit(1)).alias("n_labs"), F.count("valuenum").alias("n_values"), F.max("charttime").alias("last_time")
    )


@query
def parquet_roundtrip(t: ClinicalTables) -> DataFrame:
    means = series.bin_mean(t.window_labs, WIDTH)
    path = new_path(t.spark, "means")
    tables.write_parquet(means, path)
    return tables.read_parquet(t.spark, path).select("hadm_id", "itemid", "bin", r6("mean").alias("mean"))


# ---- time and names --------------------------------------------------------


@query
def window_filter(t: ClinicalTables) -> DataFrame:
    labs = t.labevents.join(t.cohort.select(*co.KEYS, "dischtime"), co.KEYS)
    timed = series.with_bins(labs).filter(F.col("hours") <= 168)
    return timed.select("labevent_id", "hadm_id", "itemid", micros("hours").alias("micros_before"))


@query
def time_bins(t: ClinicalTables) -> DataFrame:
    labs = co.labs_in_window(t.cohort, t.labevents)
    hours = timing.hours_before(F.col("dischtime"), F.col("charttime"))
    return labs.select(
        *co.KEYS,
        "itemid",
        "charttime",
        timing.time_bin(hours, WIDTH).alias("bin"),
        timing.bin_start(hours, 6).alias("bin_start"),
        timing.capped_bin(hours).alias("capped_bin"),
    )


@query
def time_units(t: ClinicalTables) -> DataFrame:
    """On all cohort labs, so times after discharge (negative) are included."""
    labs = t.labevents.join(t.cohort.select(*co.KEYS, "dischtime"), co.KEYS).na.drop(subset=["charttime"])
    span = (F.col("charttime"), F.col("dischtime"))
    return labs.select(
        "labevent_id",
        timing.whole_units(*span, 60).alias("minute"),
        timing.whole_units(*span, 3600).alias("hour"),
        timing.days_truncated(*span).alias("day"),
        timing.whole_units(*span, 86400).alias("day_floor"),
    ).withColumn("hour_bin", F.floor(F.col("hour") / 12).cast("int"))


@query
def feature_names(t: ClinicalTables) -> DataFrame:
    item, index = F.col("itemid"), F.col("bin")
    return (
        series.with_bins(t.window_labs, WIDTH)
        .groupBy("itemid", "bin")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(
            codes.item_text(item).alias("item"),
            codes.feature_name(item, index).alias("name"),
            codes.feature_name_verbose(item, index).alias("verbose_name"),
            "n_rows",
        )
    )


# ---- series ----------------------------------------------------------------


def _dense(t: ClinicalTables, width: int = WIDTH) -> DataFrame:
    return series.densify(series.bin_mean(t.window_labs, width))


@query
def bin_mean(t: ClinicalTables) -> DataFrame:
    return series.bin_mean(t.window_labs, WIDTH).withColumn("mean", r6("mean"))


@query
def window_sweep(t: ClinicalTables) -> DataFrame:
    return series.sweep_bin_mean(t.window_labs).withColumn("mean", r6("mean"))


def _filled(t: ClinicalTables, method: str, **options: str) -> DataFrame:
    filled = series.fill(_dense(t), method, **options)
    return filled.select("hadm_id", "itemid", "pos", "bin", r6("filled").alias("filled"))


@query
def interpolate_inside(t: ClinicalTables) -> DataFrame:
    return _filled(t, "interpolate")


@query
def interpolate_time_axis(t: ClinicalTables) -> DataFrame:
    return _filled(t, "interpolate", axis="time")


@query
def ffill(t: ClinicalTables) -> DataFrame:
    return _filled(t, "ffill")


@query
def ffill_chronological(t: ClinicalTables) -> DataFrame:
    return _filled(t, "ffill", direction="chronological")


@query
def bfill(t: ClinicalTables) -> DataFrame:
    return _filled(t, "bfill")


@query
def fill_chain(t: ClinicalTables) -> DataFrame:
    return _filled(t, "chain")


@query
def zero_fill(t: ClinicalTables) -> DataFrame:
    return _filled(t, "zero")


@query
def ffill_median(t: ClinicalTables) -> DataFrame:
    split = sampling.holdout(cut_lineage(t.cohort.select("hadm_id")), seed=0)
    train = split.filter("is_test = 0")
    medians = ranking.median(
        t.window_labs.join(train, "hadm_id", "left_semi"), "valuenum", ["itemid"]
    )
    filled = series.fill_with_default(_dense(t), medians, "median")
    return filled.select("hadm_id", "itemid", "bin", r6("filled").alias("filled"))


# ---- value / mask / gap ----------------------------------------------------


@query
def xmd_binned(t: ClinicalTables) -> DataFrame:
    grid = xmd.xmd_binned(t.window_labs, ITEMS, WIDTH)
    return grid.withColumn("x", r6("x")).withColumn("delta", r6("delta"))


@query
def xmd_irregular(t: ClinicalTables) -> DataFrame:
    grid = xmd.xmd_irregular(t.window_labs, ITEMS)
    return grid.select(
        "stay",
        "step",
        "charttime",
        "itemid",
        micros("t").alias("t_micros"),
        r6("x").alias("x"),
        "m",
        micros("delta").alias("delta_micros"),
    )


def _vmd_cells(t: ClinicalTables, width: int) -> DataFrame:
    filled = series.fill(_dense(t, width)).select("hadm_id", "itemid", "bin", F.col("filled").alias("v"))
    grid = xmd.xmd_binned(t.window_labs, ITEMS, width).select(
        "hadm_id", "itemid", (F.col("t") / width).cast("int").alias("bin"), "m", F.col("delta").alias("d")
    )
    return grid.join(filled, ["hadm_id", "itemid", "bin"], "left")


def _feature_set(t: ClinicalTables, kind: str) -> DataFrame:
    wide = matrix.feature_set(_vmd_cells(t, WIDTH), kind, ITEMS, LAST_BIN)
    return wide.select("hadm_id", *[(F.col(c) if c[0] == "m" else r6(c)).alias(c) for c in wide.columns[1:]])


@query
def feature_sets(t: ClinicalTables) -> DataFrame:
    return _feature_set(t, "VMD")


@query
def feature_set_md(t: ClinicalTables) -> DataFrame:
    return _feature_set(t, "MD")


# ---- items -----------------------------------------------------------------


@query
def item_stats(t: ClinicalTables) -> DataFrame:
    stats = items.item_stats(t.window_labs)
    return stats.withColumn("freq_ts", r6("freq_ts")).withColumn("num_ts", r6("num_ts"))


@query
def select_items(t: ClinicalTables) -> DataFrame:
    chosen = items.select_items(items.item_stats(t.window_labs), npoints=2, minfreq=0.75)
    return items.keep_items(t.window_labs, chosen).select("hadm_id", "itemid", "charttime", "valuenum")


@query
def top_items(t: ClinicalTables) -> DataFrame:
    return items.top_items(items.item_stats(t.window_labs), n=3).select("itemid", "count")


@query
def item_index(t: ClinicalTables) -> DataFrame:
    return items.item_index(t.labevents)


@query
def zscore_normalise(t: ClinicalTables) -> DataFrame:
    sample = items.zscore(t.window_labs).withColumnRenamed("z", "z_sample")
    both = items.zscore(sample, population=True)
    keys = ["hadm_id", "itemid", "charttime"]
    return both.select(*keys, r6("z_sample").alias("z_sample"), r6("z").alias("z_population"))


# ---- labels and matrices ---------------------------------------------------


@query
def label_select(t: ClinicalTables) -> DataFrame:
    people = t.demographics.join(t.admissions.select("hadm_id", "insurance"), "hadm_id")
    kinds = ("target", "gender", "anchor_age", "race", "insurance")
    return people.select("hadm_id", *[items.label_column(k).alias(f"{k}_label") for k in kinds])


@query
def race_encode(t: ClinicalTables) -> DataFrame:
    grouped = t.admissions.select("hadm_id", "race", codes.race_group(F.col("race")).alias("race_group"))
    return items.encode_labels(grouped, "race_group", "race_code")


@query
def label_align(t: ClinicalTables) -> DataFrame:
    index = series.bin_mean(t.window_labs, WIDTH).select("hadm_id").distinct()
    return matrix.join_label(index, t.demographics.select("hadm_id", "subject_id", "target"))


@query
def pivot_wide(t: ClinicalTables) -> DataFrame:
    wide = matrix.pivot_features(series.fill(_dense(t)), ITEMS, LAST_BIN)
    return wide.select("hadm_id", *[r6(f"`{c}`").alias(c) for c in wide.columns[1:]])


def flagship(t: ClinicalTables) -> DataFrame:
    """Feature matrix with its label."""
    return matrix.join_label(pivot_wide(t), t.cohort.select("hadm_id", "subject_id", "target"))


@query
def pivot_last_n(t: ClinicalTables) -> DataFrame:
    rows = matrix.last_n_features(co.labs_in_window(t.cohort, t.labevents))
    wide = matrix.pivot_numeric(rows, matrix.last_n_columns(ITEMS))
    return wide.select("hadm_id", *[r6(c).alias(c) for c in wide.columns[1:]])


@query
def pivot_measured(t: ClinicalTables) -> DataFrame:
    rows = matrix.last_n_features(co.labs_in_window(t.cohort, t.labevents))
    wide = matrix.pivot_measured(rows, matrix.last_n_columns(ITEMS))
    return matrix.join_label(wide, t.cohort.select("hadm_id", "target"))


# ---- imputation, splits, resampling ----------------------------------------


@query
def knn_impute(t: ClinicalTables) -> DataFrame:
    means = series.bin_mean(t.window_labs, WIDTH)
    vectors = cut_lineage(matrix.vector_features(means, ITEMS, LAST_BIN, value="mean"))
    split = cut_lineage(sampling.holdout(vectors, seed=0))
    filled = impute.knn_impute(split, split.filter("is_test = 0"))
    names = matrix.feature_columns(ITEMS, LAST_BIN)
    return matrix.named_cells(filled, names).withColumn("value", r6("value"))


@query
def imputation_score(t: ClinicalTables) -> DataFrame:
    dense = cut_lineage(_dense(t))
    parts = [impute.imputation_score(dense, 0.2, mode=m) for m in ("overlay", "augmentation")]
    both = reduce(DataFrame.unionByName, parts)
    return both.withColumn("mae", r6("mae")).withColumn("rmse", r6("rmse"))


@query
def holdout_split(t: ClinicalTables) -> DataFrame:
    return sampling.holdout(cut_lineage(_labels(t)), seed=0)


def _labels(t: ClinicalTables) -> DataFrame:
    return t.cohort.select("hadm_id", "subject_id", "target")


@query
def group_kfold(t: ClinicalTables) -> DataFrame:
    return sampling.group_folds(_labels(t)).select("hadm_id", "subject_id", "target", "fold")


@query
def fold_balance(t: ClinicalTables) -> DataFrame:
    balance = sampling.fold_balance(sampling.group_folds(_labels(t)))
    return balance.withColumn("positive_rate", r6("positive_rate"))


@query
def oversample_minority(t: ClinicalTables) -> DataFrame:
    return sampling.oversample(cut_lineage(_labels(t)))


@query
def undersample_majority(t: ClinicalTables) -> DataFrame:
    return sampling.undersample(cut_lineage(_labels(t)))


@query
def class_weights(t: ClinicalTables) -> DataFrame:
    weighted = sampling.class_weights(_labels(t), mode=None, name="w_none")
    weighted = sampling.class_weights(weighted, mode="balanced", name="w_balanced")
    weighted = sampling.class_weights(weighted, mode={0: 0.5, 1: 2}, name="w_given")
    return weighted.select("hadm_id", "target", "w_none", r6("w_balanced").alias("w_balanced"), "w_given")


# ---- metrics on a formula score --------------------------------------------


def _scored(t: ClinicalTables) -> DataFrame:
    rows = co.labs_in_window(t.cohort, t.labevents).groupBy("hadm_id").agg(F.count(F.lit(1)).alias("n"))
    score = F.round(F.least(F.coalesce("n", F.lit(0)) / 20, F.lit(1.0)), 3)
    return _labels(t).join(rows, "hadm_id", "left").select("hadm_id", "target", score.alias("score"))


@query
def confusion_metrics(t: ClinicalTables) -> DataFrame:
    found = metrics.confusion(_scored(t))
    ratios = ("recall", "precision", "f1", "balanced_accuracy", "accuracy")
    return found.select("tp", "fp", "fn", "tn", *[r6(c).alias(c) for c in ratios])


@query
def roc_auc(t: ClinicalTables) -> DataFrame:
    return metrics.roc_auc(_scored(t)).select(r6("roc_auc").alias("roc_auc"))


@query
def pr_auc(t: ClinicalTables) -> DataFrame:
    return metrics.pr_auc(_scored(t)).select(r6("pr_auc").alias("pr_auc"))


@query
def pr_curve(t: ClinicalTables) -> DataFrame:
    points = metrics.pr_points(_scored(t))
    return points.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query
def calibration_table(t: ClinicalTables) -> DataFrame:
    table = metrics.calibration(_scored(t))
    return table.select("score_bin", "n", *[r6(c).alias(c) for c in ("mean_score", "observed_rate", "brier")])


@query
def conformal_sets(t: ClinicalTables) -> DataFrame:
    half = hashing.unit_interval(hashing.digest("hadm_id", seed="calibrate")) < 0.5
    return metrics.conformal_sets(_scored(t), half)


# ---- data quality ----------------------------------------------------------


@query
def dq_primary_key(t: ClinicalTables) -> DataFrame:
    checks = [
        (t.table("orders"), ["o_orderkey"], "orders"),
        (t.table("lineitem"), ["l_orderkey"], "lineitem"),
        (t.labevents, ["labevent_id"], "labevents"),
        (t.labevents, ["subject_id", "hadm_id", "itemid", "charttime"], "labevents_natural"),
        (t.admissions, ["hadm_id"], "admissions"),
        (t.patients, ["subject_id"], "patients"),
        (t.patients, ["gender"], "patients_gender"),
    ]
    return reduce(DataFrame.unionByName, [quality.primary_key_check(*c) for c in checks])


@query
def dq_foreign_key(t: ClinicalTables) -> DataFrame:
    checks = [
        (t.table("orders"), "o_custkey", t.table("customer"), "c_custkey", "orders_customer"),
        (t.table("lineitem"), "l_orderkey", t.table("orders"), "o_orderkey", "lineitem_orders"),
        (t.labevents, "subject_id", t.patients, "subject_id", "labevents_patients"),
        (t.labevents, "hadm_id", t.cohort, "hadm_id", "labevents_cohort"),
    ]
    return reduce(DataFrame.unionByName, [quality.foreign_key_check(*c) for c in checks])


@query
def dq_not_null(t: ClinicalTables) -> DataFrame:
    lineitem = t.table("lineitem")
    parts = [
        quality.not_null_check(lineitem, lineitem.columns, "lineitem"),
        quality.not_null_check(t.labevents, t.labevents.columns, "labevents"),
        quality.not_null_check(t.patients, t.patients.columns, "patients"),
    ]
    return reduce(DataFrame.unionByName, parts)


STAR_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
}
STAR_REFERENCES = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("labevents", "hadm_id", "admissions", "hadm_id"),
]
STAR_REQUIRED = {"labevents": ["charttime", "valuenum"], "orders": ["o_custkey"], "patients": ["gender"]}


@query
def dq_declared(t: ClinicalTables) -> DataFrame:
    """Every declared key and reference among the tables at hand, the clinical and the star's."""
    frames = {name: t.table(name) for name in STAR_KEYS}
    frames |= {"labevents": t.labevents, "patients": t.patients, "admissions": t.admissions}
    references = schemas.foreign_keys() + STAR_REFERENCES
    return quality.declared_checks(frames, schemas.PRIMARY_KEYS | STAR_KEYS, references, STAR_REQUIRED)


@query
def dq_invalid_ids(t: ClinicalTables) -> DataFrame:
    return quality.invalid_id_report(t.extracted_list)


# ---- what missingness says -------------------------------------------------


@query
def missingness_features(t: ClinicalTables) -> DataFrame:
    found = insight.missingness_features(t.window_labs, ITEMS, WIDTH, LAST_BIN + 1)
    return found.select(
        "hadm_id",
        "itemid",
        "ever_measured",
        r6("frequency").alias("frequency"),
        r6("mask_sd").alias("mask_sd"),
        micros("first_hours").alias("first_micros"),
        micros("last_hours").alias("last_micros"),
    )


@query
def missingness_by_group(t: ClinicalTables) -> DataFrame:
    people = t.demographics.select(
        "hadm_id",
        "gender",
        codes.race_group(F.col("race")).alias("race"),
        codes.at_least(F.col("anchor_age"), 65).cast("string").alias("age_65"),
    )
    found = insight.missingness_by_group(people, t.window_labs, ("gender", "race", "age_65"), ITEMS)
    return found.withColumn("missing_rate", r6("missing_rate"))


@query
def item_cooccurrence(t: ClinicalTables) -> DataFrame:
    return insight.cooccurrence(t.window_labs, ITEMS, WIDTH).withColumn("lift", r6("lift"))


@query
def missingness_target_assoc(t: ClinicalTables) -> DataFrame:
    found = insight.target_association(t.cohort, t.window_labs, ITEMS)
    return found.select(
        "itemid",
        "missing_pos",
        "missing_neg",
        "seen_pos",
        "seen_neg",
        *[r6(c).alias(c) for c in ("lift", "odds_ratio", "chi_square")],
    )


# ---- models (rows-only checks: results depend on the learner) ---------------

COLUMNS = matrix.feature_columns(ITEMS, LAST_BIN)


def _frame(t: ClinicalTables) -> DataFrame:
    vectors = matrix.vector_features(series.fill(_dense(t)), ITEMS, LAST_BIN)
    return models.training_frame(vectors, _labels(t), k=FOLDS)


def _forest(_: int) -> models.Estimator:
    return models.random_forest(**TREES)


@query
def rf_cv(t: ClinicalTables) -> DataFrame:
    scores = models.cross_validate(_frame(t), COLUMNS, _forest, k=FOLDS)
    return models.fold_metrics(scores)


@query
def cv_summary(t: ClinicalTables) -> DataFrame:
    scores = models.cross_validate(
        _frame(t), COLUMNS, _forest, k=FOLDS, weights={0: 1, 1: 2}, masks=True
    )
    return metrics.fold_summary(models.fold_metrics(scores), ("recall", "f1", "roc_auc"))


@query
def experiment_gender(t: ClinicalTables) -> DataFrame:
    """Whole pipeline with another label and the missingness features alone."""
    config = ExperimentConfig(label="gender", feature_set="MD", bin_hours=24, model="gbt", folds=2)
    return run_experiment(co.extract_labs(t.demographics, t.labevents), config, ITEMS)


@query
def rf_grid(t: ClinicalTables) -> DataFrame:
    grid = {"n_estimators": (10,), "max_depth": (2, 5), "class_weight": (None, {0: 0.5, 1: 2})}
    return models.grid_search(_frame(t), COLUMNS, grid, k=FOLDS, inner=2)


@query
def rf_importance(t: ClinicalTables) -> DataFrame:
    return models.impurity_importance(_frame(t), COLUMNS, _forest, k=FOLDS)


@query
def permutation_importance(t: ClinicalTables) -> DataFrame:
    return models.permutation_importance(_frame(t), COLUMNS, _forest, k=FOLDS, repeats=10)


@query
def logreg_cv(t: ClinicalTables) -> DataFrame:
    scores = models.cross_validate(_frame(t), COLUMNS, models.logistic_regression, k=FOLDS)
    return models.fold_metrics(scores)


@query
def gbt_cv(t: ClinicalTables) -> DataFrame:
    scores = models.cross_validate(
        _frame(t), COLUMNS, lambda _: models.boosted_trees(5, 3), k=FOLDS
    )
    return models.fold_metrics(scores)


@query
def mlp_cv(t: ClinicalTables) -> DataFrame:
    scores = models.cross_validate(
        _frame(t), COLUMNS, lambda _: models.perceptron(len(COLUMNS), max_iter=30), k=FOLDS
    )
    return models.fold_metrics(scores)
