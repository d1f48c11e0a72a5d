"""Cohort building, extraction of the look-back window and reconciliation.

The lab table is always the left side of inner, semi and anti joins: that is the
side the adaptive skew-join rule may split, so one admission holding a large
share of the rows does not end in one task.  No side is broadcast by hand, and
where Spark would go by the size of a packed or unexploded file, the joins ask for
a merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions import timing

KEYS = ["subject_id", "hadm_id"]
LAB_COLUMNS = [*KEYS, "itemid", "charttime", "valuenum"]


def build_cohort(cohort: DataFrame, admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Cohort with demographics; the patient is the admission's, not the list's.

    All three tables have a row per admission or patient, and Spark takes them for as
    small as their packed files: the joins are asked to sort and merge, so that none is
    sent through the driver and held by every executor.
    """
    stays = admissions.select("hadm_id", F.col("subject_id").alias("patient_id"), "race")
    people = patients.select(F.col("subject_id").alias("patient_id"), "gender", "anchor_age")
    return (
        cohort.join(stays.hint("merge"), "hadm_id")
        .join(people.hint("merge"), "patient_id")
        .select(*KEYS, "admittime", "dischtime", "target", "gender", "anchor_age", "race")
        .distinct()
    )


def cohort_sql(cohort_view: str, admissions_view: str, patients_view: str) -> str:
    """``build_cohort`` as SQL text for ``spark.sql`` over registered views."""
    shown = ", ".join([*KEYS, "admittime", "dischtime", "target", "gender", "anchor_age", "race"])
    stays = f"(SELECT hadm_id, subject_id AS patient_id, race FROM {admissions_view})"
    people = f"(SELECT subject_id AS patient_id, gender, anchor_age FROM {patients_view})"
    return f"SELECT DISTINCT {shown} FROM {cohort_view} JOIN {stays} USING (hadm_id) JOIN {people} USING (patient_id)"


def labs_of_cohort(labs: DataFrame, cohort: DataFrame) -> DataFrame:
    """Lab rows whose (subject, admission) pair is in the cohort, merged as in ``build_cohort``."""
    return labs.join(cohort.select(*KEYS).hint("merge"), KEYS, "left_semi")


def _by_day(people: DataFrame, days: int, timeless: bool) -> DataFrame:
    """A row per person and calendar day of the window, in ``_day``, and one with a null day
    if ``timeless``."""
    first, last = F.to_date(timing.days_earlier(F.col("dischtime"), days)), F.to_date("dischtime")
    span = F.coalesce(F.sequence(first, last), F.array().cast("array<date>"))
    if timeless:
        span = F.concat(span, F.array(F.lit(None).cast("date")))
    return people.withColumn("_day", F.explode(span))


def _in_window(people: DataFrame, labs: DataFrame, days: int, day: str | None, timeless: bool = False) -> DataFrame:
    """Labs charted in the window of their admission, with ``timeless`` also those without a
    chart time; joined on the keys and the day.

    With the day in the key, the rows of one admission are dealt out over its days, also
    where no skew is detected.  Spark takes the exploded days for no larger than the cohort's
    file and would broadcast them through the driver, so the join is asked to sort and merge.
    ``day`` names a column of ``labs`` that holds the chart
    time's date, best one the table is partitioned by: then the days no window of the cohort
    touches are not read.
    """
    date = F.to_date("charttime")
    if day is not None:
        first = people.agg(F.to_date(timing.days_earlier(F.min("dischtime"), days))).scalar()
        touched = F.col(day).between(first, people.agg(F.to_date(F.max("dischtime"))).scalar())
        labs = labs.where(touched | F.col(day).isNull() if timeless else touched)
        date = F.col(day)
    dated = labs.select(*LAB_COLUMNS, date.alias("_lab_day"))
    spans = _by_day(people, days, timeless).withColumnsRenamed({k: f"_{k}" for k in KEYS}).hint("merge")
    same = [F.col(k) == F.col(f"_{k}") for k in KEYS]
    same.append(F.col("_lab_day").eqNullSafe(F.col("_day")) if timeless else F.col("_lab_day") == F.col("_day"))
    inside = timing.look_back(F.col("dischtime"), F.col("charttime"), days)
    if timeless:
        inside = F.col("charttime").isNull() | inside
    return dated.join(spans, same).filter(inside).drop("_day", "_lab_day", *[f"_{k}" for k in KEYS])


def labs_in_window(cohort: DataFrame, labs: DataFrame, days: int = 7, day: str | None = None) -> DataFrame:
    """Labs of the cohort charted in the ``days`` before discharge (inclusive); ``day`` may
    name the column of their date that the lab table is partitioned by."""
    return _in_window(cohort.select(*KEYS, "dischtime", "target"), labs, days, day)


def extract_labs(
    cohort: DataFrame,
    labs: DataFrame,
    days: int = 7,
    carry: Sequence[str] = ("dischtime", "target", "gender", "anchor_age", "race"),
    preserve_all: bool = False,
    distinct: bool = True,
    day: str | None = None,
) -> DataFrame:
    """Labs in the window plus labs without a chart time, one null row for every
    cohort admission that has no lab at all.

    An admission whose labs all lie outside the window disappears unless
    ``preserve_all`` is set.  An outer join would pin each admission's labs to
    one task; the inner join plus the admissions without a match gives the same
    rows and leaves the lab side splittable.  ``day`` as in ``labs_in_window``.
    """
    people = cohort.select(*KEYS, *carry)
    kept = _in_window(people, labs, days, day, timeless=True)
    matched = kept if preserve_all else labs
    unmatched = people.join(matched.select(*KEYS).distinct(), KEYS, "left_anti")
    rows = kept.select(*KEYS, *carry, "itemid", "charttime", "valuenum").unionByName(
        unmatched, allowMissingColumns=True
    )
    return rows.distinct() if distinct else rows


def dedupe_labs(
    labs: DataFrame, carry: Sequence[str] = ("dischtime", "target"), count: str | None = None
) -> DataFrame:
    """One row per (subject, admission, item, chart time): the smallest value,
    null only when all are null.

    A minimum is combined map-side, unlike a row number over the group.  The
    ``carry`` columns depend on the admission alone.  ``count`` names a column
    that gets the number of rows merged.
    """
    extra = [F.max(c).alias(c) for c in carry]
    if count:
        extra.append(F.count(F.lit(1)).alias(count))
    return labs.groupBy(*KEYS, "itemid", "charttime").agg(
        F.min("valuenum").alias("valuenum"), *extra
    )


def admissions_without_labs(extract: DataFrame) -> DataFrame:
    """Admissions kept in the extract only by their null row."""
    return extract.filter(F.col("itemid").isNull()).select(*KEYS).distinct()


def lost_to_window(cohort: DataFrame, extract: DataFrame) -> DataFrame:
    """Cohort admissions that the window filter removed altogether."""
    return cohort.select(*KEYS).distinct().join(extract.select(*KEYS).distinct(), KEYS, "left_anti")


def missing_pairs(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Distinct id pairs of ``expected`` that ``found`` lacks; null ids are kept
    and flagged as invalid."""
    return (
        expected.select(*KEYS)
        .subtract(found.select(*KEYS))
        .withColumn(
            "valid",
            (F.col("subject_id").isNotNull() & F.col("hadm_id").isNotNull()).cast("int"),
        )
    )


def first_missing_pairs(expected: DataFrame, found: DataFrame, n: int = 10) -> DataFrame:
    """The report's first ``n`` missing pairs in key order."""
    return missing_pairs(expected, found).filter("valid = 1").select(*KEYS).orderBy(*KEYS).limit(n)


def extraction_summary(cohort: DataFrame, extract: DataFrame) -> DataFrame:
    """One row of counts: admissions, with and without labs, missing, subjects, rows."""
    per_admission = extract.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("itemid").isNotNull()).alias("has_lab")
    )
    found = per_admission.agg(
        F.count(F.lit(1)).alias("unique_admissions"),
        F.count_if(F.col("has_lab")).alias("with_labs"),
        F.count_if(~F.col("has_lab")).alias("without_labs"),
        F.count_distinct("subject_id").alias("subjects"),
        F.sum("n").alias("extract_rows"),
    )
    size = cohort.agg(F.count(F.lit(1))).scalar()
    return found.withColumn("cohort_size", size).withColumn(
        "missing", F.col("cohort_size") - F.col("unique_admissions")
    )


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Concatenate extracts by column name."""
    first, *rest = batches
    for batch in rest:
        first = first.unionByName(batch)
    return first


def parse_times(df: DataFrame, columns: Sequence[str] = ("charttime", "dischtime")) -> DataFrame:
    """Parse text times; text that is no time fails the job (``coerce_cohort`` gives
    null instead)."""
    return df.withColumns({c: F.to_timestamp_ntz(F.col(c)) for c in columns})


def subject_list(cohort: DataFrame) -> DataFrame:
    """Distinct subjects in order."""
    return cohort.select("subject_id").distinct().orderBy("subject_id")


def coerce_cohort(raw: DataFrame) -> DataFrame:
    """Parse a cohort read as text; what does not parse becomes null."""
    times = [F.col(c).try_cast("timestamp_ntz").alias(c) for c in ("admittime", "dischtime")]
    numbers = [F.col(c).try_cast("double").alias(c) for c in ("anchor_age", "target") if c in raw.columns]
    return raw.select(
        *[F.col(c).try_cast("double").cast("bigint").alias(c) for c in KEYS], *times, *numbers
    )
