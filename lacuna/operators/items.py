"""Statistics, selection, indexing and scaling per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lacuna.functions import codes
from lacuna.operators.lookup import attach, matching
from lacuna.session import cut_lineage

MOST_LABELS = 10_000


def item_stats(labs: DataFrame) -> DataFrame:
    """Per item: admissions having it, their share (``freq_ts``) and the mean
    number of rows per admission having it (``num_ts``)."""
    pairs = labs.groupBy("hadm_id", "itemid").agg(F.count(F.lit(1)).alias("n"))
    # reads n as well, so this subquery and the statistics share one shuffle
    admissions = pairs.agg(F.count_distinct(F.when(F.col("n") > 0, F.col("hadm_id")))).scalar()
    return (
        pairs.groupBy("itemid")
        .agg(F.count("n").alias("count"), F.sum("n").alias("rows"))
        .withColumn("freq_ts", F.col("count") / admissions)
        .withColumn("num_ts", F.col("rows") / F.col("count"))
        .drop("rows")
    )


def select_items(stats: DataFrame, npoints: float = 5, minfreq: float = 0.75) -> DataFrame:
    """Items measured often enough per admission and in enough admissions."""
    return stats.filter((F.col("num_ts") >= npoints) & (F.col("freq_ts") >= minfreq))


def keep_items(labs: DataFrame, selected: DataFrame) -> DataFrame:
    """Labs of the selected items (a part of the item dictionary)."""
    return matching(labs, selected, "itemid")


def top_items(stats: DataFrame, by: str = "count", n: int | None = None) -> DataFrame:
    ordered = stats.orderBy(F.desc(by), "itemid")
    return ordered if n is None else ordered.limit(n)


def item_index(labs: DataFrame) -> DataFrame:
    """Dense 0-based index by item id.  The window runs on the item dictionary,
    not on the measurements."""
    ids = labs.select("itemid").filter(F.col("itemid").isNotNull()).distinct()
    return ids.withColumn("item_idx", F.dense_rank().over(W.orderBy("itemid")) - 1)


def zscore(labs: DataFrame, value: str = "valuenum", population: bool = False) -> DataFrame:
    """Standardise per item on observed values; constant items and NaN give null."""
    labs = labs.withColumn(value, F.when(~F.isnan(value), F.col(value)))
    sd = F.stddev_pop(value) if population else F.stddev_samp(value)
    stats = labs.groupBy("itemid").agg(F.struct(F.avg(value).alias("mean"), sd.alias("sd")).alias("_s"))
    spread = F.when(F.col("_s.sd") != 0, F.col("_s.sd"))
    z = (F.col(value) - F.col("_s.mean")) / spread
    return attach(labs, stats, "itemid").select(*labs.columns, z.alias("z"))


def encode_labels(df: DataFrame, label: str, name: str) -> DataFrame:
    """Code of each label: its rank among the sorted labels present.  Labels are
    categories: more than ``MOST_LABELS`` different ones are an error."""
    present = cut_lineage(df.select(label).where(F.col(label).isNotNull()).distinct())
    if present.count() > MOST_LABELS:
        raise ValueError(f"column {label!r} has more than {MOST_LABELS} labels")
    codes_of = present.withColumn(name, F.row_number().over(W.orderBy(label)) - 1)
    return attach(df.drop(name), codes_of, label)


def label_column(kind: str, age_threshold: int = 30, insurance: str = "Private") -> Column:
    """The training label of one admission; ``race`` stays text for ``encode_labels``."""
    choices = {
        "target": F.col("target").cast("int"),
        "gender": codes.gender_code(F.col("gender")),
        "anchor_age": codes.at_least(F.col("anchor_age"), age_threshold),
        "race": codes.race_group(F.col("race")),
        "insurance": codes.insurance_code(F.col("insurance"), insurance),
    }
    if kind not in choices:
        raise ValueError(f"label must be one of {sorted(choices)}")
    return choices[kind]


def keep_label(df: DataFrame, kind: str) -> DataFrame:
    """Drop the label columns that are not trained on; absent ones are ignored."""
    return df.drop(*[c for c in ("gender", "anchor_age", "race", "target") if c != kind])
