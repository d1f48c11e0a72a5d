"""What the pattern of missing measurements says: features, groups, associations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.operators.series import SERIES, with_bins


def missingness_features(
    labs: DataFrame, items: Sequence[int], width: int = 12, n_bins: int = 15
) -> DataFrame:
    """Per admission and item: share of bins with a measurement, sample sd of that
    0/1 mask, whether it was ever measured, hours before discharge of the first
    and last measurement.

    The mask has ``n_bins`` entries with ``measured`` ones, which fixes its mean
    and sd; no grid is built.
    """
    per_bin = (
        with_bins(labs, width)
        .groupBy(*SERIES, "bin")
        .agg(F.max("hours").alias("first"), F.min("hours").alias("last"))
    )
    per_item = (
        per_bin.repartition("hadm_id")
        .groupBy(*SERIES)
        .agg(
            F.count(F.lit(1)).alias("measured"),
            F.max("first").alias("first"),
            F.min("last").alias("last"),
        )
    )
    cell = F.struct("itemid", F.struct("measured", "first", "last"))
    per_stay = per_item.groupBy("hadm_id").agg(
        F.map_from_entries(F.collect_list(cell)).alias("found")
    )
    ids = F.array(*[F.lit(i) for i in items])
    grid = per_stay.withColumn("itemid", F.explode(ids)).withColumn(
        "f", F.try_element_at("found", F.col("itemid"))
    )
    share = F.coalesce(F.col("f.measured"), F.lit(0)) / F.lit(n_bins)
    spread = F.sqrt(share * (1 - share) * n_bins / (n_bins - 1))
    return grid.select(
        *SERIES,
        share.alias("frequency"),
        spread.alias("mask_sd"),
        F.col("f").isNotNull().cast("int").alias("ever_measured"),
        F.col("f.first").alias("first_hours"),
        F.col("f.last").alias("last_hours"),
    )


def measured_pairs(labs: DataFrame) -> DataFrame:
    return labs.select(*SERIES).distinct()


def missingness_by_group(
    people: DataFrame, labs: DataFrame, groups: Sequence[str], items: Sequence[int]
) -> DataFrame:
    """Share of admissions of each group without any measurement of the item.

    ``people`` has one row per admission with the columns named in ``groups``; all of
    them are counted in one pass, as ``group_name`` and ``group_value`` (text).
    """
    named = [
        F.struct(F.lit(g).alias("group_name"), F.col(g).cast("string").alias("group_value")) for g in groups
    ]
    members = people.select("hadm_id", F.inline(F.array(*named)))
    group = ["group_name", "group_value"]
    sizes = members.groupBy(*group).agg(F.count(F.lit(1)).alias("admissions"))
    grid = sizes.withColumn("itemid", F.explode(F.array(*[F.lit(i) for i in items])))
    counts = (
        measured_pairs(labs)
        .join(members, "hadm_id")
        .groupBy(F.col("group_name").alias("_n"), F.col("group_value").alias("_v"), F.col("itemid").alias("_i"))
        .agg(F.count(F.lit(1)).alias("measured"))
    )
    same = (
        (F.col("group_name") == F.col("_n"))
        & F.col("group_value").eqNullSafe(F.col("_v"))
        & (F.col("itemid") == F.col("_i"))
    )
    n = F.coalesce("measured", F.lit(0))
    return grid.join(counts, same, "left").select(
        *group,
        "itemid",
        "admissions",
        n.alias("measured"),
        (1 - n / F.col("admissions")).alias("missing_rate"),
    )


def target_association(people: DataFrame, labs: DataFrame, items: Sequence[int]) -> DataFrame:
    """2x2 counts of item missing against outcome, with lift, odds ratio (each
    count plus one half) and chi-square; strongest first is ``orderBy`` away."""
    outcome = people.select("hadm_id", "target")
    totals = outcome.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum("target").cast("bigint").alias("pos"))
    ).scalar()
    measured = (
        measured_pairs(labs)
        .join(outcome, "hadm_id")
        .groupBy("itemid")
        .agg(F.count(F.lit(1)).alias("seen"), F.sum("target").alias("seen_pos"))
    )
    listed = people.sparkSession.createDataFrame([(i,) for i in items], "itemid int")
    grid = listed.join(measured, "itemid", "left").withColumn("t", totals)
    seen, seen_pos = (F.coalesce(c, F.lit(0)) for c in ("seen", "seen_pos"))
    counts = grid.select(
        "itemid",
        (F.col("t.pos") - seen_pos).alias("missing_pos"),
        (F.col("t.n") - F.col("t.pos") - (seen - seen_pos)).alias("missing_neg"),
        seen_pos.alias("seen_pos"),
        (seen - seen_pos).alias("seen_neg"),
    )
    a, b, c, d = (F.col(x).cast("double") for x in ("missing_pos", "missing_neg", "seen_pos", "seen_neg"))
    n = a + b + c + d
    rate = (a + c) / n
    margin = (a + b) * (c + d) * (a + c) * (b + d)
    return counts.select(
        "*",
        F.when((a + b > 0) & (rate > 0), (a / (a + b)) / rate).alias("lift"),
        ((a + 0.5) * (d + 0.5) / ((b + 0.5) * (c + 0.5))).alias("odds_ratio"),
        F.when(margin > 0, n * (a * d - b * c) * (a * d - b * c) / margin).alias("chi_square"),
    )


def cooccurrence(
    labs: DataFrame, items: Sequence[int], width: int = 12
) -> DataFrame:
    """How often two items are measured in the same bin of an admission.

    Each task multiplies its 0/1 rows (bins x items) with their transpose and
    emits one small matrix, so the item pairs of a bin are never written out;
    the matrices are added up afterwards.
    """
    places = (
        with_bins(labs, width)
        .filter(F.col("itemid").isin(list(items)))
        .groupBy("hadm_id", "bin")
        .agg(F.collect_set("itemid").alias("found"))
    )
    ordered, column = np.sort(items), np.argsort(items, kind="stable")

    def gram(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(items), len(items)))
        for batch in batches:
            lengths = batch["found"].str.len()
            found = np.concatenate(batch["found"].to_numpy())
            mask = np.zeros((len(batch), len(items)))
            mask[np.repeat(np.arange(len(batch)), lengths), column[np.searchsorted(ordered, found)]] = 1
            total += mask.T @ mask
        a, b = np.nonzero(np.triu(total))
        ids, together = np.asarray(items), total[a, b].astype("int64")
        yield pd.DataFrame({"item_a": ids[a], "item_b": ids[b], "together": together})

    partial = places.select("found").mapInPandas(gram, "item_a int, item_b int, together bigint")
    counts = partial.groupBy("item_a", "item_b").agg(F.sum("together").alias("together"))
    n_bins = places.agg(F.count_if(F.size("found") > 0)).scalar()
    single = counts.filter("item_a = item_b")
    left = single.select("item_a", F.col("together").alias("n_a"))
    right = single.select("item_b", F.col("together").alias("n_b"))
    return (
        counts.filter("item_a < item_b")
        .join(left, "item_a")
        .join(right, "item_b")
        .withColumn("lift", F.col("together") * n_bins / (F.col("n_a") * F.col("n_b")))
        .select("item_a", "item_b", "together", "n_a", "n_b", "lift")
    )
