"""Value / mask / time-gap grids over binned or raw measurement times.

Both return one row per (admission, step, item): ``x`` is 0 where nothing was
measured, ``m`` marks measured cells, ``delta`` is the time in hours since the
item was last observed (since the first step if never).  Steps run forward in
time within one admission.  The labs have one row per admission, item and chart
time, see ``dedupe_labs``; two rows for one cell fail the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lacuna.functions import codes
from lacuna.operators.series import with_bins

STAY = ["subject_id", "hadm_id"]


def _cells(rows: DataFrame, *step: str, value: str = "valuenum") -> DataFrame:
    """One row per step with its item-to-value map (one entry per item)."""
    entries = F.collect_list(F.struct("itemid", value))
    return rows.groupBy(*STAY, *step).agg(F.map_from_entries(entries).alias("cells"))


def _over_items(steps: DataFrame, items: Sequence[int]) -> DataFrame:
    ids = F.array(*[F.lit(i) for i in items])
    grid = steps.withColumn("itemid", F.explode(ids))
    measured = F.map_contains_key("cells", F.col("itemid"))
    return (
        grid.withColumn("m", measured.cast("int"))
        .withColumn("x", F.when(measured, F.element_at("cells", F.col("itemid"))).otherwise(0.0))
        .drop("cells")
    )


def _pair() -> Column:
    return codes.pair_id(F.col("subject_id"), F.col("hadm_id")).alias("stay")


def xmd_binned(labs: DataFrame, items: Sequence[int], width: int = 12) -> DataFrame:
    """Steps are the admission's time bins; ``t`` is the bin start in hours
    before discharge, ``x`` the last value written in the bin."""
    latest = (
        with_bins(labs, width)
        .groupBy(*STAY, "bin", "itemid")
        .agg(F.max_by("valuenum", "charttime").alias("x"))
        .repartition("hadm_id")
    )
    forward = W.partitionBy("hadm_id").orderBy(F.desc("bin"))
    steps = (
        _cells(latest, "bin", value="x")
        .withColumn("step", F.row_number().over(forward) - 1)
        .withColumn("first_bin", F.max("bin").over(W.partitionBy("hadm_id")))
    )
    grid = _over_items(steps, items)
    earlier = (
        W.partitionBy("hadm_id", "itemid").orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    )
    seen = F.last(F.when(F.col("m") == 1, F.col("bin")), ignorenulls=True).over(earlier)
    gap = (F.coalesce(seen, F.col("first_bin")) - F.col("bin")).cast("double") * width
    t = F.col("bin").cast("double") * width
    return grid.withColumn("delta", gap).select(
        *STAY, _pair(), "step", t.alias("t"), "itemid", "x", "m", "delta"
    )


def xmd_irregular(labs: DataFrame, items: Sequence[int], segment_hours: float = 1.0) -> DataFrame:
    """Steps are the distinct chart times; ``t`` is hours relative to discharge.

    An admission may have any number of chart times, so its steps are cut into
    time segments: windows run inside a segment, and the step count, the first
    time and each item's last observation before the segment are carried in from
    a table with one row per segment.  Everything happens on the sparse steps, an
    array slot per item; they are exploded into cells last, where nothing is
    shuffled any more.
    """
    timed = with_bins(labs).withColumn("t", -F.col("hours"))
    # the filter holds for every row; stated here, both uses of the steps have the
    # same plan and share one shuffle
    steps = (
        _cells(timed, "charttime", "t")
        .withColumn("segment", F.floor(F.col("t") / segment_hours))
        .filter(F.col("segment").isNotNull() & F.col("hadm_id").isNotNull())
    )

    def observed(item: int) -> Column:
        return F.when(F.map_contains_key("cells", F.lit(item)), F.col("t"))

    part = ["hadm_id", "segment"]
    by_segment = W.partitionBy("hadm_id").orderBy("segment")
    earlier_segments = by_segment.rowsBetween(W.unboundedPreceding, -1)
    latest = [f"_last{k}" for k in range(len(items))]
    summary = steps.groupBy(*part).agg(
        F.count_if(F.size("cells") > 0).alias("n"),
        F.min("t").alias("segment_start"),
        *[F.max(observed(item)).alias(c) for c, item in zip(latest, items)],
    )
    segments = summary.select(
        *part,
        F.coalesce(F.sum("n").over(earlier_segments), F.lit(0)).alias("steps_before"),
        F.min("segment_start").over(W.partitionBy("hadm_id")).alias("first_t"),
        F.array(*[F.last(c, ignorenulls=True).over(earlier_segments) for c in latest]).alias("carry"),
    )

    inside = W.partitionBy(*part).orderBy("t")
    earlier = inside.rowsBetween(W.unboundedPreceding, -1)
    placed = steps.join(segments, part).select(
        "*",
        (F.row_number().over(inside) - 1 + F.col("steps_before")).alias("step"),
        F.array(*[F.last(observed(item), ignorenulls=True).over(earlier) for item in items]).alias("seen"),
    )
    cells = []
    for k, item in enumerate(items):
        measured = F.map_contains_key("cells", F.lit(item))
        since = F.coalesce(F.get("seen", F.lit(k)), F.get("carry", F.lit(k)), F.col("first_t"))
        cells.append(
            F.struct(
                F.lit(item).alias("itemid"),
                F.when(measured, F.element_at("cells", F.lit(item))).otherwise(0.0).alias("x"),
                measured.cast("int").alias("m"),
                (F.col("t") - since).alias("delta"),
            )
        )
    return placed.select(*STAY, _pair(), "step", "charttime", "t", F.inline(F.array(*cells)))


def sequences(grid: DataFrame, time: str = "t") -> DataFrame:
    """Per admission and item the step-ordered arrays x, m, delta and t, the form
    sequence models read.  Meant for binned grids, whose length is bounded."""
    cell = F.struct("step", F.col(time).alias("t"), "x", "m", "delta")
    packed = grid.groupBy(*STAY, "itemid").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return packed.select(
        *STAY, "itemid", *[F.col(f"cells.{c}").alias(c) for c in ("t", "x", "m", "delta")]
    )
