"""Regular series: mean per time bin, dense grid over the observed bins, gap fills.

Long form throughout: ``(hadm_id, itemid, pos, bin, mean)``.  A series has at
most one row per bin, so the windows below work on a handful of rows each, however
many measurements an admission has; the measurements themselves only pass
through map-side combined aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lacuna.functions import timing
from lacuna.operators.lookup import map_of

SERIES = ["hadm_id", "itemid"]
METHODS = ("interpolate", "ffill", "bfill", "chain", "zero")


def with_bins(labs: DataFrame, width: int = 12) -> DataFrame:
    """Add ``hours`` before discharge and ``bin``; rows without a time or charted
    after discharge are dropped."""
    timed = labs.na.drop(subset=["charttime", "dischtime"])
    hours = timing.hours_before(F.col("dischtime"), F.col("charttime"))
    return (
        timed.withColumn("hours", hours)
        .filter(F.col("hours") >= 0)
        .withColumn("bin", timing.time_bin(F.col("hours"), width))
    )


def bin_mean(labs: DataFrame, width: int = 12) -> DataFrame:
    """Mean per (admission, item, bin); null when every value in the bin is null."""
    return with_bins(labs, width).groupBy(*SERIES, "bin").agg(F.avg("valuenum").alias("mean"))


def sweep_bin_mean(labs: DataFrame, widths: Sequence[int] = (2, 6, 12, 24)) -> DataFrame:
    """``bin_mean`` for several bin widths in one pass over the labs."""
    timed = with_bins(labs).select(*SERIES, "hours", "valuenum")
    swept = timed.withColumn("width", F.explode(F.array(*[F.lit(w) for w in widths])))
    return (
        swept.withColumn("bin", timing.time_bin(F.col("hours"), F.col("width")))
        .groupBy("width", *SERIES, "bin")
        .agg(F.avg("valuenum").alias("mean"))
    )


def observed_bins(means: DataFrame) -> Column:
    """Sorted array of the bins seen anywhere in the data, as a scalar subquery.

    The null flag is read along with the bin so that the subquery needs the same
    columns as the main query and shares its shuffle instead of scanning again.
    """
    seen = F.collect_set(F.struct("bin", F.col("mean").isNull().alias("empty")))
    bins = F.array_sort(F.array_distinct(F.transform(seen, lambda s: s["bin"])))
    return means.agg(bins.alias("bins")).scalar()


def densify(means: DataFrame) -> DataFrame:
    """One row per series and observed bin; ``pos`` is the bin's rank.

    Rows are placed by admission once; fills per series and the pivot per
    admission that follow need no further shuffle.
    """
    placed = means.repartition("hadm_id").groupBy(*SERIES)
    cells = placed.agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "mean"))).alias("cells")
    )
    grid = cells.withColumn("bins", observed_bins(means))
    return grid.select(*SERIES, "cells", F.posexplode("bins").alias("pos", "bin")).select(
        *SERIES, "pos", "bin", F.element_at("cells", F.col("bin")).alias("mean")
    )


def fill(
    dense: DataFrame,
    method: str = "chain",
    axis: str = "position",
    direction: str = "bins",
    name: str = "filled",
) -> DataFrame:
    """Fill gaps of a dense series.

    ``method``: ``interpolate`` (linear, only between observed points),
    ``ffill``, ``bfill``, ``chain`` (the three in that order) or ``zero``.
    ``axis``: spacing of the interpolation, by bin rank (``position``) or by bin
    value (``time``).  ``direction``: ``bins`` runs forward along the bin number,
    that is from discharge back into the stay; ``chronological`` runs with time.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    if axis not in ("position", "time"):
        raise ValueError("axis must be 'position' or 'time'")
    if direction not in ("bins", "chronological"):
        raise ValueError("direction must be 'bins' or 'chronological'")
    value = F.col("mean")
    if method == "zero":
        return dense.withColumn(name, F.coalesce(value, F.lit(0.0)))

    place = F.col("pos") if axis == "position" else F.col("bin")
    order = F.col("pos").asc() if direction == "bins" else F.col("pos").desc()
    rows = W.partitionBy(*SERIES).orderBy(order)
    point = F.when(value.isNotNull(), F.struct(place.alias("at"), value.alias("v")))
    before = F.last(point, ignorenulls=True).over(rows.rowsBetween(W.unboundedPreceding, 0))
    after = F.first(point, ignorenulls=True).over(rows.rowsBetween(0, W.unboundedFollowing))
    spread = dense.withColumn("_b", before).withColumn("_a", after)

    b, a = F.col("_b.v"), F.col("_a.v")
    slope = (place - F.col("_b.at")) / (F.col("_a.at") - F.col("_b.at"))
    between = F.when(b.isNotNull() & a.isNotNull(), b + (a - b) * slope)
    filled = {
        "interpolate": F.coalesce(value, between),
        "ffill": b,
        "bfill": a,
        "chain": F.coalesce(value, between, b, a),
    }[method]
    return spread.withColumn(name, filled).drop("_b", "_a")


def fill_with_default(dense: DataFrame, defaults: DataFrame, default: str) -> DataFrame:
    """Forward fill in time; what has no earlier value gets the item's default.

    ``defaults`` has one row per item (the item dictionary), e.g. training medians.
    """
    carried = fill(dense, "ffill", direction="chronological")
    return (
        carried.withColumn("_defaults", map_of(defaults, "itemid", default))
        .withColumn("filled", F.coalesce("filled", F.try_element_at("_defaults", F.col("itemid"))))
        .drop("_defaults")
    )
