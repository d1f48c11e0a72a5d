"""Global numbering, running totals and order statistics without a single-task sort.

A window without PARTITION BY sends every row to one task.  Here rows are first
stored in range partitions of about equal size; the totals per partition (a small
table) give each its offset, and the rest is a window inside the partition.  The
result is exact whatever the distribution: an outlier moves no boundary by more than
itself, and the number of partitions grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lacuna.session import cut_lineage

BEFORE = (W.unboundedPreceding, -1)


def _ranged(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """``df`` stored in partitions that are ranges of ``keys``, numbered in ``_cell``."""
    return cut_lineage(df.repartitionByRange(*keys).withColumn("_cell", F.spark_partition_id()))


def _before(c: str, within: Sequence[str]) -> Column:
    earlier = W.partitionBy(*within).orderBy("_cell").rowsBetween(*BEFORE)
    return F.coalesce(F.sum(c).over(earlier), F.lit(0))


def with_row_number(
    df: DataFrame,
    order: str | Column | Sequence[str | Column],
    name: str = "row_number",
    within: Sequence[str] = (),
) -> DataFrame:
    """0-based position of each row in the order of one or more columns, which
    together are unique within a group."""
    keys = [order] if isinstance(order, str | Column) else list(order)
    rows = _ranged(df, [*within, *keys])
    totals = rows.groupBy(*within, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    offsets = totals.select(*within, "_cell", _before("_n", within).alias("_offset"))
    inside = W.partitionBy(*within, "_cell").orderBy(*keys)
    same = F.col("_cell") == F.col("_c")
    renamed = offsets.toDF(*[f"_w{k}" for k in range(len(within))], "_c", "_offset")
    for k, column in enumerate(within):
        same &= F.col(column).eqNullSafe(F.col(f"_w{k}"))
    numbered = rows.join(renamed, same).withColumn(name, F.row_number().over(inside) - 1 + F.col("_offset"))
    return numbered.select(*df.columns, name)


def with_running_totals(
    df: DataFrame, order: str, sums: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """Inclusive running totals ``cum_<c>`` of ``sums`` by ascending ``order``,
    which is numeric and unique within a group, and the group totals ``tot_<c>``.

    The running sums are windows inside one range partition of the order column.
    """
    if not within:
        keyed = with_running_totals(df.withColumn("_all", F.lit(0)), order, sums, ["_all"])
        return keyed.drop("_all")
    within = list(within)
    rows = _ranged(df, [*within, order])
    cells = rows.groupBy(*within, "_cell").agg(*[F.sum(c).alias(c) for c in sums])
    offsets = cells.select(
        *[F.col(c).alias(f"_w{k}") for k, c in enumerate(within)],
        F.col("_cell").alias("_c"),
        *[_before(c, within).alias(f"_b_{c}") for c in sums],
        *[F.sum(c).over(W.partitionBy(*within)).alias(f"tot_{c}") for c in sums],
    )
    same = F.col("_cell") == F.col("_c")
    for k, column in enumerate(within):
        same &= F.col(column).eqNullSafe(F.col(f"_w{k}"))
    inside = W.partitionBy(*within, "_cell").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    running = [(F.sum(c).over(inside) + F.col(f"_b_{c}")).alias(f"cum_{c}") for c in sums]
    return rows.join(offsets, same).select(*df.columns, *running, *[f"tot_{c}" for c in sums])


FINE = 4096  # equal parts of a range of values in one step
PER_OCTAVE = 16  # parts of a doubling in the first step


def _magnitude(x: Column) -> Column:
    """Coarse cell of a value by sign and magnitude, falling nowhere as the value grows."""
    size = F.floor(F.least(F.log2(F.abs(x)), F.lit(1025.0)) * PER_OCTAVE) + 2048 * PER_OCTAVE  # also infinity
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0).cast("long"))


def _by_refinement(
    df: DataFrame, value: str, ranks: Callable[[Column], Column], within: Sequence[str]
) -> DataFrame:
    """The values of the given ranks per group: the columns of ``within``, ``which`` (place in
    the array that ``ranks`` makes of the group's size) and ``found``.

    The values are stored once.  A step cuts the range that holds a rank into cells, counts
    the values of each with their least and greatest (sums combined before anything is
    sent), and keeps the cell the rank falls into, until that cell holds one value only.  The first step
    goes by magnitude, so that outliers cost no step; each later one divides the range of
    what is left by ``FINE``.  No value is sorted or sent.
    """
    keys = [f"_g{k}" for k in range(max(len(within), 1))]
    groups = [F.col(c).alias(k) for c, k in zip(within, keys)] or [F.lit(0).alias(keys[0])]
    values = cut_lineage(df.where(F.col(value).isNotNull()).select(*groups, F.col(value).alias("_x")))
    sizes = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    asked = sizes.select(*keys, "n", "lo", "hi", F.posexplode(ranks(F.col("n"))).alias("which", "rank"))
    known = F.col("rank").between(1, F.col("n"))
    bounded = asked.withColumns({c: F.when(known, F.col(c)) for c in ("lo", "hi")})
    state, first = cut_lineage(bounded.drop("n")), True
    while not state.where("lo < hi").isEmpty():
        unsettled = state.where("lo < hi").toDF(*[f"_s{k}" for k in range(len(keys))], *state.columns[len(keys) :])
        same = (F.col("_x") >= F.col("lo")) & (F.col("_x") <= F.col("hi"))
        for k, key in enumerate(keys):
            same &= F.col(key).eqNullSafe(F.col(f"_s{k}"))
        part = (F.col("_x") - F.col("lo")).cast("double") / (F.col("hi") - F.col("lo")).cast("double")
        cell = _magnitude(F.col("_x").cast("double")) if first else F.floor(part * FINE)
        counted = (
            values.join(unsettled, same)
            .groupBy(*keys, "which", "rank", cell.alias("cell"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
        )
        below = F.coalesce(F.sum("n").over(W.partitionBy(*keys, "which").orderBy("cell").rowsBetween(*BEFORE)), F.lit(0))
        chosen = counted.withColumn("below", below).where("below < rank and rank <= below + n")
        narrowed = chosen.select(*keys, "lo", "hi", "which", (F.col("rank") - F.col("below")).alias("rank"))
        state = cut_lineage(narrowed.unionByName(state.where("not coalesce(lo < hi, false)")))
        first = False
    return state.select(*[F.col(k).alias(c) for k, c in zip(keys, within)], "which", F.col("lo").alias("found"))


def order_statistic(
    df: DataFrame, value: str, rank: Callable[[Column], Column], within: Sequence[str] = ()
) -> DataFrame:
    """The ``rank``-th smallest value (1-based) of each group.

    ``rank`` maps the group size to the rank.  Null when the rank exceeds the size.
    """
    found = _by_refinement(df, value, lambda n: F.array(rank(n).cast("long")), within)
    return found.groupBy(*within).agg(F.min("found").alias(value))


def median(df: DataFrame, value: str, within: Sequence[str] = (), name: str = "median") -> DataFrame:
    """Exact median (mean of the two middle values) of each group."""
    middle = lambda n: F.array(F.floor((n + 1) / 2), F.floor(n / 2) + 1)
    found = _by_refinement(df, value, middle, within)
    return found.groupBy(*within).agg(((F.min("found") + F.max("found")) / 2).alias(name))
