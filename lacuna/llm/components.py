"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a grouped minimum (combined on the map side) and a join back; a node with
very many links is reduced before it moves, and the join of a stored table with stored
minima is one that the adaptive skew rule may split.  Only a count reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.session import cut_lineage


def _minima(links: DataFrame) -> DataFrame:
    """Smallest of each ``u`` and its neighbours ``v``."""
    return cut_lineage(links.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m")))


def _settled(links: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` that is no ``u`` itself: stars only."""
    ends = links.select(F.col("u").alias("id"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    mixed = ends.groupBy("id").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or down + up > 1")
    return mixed.agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (its smallest reachable id) of every id in ``links``.

    ``links`` has two columns of the same orderable type; direction, loops and repeats
    do not matter, and rows with a null end are ignored.  Ids without links do not
    appear.
    """
    a, b = links.columns
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    # from the larger to the smaller end
    down = cut_lineage(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while not _settled(down):
        both = down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_minima(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        down = cut_lineage(large.where("u <> v").distinct())
        low = _minima(down)
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        down = cut_lineage(small.toDF("u", "v").where("u <> v").distinct())
    return down.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        down.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
