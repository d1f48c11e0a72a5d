"""Wide matrices, built last and always with the column list given, so no extra
job looks for distinct values and the schema does not depend on the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions import codes, timing
from lacuna.operators.quality import require_unique


def feature_columns(items: Sequence[int], last_bin: int) -> list[str]:
    """Matrix columns in (item, bin) order."""
    return [f"{item}_{b}" for item in items for b in range(last_bin + 1)]


def pivot_features(
    series: DataFrame, items: Sequence[int], last_bin: int, value: str = "filled"
) -> DataFrame:
    """One row per admission, one column ``<item>_<bin>`` per item and bin."""
    named = series.select(
        "hadm_id", codes.feature_name(F.col("itemid"), F.col("bin")).alias("feature"), value
    )
    return named.groupBy("hadm_id").pivot("feature", feature_columns(items, last_bin)).agg(
        F.first(value)
    )


def vector_features(
    series: DataFrame, items: Sequence[int], last_bin: int, value: str = "filled"
) -> DataFrame:
    """One row per admission with the same cells as ``pivot_features`` in one array
    column ``values``.  The plan does not grow with the number of features, so this
    is the form models and imputers take."""
    items = list(items)
    size = len(items) * (last_bin + 1)
    place = F.array_position(F.array(*[F.lit(i) for i in items]), F.col("itemid")) - 1
    cells = series.filter(F.col("itemid").isin(items) & (F.col("bin") <= last_bin)).select(
        "hadm_id", (place * (last_bin + 1) + F.col("bin")).cast("int").alias("at"), value
    )
    packed = cells.groupBy("hadm_id").agg(
        F.map_from_entries(F.collect_list(F.struct("at", value))).alias("cells")
    )
    every = F.sequence(F.lit(0), F.lit(size - 1))
    return packed.select(
        "hadm_id", F.transform(every, lambda i: F.try_element_at("cells", i)).alias("values")
    )


def named_cells(vectors: DataFrame, names: Sequence[str], key: str = "hadm_id") -> DataFrame:
    """(key, feature, value) rows of an array matrix."""
    labels = F.array(*[F.lit(n) for n in names])
    return vectors.select(key, F.posexplode("values").alias("at", "value")).select(
        key, F.get(labels, F.col("at")).alias("feature"), "value"
    )


def last_n_features(labs: DataFrame, days: int = 7, width: int = 6, cap: int = 27) -> DataFrame:
    """Labs of the window with the 1-based capped bin and the verbose feature name."""
    complete = labs.na.drop(subset=["charttime", "dischtime", "hadm_id", "itemid", "valuenum"])
    hours = timing.hours_before(F.col("dischtime"), F.col("charttime"))
    timed = complete.withColumn("hours", hours).filter(F.col("hours").between(0, days * 24))
    binned = timed.withColumn("hour_bin", timing.capped_bin(F.col("hours"), width, cap))
    return binned.withColumn(
        "feature_id", codes.feature_name_verbose(F.col("itemid"), F.col("hour_bin"))
    )


def last_n_columns(items: Sequence[int], cap: int = 27) -> list[str]:
    return [f"itemid_{item}_last_{b}h" for item in items for b in range(1, cap + 1)]


def pivot_numeric(rows: DataFrame, columns: Sequence[str], value: str = "valuenum") -> DataFrame:
    """Mean of ``value`` per admission and feature."""
    return rows.groupBy("hadm_id").pivot("feature_id", list(columns)).agg(F.avg(value))


def pivot_measured(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """1 where the admission has the feature, else 0; columns end in ``_measured``."""
    wide = rows.groupBy("hadm_id").pivot("feature_id", list(columns)).agg(F.max(F.lit(1)))
    return wide.select(
        "hadm_id", *[F.coalesce(F.col(c), F.lit(0)).alias(f"{c}_measured") for c in columns]
    )


def join_label(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach label columns to the feature rows; labels without features are
    dropped, features without label get null, two different labels for one
    admission fail the job."""
    return features.join(require_unique(labels, "hadm_id"), "hadm_id", "left")


def feature_set(
    cells: DataFrame, kind: str, items: Sequence[int], last_bin: int
) -> DataFrame:
    """Wide matrix of values (V), masks (M) and time gaps (D) as named by ``kind``.

    ``cells`` has one row per (hadm_id, itemid, bin) with columns v, m and d.
    Columns are ``<letter>_<item>_<bin>``.
    """
    letters = list(kind.lower())
    if not letters or set(letters) - set("vmd"):
        raise ValueError("kind is built from the letters V, M and D")
    names = feature_columns(items, last_bin)
    named = cells.withColumn("feature", codes.feature_name(F.col("itemid"), F.col("bin")))
    wide = named.groupBy("hadm_id").pivot("feature", names).agg(
        F.first(F.struct(*letters)).alias("cell")
    )
    return wide.select(
        "hadm_id", *[F.col(f"`{n}`.{letter}").alias(f"{letter}_{n}") for letter in letters for n in names]
    )
