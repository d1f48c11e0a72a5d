"""Splits, resampling and class weights, reproducible from the row keys.

These functions read their input more than once (class sizes, numbering, rows):
pass a stored table, or ``session.cut_lineage(df)`` when it is costly to compute.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.functions import hashing
from lacuna.operators.lookup import map_of
from lacuna.operators.ranking import with_row_number

DRAWS_PER_CHUNK = 65_536


def holdout(df: DataFrame, key: str = "hadm_id", test_size: float = 0.2, seed: int = 0) -> DataFrame:
    """Add ``is_test``: exactly ``ceil(test_size * n)`` rows, drawn by key digest."""
    total = df.agg(F.count(F.lit(1))).scalar()
    ranked = with_row_number(df.withColumn("_d", hashing.digest(key, seed=seed)), "_d", "_rn")
    test = F.col("_rn") < F.ceil(total * F.lit(test_size))
    return ranked.withColumn("is_test", test.cast("int")).drop("_d", "_rn")


def group_folds(
    df: DataFrame,
    group: str = "subject_id",
    label: str = "target",
    k: int = 5,
    seed: int = 42,
    name: str = "fold",
) -> DataFrame:
    """Add a fold number; all rows of a group share it.

    Groups are dealt by their exact numbers of positives and rows, largest first and
    in serpentine order, so every fold gets nearly the same mix and one huge group is
    met by the small ones of the other folds.  A row without group is a group of its
    own, dealt by its digest.
    """
    groups = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.coalesce(F.sum(F.col(label).cast("int")), F.lit(0)).alias("pos"), F.count(F.lit(1)).alias("rows")
    )
    order = [F.desc("pos"), F.desc("rows"), F.asc("_d")]
    dealt = with_row_number(groups.withColumn("_d", hashing.digest(group, seed=seed)), order, "_rn")
    turn = F.col("_rn") % (2 * k)
    fold = F.when(turn < k, turn).otherwise(2 * k - 1 - turn)
    folds = dealt.select(F.col(group).alias("_g"), fold.cast("int").alias("_fold"))
    alone = F.pmod(F.xxhash64(*df.columns), F.lit(k)).cast("int")
    joined = df.join(folds, F.col(group) == F.col("_g"), "left")
    return joined.withColumn(name, F.coalesce("_fold", alone)).drop("_g", "_fold")


def fold_balance(folded: DataFrame, group: str = "subject_id", label: str = "target") -> DataFrame:
    """Rows, groups and positive rate per fold."""
    per_group = folded.groupBy("fold", group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("p")
    )
    return per_group.groupBy("fold").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_groups"),
        F.sum("p").alias("positives"),
        (F.sum("p") / F.sum("n")).alias("positive_rate"),
    )


def _class_sizes(df: DataFrame, label: str) -> Column:
    """Scalar struct: the rarer class, its size and how many rows it is short of."""
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.struct(
            F.min_by(label, F.struct("n", label)).alias("minority"),
            F.min("n").alias("n_min"),
            (F.max("n") - F.min("n")).alias("deficit"),
        ).alias("s")
    ).scalar()


def oversample(
    df: DataFrame, label: str = "target", key: str = "hadm_id", seed: int = 42
) -> DataFrame:
    """All rows, plus random copies of minority rows until both classes are equal.

    ``draw`` is -1 for the originals and the draw number for copies.  Draw ``j``
    takes the minority row whose position in digest order is hash(j) modulo the
    class size.  Draws are generated in chunks on the executors.
    """
    sizes = _class_sizes(df, label)
    pool = df.withColumn("_s", sizes).filter(F.col(label) == F.col("_s.minority")).drop("_s")
    pool = with_row_number(pool.withColumn("_d", hashing.digest(key, seed=seed)), "_d", "_pick")

    first = F.col("chunk") * DRAWS_PER_CHUNK
    last = F.least(first + DRAWS_PER_CHUNK, F.col("s.deficit")) - 1
    chunks = F.ceil(F.col("s.deficit") / DRAWS_PER_CHUNK) - 1
    draws = (
        df.sparkSession.range(1)
        .select(sizes.alias("s"))
        .filter(F.col("s.deficit") > 0)
        .select("s", F.explode(F.sequence(F.lit(0).cast("bigint"), chunks)).alias("chunk"))
        .repartition("chunk")
        .select("s", F.explode(F.sequence(first, last)).alias("draw"))
        .select(
            "draw",
            (hashing.leading_int(hashing.digest("draw", seed=seed)) % F.col("s.n_min")).alias("_pick"),
        )
    )
    copies = draws.join(pool, "_pick").select(*df.columns, "draw")
    return df.withColumn("draw", F.lit(-1).cast("bigint")).unionByName(copies)


def undersample(
    df: DataFrame, label: str = "target", key: str = "hadm_id", seed: int = 42
) -> DataFrame:
    """Minority rows and an equally large random part of the others."""
    sizes = _class_sizes(df, label)
    ranked = with_row_number(
        df.withColumn("_d", hashing.digest(key, seed=seed)), "_d", "_rn", within=[label]
    )
    return ranked.filter(F.col("_rn") < sizes["n_min"]).select(*df.columns)


def class_weights(
    df: DataFrame,
    label: str = "target",
    mode: str | Mapping[int, float] | None = None,
    name: str = "weight",
) -> DataFrame:
    """Weight column: 1, ``balanced`` (n / (classes * class size)) or given per class."""
    if mode is None:
        return df.withColumn(name, F.lit(1.0))
    if isinstance(mode, Mapping):
        weight = F.lit(1.0)
        for value, w in mode.items():
            weight = F.when(F.col(label) == value, F.lit(float(w))).otherwise(weight)
        return df.withColumn(name, weight)
    if mode != "balanced":
        raise ValueError("mode must be None, 'balanced' or a mapping")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    per_class = map_of(sizes, label, "n")
    total = F.aggregate(F.map_values("_m"), F.lit(0).cast("bigint"), lambda a, n: a + n)
    share = F.size("_m") * F.try_element_at("_m", F.col(label))
    return df.withColumn("_m", per_class).withColumn(name, total / share).drop("_m")


def train_test(df: DataFrame, flag: str = "is_test") -> Sequence[DataFrame]:
    return df.filter(F.col(flag) == 0), df.filter(F.col(flag) == 1)
