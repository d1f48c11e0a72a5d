"""Checks of declared constraints, as counts in a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lacuna.session import cut_lineage


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def primary_key_check(table: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with a null key part and keys that occur more than once."""
    per_key = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    has_null = _any_null(keys)
    return per_key.agg(
        F.lit(name).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_rows"),
        F.count_if(~has_null & (F.col("n") > 1)).alias("duplicate_keys"),
    )


def foreign_key_check(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str
) -> DataFrame:
    """Non-null child keys without a parent row.

    Child rows are counted per key before the join, so a frequent key is one row
    when it is shuffled.
    """
    keys = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")
    return orphans.agg(
        F.lit(name).alias("constraint_name"),
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
    )


def not_null_check(table: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Null count per column in one pass over the table."""
    counts = table.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns]
    )
    return counts.select("n_rows", F.explode(pairs).alias("p")).select(
        F.lit(name).alias("table_name"), "p.column_name", "n_rows", "p.null_rows"
    )


def declared_checks(
    frames: Mapping[str, DataFrame],
    primary_keys: Mapping[str, Sequence[str]],
    foreign_keys: Sequence[tuple[str, str, str, str]],
    required: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All declared keys, references (child, column, parent, column) and NOT NULL columns of
    ``frames``; declarations about other tables are passed over.

    A row per check: ``check_name``, ``table_name``, ``column_names``, ``refers_to``,
    ``n_rows``, ``null_rows``, ``bad_keys`` (repeated keys, or keys without a parent) and
    ``bad_rows``.  Each table is read once: the values of all its keys, of its references
    and of the columns others refer to are counted in one grouping, a frequent value being
    one row when it is sent.  All references are then resolved by one join of counts.
    """
    keys = [("primary_key", t, ",".join(c), None, None) for t, c in primary_keys.items() if t in frames]
    references = [("foreign_key", c, k, p, pk) for c, k, p, pk in foreign_keys if c in frames and p in frames]
    nulls = [("not_null", t, c, None, None) for t, some in (required or {}).items() if t in frames for c in some]
    checks = [*keys, *references, *nulls]
    if not checks:
        raise ValueError("nothing is declared about these tables")
    spark = next(iter(frames.values())).sparkSession
    sets = {(t, c) for _, t, c, _, _ in checks} | {(p, pk) for *_, p, pk in references}
    counted = []
    for name, frame in frames.items():
        own = sorted(c for t, c in sets if t == name)
        if own:
            values = [
                F.struct(F.lit(c).alias("columns"), F.array(*[F.col(k).cast("string") for k in c.split(",")]).alias("key"))
                for c in own
            ]
            rows = frame.select(F.inline(F.array(*values))).groupBy("columns", "key").agg(F.count(F.lit(1)).alias("n"))
            counted.append(rows.select(F.lit(name).alias("table"), "*", F.exists("key", lambda k: k.isNull()).alias("missing")))
    counts = cut_lineage(reduce(DataFrame.unionByName, counted))

    declared = F.broadcast(  # as long as the declarations
        spark.createDataFrame(checks, "check_name string, table_name string, column_names string, parent string, parent_columns string")
    )
    of_check = counts.join(
        declared, (F.col("table") == F.col("table_name")) & (F.col("columns") == F.col("column_names"))
    )
    parents = counts.where("not missing").select(
        F.col("table").alias("parent"), F.col("columns").alias("parent_columns"), "key", F.lit(1).alias("present")
    )
    bad = F.when(F.col("check_name") == "primary_key", F.col("n") > 1).when(
        F.col("check_name") == "foreign_key", F.col("present").isNull()
    )
    bad = F.coalesce(bad, F.lit(False)) & ~F.col("missing")
    found = of_check.join(parents, ["parent", "parent_columns", "key"], "left").groupBy("check_name", "table_name", "column_names", "parent", "parent_columns")
    sums = found.agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("missing"), F.col("n"))).alias("null_rows"),
        F.count_if(bad).alias("bad_keys"),
        F.sum(F.when(bad, F.col("n"))).alias("bad_rows"),
    )
    named = ("check_name", "table_name", "column_names", "parent", "parent_columns")
    sums = sums.withColumnsRenamed({c: f"_{c}" for c in named})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in named]
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", "null_rows", "bad_keys", "bad_rows")]
    refers = F.coalesce(F.concat_ws(".", "parent", "parent_columns"), F.lit(""))
    return declared.join(sums, same, "left").select(*named[:3], refers.alias("refers_to"), *numbers)


def invalid_id_report(table: DataFrame, ids: Sequence[str] = ("subject_id", "hadm_id")) -> DataFrame:
    """How many rows carry unusable ids."""
    return table.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ids],
        F.count_if(_any_null(ids)).alias("invalid_rows"),
        F.count_if(~_any_null(ids)).alias("valid_rows"),
    )


def valid_ids(table: DataFrame, ids: Sequence[str] = ("subject_id", "hadm_id")) -> DataFrame:
    return table.na.drop(subset=list(ids))


def duplicate_rows(table: DataFrame) -> DataFrame:
    """Full-row duplicates and how often each occurs."""
    return table.groupBy(*table.columns).count().filter(F.col("count") > 1)


def require_unique(table: DataFrame, key: str) -> DataFrame:
    """The same rows, one per key; the job fails when a key has two different rows.

    Runs inside the query (no separate job): exact copies are merged, anything
    else raises.
    """
    others = [c for c in table.columns if c != key]
    kept = table.distinct().groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in others]
    )
    message = F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string"))
    first = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col(others[0]))
    return kept.withColumn(others[0], first).select(*table.columns)
