"""Reading and writing: CSV (plain or gzip), Parquet, JDBC and catalog tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.session import cut_lineage
from lacuna.sources.schemas import SCHEMAS

# Quotes are doubled, not escaped with a backslash; blanks belong to the text.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "FAILFAST",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# Whole microseconds on writing; on reading any ISO spelling is understood.
CSV_TIMES = {
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
}
_RECORD, _FILE = "_record", "_file"
WINDOW_FILE = r"_(\d+)_days_prior"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    multiline: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """CSV with a header; an empty field and a NaN number are null, a field that does
    not fit its type is an error.  ``.gz`` files are decompressed by name.

    A gzip file, or any file read with ``multiline`` (text with line breaks), is
    one task from end to end: write many files, or give ``partitions`` to spread
    the rows before further work.
    """
    paths = path if isinstance(path, str) else list(path)
    df = spark.read.options(**CSV_OPTIONS).schema(schema).csv(paths, multiLine=multiline)
    df = nan_to_null(df)
    return df.repartition(partitions) if partitions else df


def read_csv_with_rejects(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multiline: bool = False, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, and the others as ``file``, ``record`` (the text as it
    stands) and ``reason``, instead of the error that ``read_csv`` raises.

    The reason is the number of fields, or the first column whose text does not fit its
    type.  The files are parsed once; both results come from the stored outcome.
    """
    whole = T.StructType([*schema.fields, T.StructField(_RECORD, T.StringType())])
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD, "header": str(header).lower()}
    paths = path if isinstance(path, str) else list(path)
    parsed = spark.read.options(**options).schema(whole).csv(paths, multiLine=multiline)
    rows = cut_lineage(parsed.withColumn(_FILE, F.when(F.col(_RECORD).isNotNull(), F.input_file_name())))
    good = nan_to_null(rows.where(F.col(_RECORD).isNull()).drop(_RECORD, _FILE))
    bad = rows.where(F.col(_RECORD).isNotNull()).select(F.col(_FILE).alias("file"), F.col(_RECORD).alias("record"))
    return good, bad.withColumn("reason", _misfit(schema, options))


def _misfit(schema: T.StructType, options: dict[str, str]) -> Column:
    """Why the text ``record`` is no row of ``schema``."""
    texts = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(schema))])
    fields = F.from_csv("record", (texts.add(_RECORD, T.StringType())).simpleString()[7:-1].replace(":", " "), options)
    reasons = [F.when(fields[_RECORD].isNotNull(), "number of fields")]
    for k, field in enumerate(schema):
        text = fields[f"c{k}"]
        unfit = text.isNotNull() & (text != "") & text.try_cast(field.dataType).isNull()
        reasons.append(F.when(unfit, f"{field.name} is no {field.dataType.simpleString()}"))
    return F.coalesce(*reasons, F.lit("does not parse"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns as null, as the rest of the library expects."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.FloatType | T.DoubleType)]
    return df.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in numbers}) if numbers else df


def write_csv(df: DataFrame, path: str, gzip: bool = False, mode: str = "overwrite") -> None:
    options = CSV_OPTIONS | CSV_TIMES | {"compression": "gzip" if gzip else "none"}
    df.write.mode(mode).options(**options).csv(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One frame over any number of Parquet paths of the same schema."""
    return spark.read.parquet(*paths)


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: str | Sequence[str],
    buckets: int,
    path: str | None = None,
    sort: Sequence[str] = (),
    compression: str = "zstd",
) -> DataFrame:
    """Store ``df`` as the catalog table ``table``, dealt into ``buckets`` by ``keys``, and
    read it from there.

    Joins and aggregates on exactly these keys need no exchange of the stored side.  Every
    writing task adds a file to each bucket it has rows of, so deal the rows out by the keys
    first unless a task holds few keys.  ``sort`` orders the rows of a file, which keeps the
    keys of a row group together.  ``path`` keeps the files outside the warehouse.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    writer = df.write.mode("overwrite").format("parquet").option("compression", compression).bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*sort)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def store_by_admission(df: DataFrame, table: str, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """``df`` as a table bucketed and sorted by (subject, admission), one file a bucket, in
    place of an index: tables stored so with as many buckets are joined and aggregated by
    admission without an exchange.  Rows of one admission share a bucket, so the largest
    admission is one task's work."""
    keys = ["subject_id", "hadm_id"]
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return write_bucketed(df.repartition(buckets, *keys), table, keys, buckets, path=path, sort=keys)


def read_window_file(spark: SparkSession, folder: str, days: int) -> DataFrame:
    """The extract of one window size, found by its name ``*_<days>_days_prior.parquet``;
    two extracts of that size are an error."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/*_{days}_days_prior.parquet")
    name = re.compile(rf"[^/]*_{days}_days_prior\.parquet")
    names = {m[0] for m in map(name.search, df.inputFiles()) if m}
    if len(names) > 1:
        raise ValueError(f"several extracts of {days} days: {sorted(names)}")
    return nan_to_null(df)


def window_days(name: str) -> int:
    """Window size in a file name."""
    match = re.search(WINDOW_FILE, name)
    if match is None:
        raise ValueError(f"no '_<days>_days_prior' in file name {name!r}")
    return int(match.group(1))


def with_window_days(df: DataFrame) -> DataFrame:
    """Window size of each row's source file (null where the name has none)."""
    text = F.regexp_extract(F.input_file_name(), WINDOW_FILE, 1)
    return df.withColumn("window_days", F.when(text != "", text.cast("int")))


def list_tables(spark: SparkSession, schema: str) -> list[str]:
    """Tables of one of the two source schemas."""
    if schema not in SCHEMAS:
        raise ValueError(f"schema must be one of {SCHEMAS}")
    return sorted(t.name for t in spark.catalog.listTables(schema) if not t.isTemporary)


def read_table(spark: SparkSession, table: str, schema: str | None = None) -> DataFrame:
    """A catalog table by name; unknown schemas and tables raise ``ValueError``."""
    if schema is None:
        return spark.table(table)
    if schema not in SCHEMAS:
        raise ValueError(f"schema must be one of {SCHEMAS}")
    if not spark.catalog.tableExists(f"{schema}.{table}"):
        raise ValueError(f"no table {table!r} in schema {schema!r}")
    return spark.table(f"{schema}.{table}")


def jdbc_options(
    query: str, url: str, split: tuple[str, int, int, int] | None = None, **options: str
) -> dict[str, str]:
    """Options of a JDBC read of ``query``.

    ``split`` is (column, lower bound, upper bound, partitions): the query is read by
    that many tasks, each a range of the column; rows outside the bounds go to the
    first and last.  Without it one task reads all.
    """
    if split is None:
        return {"url": url, "query": query, **options}
    column, lower, upper, partitions = split
    if partitions < 1 or lower >= upper:
        raise ValueError("split needs partitions >= 1 and a lower bound below the upper")
    return {
        "url": url,
        "dbtable": f"({query}) AS split_query",
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        **options,
    }


def read_query(
    spark: SparkSession,
    query: str,
    url: str | None = None,
    split: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """Result of a SQL query: over Spark's own views, or pushed to a database when
    a JDBC ``url`` is given (the driver jar is the caller's; ``split`` as in
    ``jdbc_options``)."""
    if url is None:
        return spark.sql(query)
    return spark.read.format("jdbc").options(**jdbc_options(query, url, split, **options)).load()


def register(df: DataFrame, view: str) -> str:
    """Make a frame readable by name in SQL."""
    df.createOrReplaceTempView(view)
    return view


def write_fold_metrics(metrics: DataFrame, path: str) -> None:
    """Fold metrics (one small row per fold) as a CSV file."""
    chosen = metrics.select("fold", "recall", "f1", "roc_auc").orderBy("fold")
    write_csv(chosen.coalesce(1), path)
