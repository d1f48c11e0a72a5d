"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

# Without the last setting Spark keeps a skewed join whole whenever the aggregate
# after it could reuse the join's partitioning, e.g. duplicates resolved per
# (subject, admission, item, time) after a join on (subject, admission).  One
# admission with a third of the rows would then be joined and aggregated in one task.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
SESSION_DEFAULTS = SKEW_SETTINGS | {
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "lacuna", **overrides: str) -> SparkSession:
    """Session with the library's defaults; ``overrides`` use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    conf = SESSION_DEFAULTS | {k.replace("_", "."): v for k, v in overrides.items()}
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the skew settings to a session made elsewhere."""
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, the context's
    checkpoint directory, or else one below the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def clear_shared(spark: SparkSession) -> bool:
    """Delete what this library has stored in the shared folder; frames that were cut
    from their lineage cannot be read after it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/lacuna")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/lacuna/{name}-{uuid.uuid4().hex}"


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a frame from ``cut_lineage`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that have ended: it does so for plans that
    the driver's garbage collection has found to be gone, by itself every half an hour."""
    gc.collect()
    spark._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the files.

    Used where a frame feeds many jobs (model fits) or where a plan reads it
    several times; a lost executor then costs a re-read, not a recomputation.
    """
    path = new_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
