"""Run registered queries next to their SQL oracles and report differences.

    python tests/compare.py [sf-folder] [name ...]
"""

from __future__ import annotations

import importlib.util
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if not isinstance(v, float) else round(v, 4)) if v is not None else (True, "", 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def difference(spark_df, connection, sql: str) -> str | None:
    """None when equal: names, row count and every value."""
    names = sorted(spark_df.columns)
    got = [tuple(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect()]
    found = connection.execute(sql)
    oracle_names = [d[0] for d in found.description]
    if sorted(oracle_names) != names:
        return f"columns {names} != {sorted(oracle_names)}"
    order = [oracle_names.index(n) for n in names]
    expected = [tuple(r[i] for i in order) for r in found.fetchall()]
    if len(got) != len(expected):
        return f"{len(got)} rows, oracle has {len(expected)}"
    for a, b in zip(sorted(got, key=_key), sorted(expected, key=_key), strict=True):
        for name, x, y in zip(names, a, b, strict=True):
            if not _same(x, y) or (x is not None and type(x) is not type(y)):
                return f"{name}: {x!r} != {y!r} in {a} / {b}"
    return None


def main() -> None:
    sys.path.insert(0, str(ROOT))
    from pyspark.sql import SparkSession

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    entry = load_entry()
    oracles = entry.oracle_sql()
    failed = 0
    for name, build in entry.queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in oracles:
                problem = difference(df, oracle_connection(folder), oracles[name])
                status = "ok" if problem is None else f"DIFF {problem}"
            else:
                status = f"rows {df.count()}"
        except Exception as error:  # report and go on with the next query
            status = f"ERROR {type(error).__name__} {str(error)[:600]}"
        failed += not status.startswith(("ok", "rows"))
        print(f"{name:28s} {time.time() - start:6.1f}s {status}", flush=True)
    print(f"failed: {failed}")


if __name__ == "__main__":
    main()
