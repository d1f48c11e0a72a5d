"""Readers, writers, schemas, labels and configuration."""

from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.config import ExperimentConfig
from lacuna.functions import codes
from lacuna.operators import items, quality
from lacuna.session import cut_lineage, shared_folder
from lacuna.sources import schemas, tables

TEXT = "id int, note string"
DDL = """
-- a comment
CREATE TABLE mimiciv_hosp.labevents
(
  labevent_id INTEGER NOT NULL, -- key
  hadm_id INTEGER,
  charttime TIMESTAMP(0),
  value VARCHAR(200),
  valuenum DOUBLE PRECISION,
  code CHAR(7) NOT NULL
);
CREATE TABLE mimiciv_icu.d_items (itemid SMALLINT NOT NULL, low FLOAT, rate REAL, dod DATE, at TIMESTAMP(3));
"""


@pytest.mark.parametrize("gzip", [False, True])
def test_csv_keeps_quotes_line_breaks_and_blanks(spark, tmp_path, gzip):
    rows = [(1, 'say "hi", ok'), (2, "two\nlines"), (3, "  padded  "), (4, None), (5, "back\\slash")]
    path = str(tmp_path / "notes")
    tables.write_csv(spark.createDataFrame(rows, TEXT), path, gzip=gzip)
    back = tables.read_csv(spark, path, TEXT, multiline=True, partitions=2)
    assert sorted(map(tuple, back.collect())) == rows


def test_empty_and_quoted_empty_csv_fields_are_null(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text('id,note\n1,\n2,""\n3,"a ""b"""\n')
    back = tables.read_csv(spark, str(file), TEXT).collect()
    assert [tuple(r) for r in back] == [(1, None), (2, None), (3, 'a "b"')]


def test_window_file_is_chosen_by_name(spark, tmp_path):
    for days in (7, 14):
        tables.write_parquet(spark.range(days), str(tmp_path / f"labs_{days}_days_prior.parquet"))
    chosen = tables.read_window_file(spark, str(tmp_path), 7)
    assert chosen.count() == 7
    assert {r.window_days for r in tables.with_window_days(chosen).collect()} == {7}
    assert tables.window_days("labs_14_days_prior.parquet") == 14
    with pytest.raises(ValueError):
        tables.window_days("labs.parquet")
    with pytest.raises(Exception):
        tables.read_window_file(spark, str(tmp_path), 3)


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS mimiciv_hosp")
    spark.range(3).write.mode("overwrite").saveAsTable("mimiciv_hosp.patients")
    assert tables.list_tables(spark, "mimiciv_hosp") == ["patients"]
    assert tables.read_table(spark, "patients", "mimiciv_hosp").count() == 3
    with pytest.raises(ValueError):
        tables.read_table(spark, "nothing", "mimiciv_hosp")
    for call in (tables.list_tables, lambda s, x: tables.read_table(s, "patients", x)):
        with pytest.raises(ValueError):
            call(spark, "public")
    spark.sql("DROP DATABASE mimiciv_hosp CASCADE")


def test_fold_metrics_file(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0.5, 0.4, 0.7, 9)], "fold int, recall double, f1 double, roc_auc double, n int")
    tables.write_fold_metrics(rows, str(tmp_path / "folds"))
    back = tables.read_csv(spark, str(tmp_path / "folds"), "fold int, recall double, f1 double, roc_auc double")
    assert [tuple(r) for r in back.collect()] == [(1, 0.5, 0.4, 0.7)]


def test_schemas_from_ddl():
    found = schemas.schemas_from_ddl(DDL)
    labs = found["mimiciv_hosp.labevents"]
    assert [(f.name, f.dataType) for f in labs] == [
        ("labevent_id", T.IntegerType()),
        ("hadm_id", T.IntegerType()),
        ("charttime", T.TimestampNTZType()),
        ("value", T.StringType()),
        ("valuenum", T.DoubleType()),
        ("code", T.StringType()),
    ]
    assert schemas.required_columns(labs) == ["labevent_id", "code"]
    assert [f.dataType for f in found["mimiciv_icu.d_items"]] == [
        T.ShortType(), T.DoubleType(), T.FloatType(), T.DateType(), T.TimestampNTZType(),
    ]
    with pytest.raises(ValueError):
        schemas.schemas_from_ddl("CREATE TABLE a.b (x JSONB);")


def test_declared_keys():
    assert len(schemas.PRIMARY_KEYS) == 24
    references = schemas.foreign_keys()
    assert len(references) == len(set(references)) == 51
    assert ("labevents", "itemid", "d_labitems", "itemid") in references


def test_checkpoint_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    df = cut_lineage(spark.range(5).withColumn("x", F.lit("a")))
    assert df.count() == 5 and "Scan parquet" in df._jdf.queryExecution().toString()


def test_constraint_checks(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "id int, ref int")
    parent = spark.createDataFrame([(1,), (2,)], "key int")
    found = quality.foreign_key_check(child, "ref", parent, "key", "c").first()
    assert (found.orphan_keys, found.orphan_rows) == (1, 2)
    unique = quality.primary_key_check(child, ["ref"], "child").first()
    assert (unique.n_rows, unique.null_rows, unique.duplicate_keys) == (4, 1, 1)
    assert quality.valid_ids(child, ["ref"]).count() == 3


def test_race_groups(spark):
    cases = {
        "White - Hispanic": "Hispanic or Latino",
        "south american": "Hispanic or Latino",
        "WHITE - RUSSIAN": "White",
        "BLACK/CARIBBEAN": "Black or African American",
        "ASIAN - KOREAN": "Asian",
        "UNABLE TO OBTAIN": "Unknown or Not Reported",
        "PORTUGUESE": "Other",
        None: "Unknown or Not Reported",
    }
    df = spark.createDataFrame([(k,) for k in cases], "race string")
    got = {r.race: r.g for r in df.select("race", codes.race_group(F.col("race")).alias("g")).collect()}
    assert got == cases


def test_label_choice(spark):
    df = spark.createDataFrame([(1, "M", 70, "WHITE", 1)], "hadm_id int, gender string, anchor_age int, race string, target int")
    assert items.keep_label(df, "gender").columns == ["hadm_id", "gender"]
    with pytest.raises(ValueError):
        items.label_column("height")


def test_config():
    assert ExperimentConfig().last_bin == 14
    for bad in (
        {"bin_hours": 25},
        {"label": "height"},
        {"label": "anchor_age", "age_threshold": 17},
        {"model": "svm"},
        {"feature_set": "X"},
        {"test_size": 1.0},
        {"metrics": ("mse",)},
        {"window_days": 0},
    ):
        with pytest.raises(ValueError):
            ExperimentConfig(**bad)


def test_a_query_to_a_database_can_be_read_in_ranges():
    plain = tables.jdbc_options("SELECT 1 AS x", "jdbc:any", user="u")
    assert plain == {"url": "jdbc:any", "query": "SELECT 1 AS x", "user": "u"}
    ranged = tables.jdbc_options("SELECT x FROM t", "jdbc:any", ("x", 0, 100, 8))
    assert "query" not in ranged and ranged["dbtable"] == "(SELECT x FROM t) AS split_query"
    assert (ranged["partitionColumn"], ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("x", "0", "100", "8")
    for bad in (("x", 5, 5, 8), ("x", 0, 5, 0)):
        with pytest.raises(ValueError):
            tables.jdbc_options("SELECT x FROM t", "jdbc:any", bad)


def test_rows_that_do_not_fit_go_to_the_rejects_with_a_reason(spark, tmp_path):
    lines = ["a,b,t", "1,2.5,x", "one,2.5,x", "2,,", '3,"2,5","q ""x"""', "4,1.0,x,more", "5", ",NaN,z"]
    (tmp_path / "some.csv").write_text("\n".join(lines) + "\n")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType()), T.StructField("t", T.StringType())])
    good, bad = tables.read_csv_with_rejects(spark, str(tmp_path / "some.csv"), schema)
    assert good.schema == schema
    assert sorted(map(str, good.collect())) == sorted(map(str, [Row(a=1, b=2.5, t="x"), Row(a=2, b=None, t=None), Row(a=None, b=None, t="z")]))
    found = {r.record: r.reason for r in bad.collect()}
    assert found == {
        "one,2.5,x": "a is no bigint", '3,"2,5","q ""x"""': "b is no double", "4,1.0,x,more": "number of fields", "5": "number of fields",
    }
    assert all(r.file.endswith("some.csv") for r in bad.collect())
    with pytest.raises(Exception):
        tables.read_csv(spark, str(tmp_path / "some.csv"), schema).collect()


def test_declared_keys_and_references_are_checked_as_a_set(spark):
    parent = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "id int, v string")
    child = spark.createDataFrame([(1, 1), (1, 9), (2, 9), (3, None), (3, 7)], "k int, ref int")
    found = quality.declared_checks(
        {"parent": parent, "child": child, "empty": child.limit(0)},
        {"parent": ["id"], "child": ["k", "ref"], "absent": ["x"], "empty": ["k"]},
        [("child", "ref", "parent", "id"), ("child", "ref", "absent", "x"), ("empty", "ref", "parent", "id")],
        {"parent": ["v"]},
    )
    assert {tuple(r)[:4]: tuple(r)[4:] for r in found.collect()} == {
        ("primary_key", "parent", "id", ""): (4, 1, 1, 2),
        ("primary_key", "child", "k,ref", ""): (5, 1, 0, 0),
        ("primary_key", "empty", "k", ""): (0, 0, 0, 0),
        ("foreign_key", "child", "ref", "parent.id"): (5, 1, 2, 3),
        ("foreign_key", "empty", "ref", "parent.id"): (0, 0, 0, 0),
        ("not_null", "parent", "v", ""): (4, 1, 0, 0),
    }


def test_all_declarations_run_together(spark):
    references = schemas.foreign_keys()
    columns: dict[str, set[str]] = {t: set(k) for t, k in schemas.PRIMARY_KEYS.items()}
    for child, column, table, key in references:
        columns.setdefault(child, set()).add(column)
        columns.setdefault(table, set()).add(key)
    frames = {t: spark.range(3).select(*[F.col("id").alias(c) for c in sorted(some)]) for t, some in columns.items()}
    rows = quality.declared_checks(frames, schemas.PRIMARY_KEYS, references).collect()
    assert len(rows) == len(schemas.PRIMARY_KEYS) + len(references) == 24 + 51
    assert all((r.n_rows, r.null_rows, r.bad_keys, r.bad_rows) == (3, 0, 0, 0) for r in rows)
