"""Queries against their SQL, the guard of the entry point, and the pipeline."""

from __future__ import annotations

import pytest
from compare import difference, load_entry, oracle_connection

import corpus_pipeline
from lacuna.llm import queries, sql
from test_operators import SMALL, brute_components


@pytest.mark.parametrize("name", sorted(sql.SQL))
def test_matches_sql(spark, name):
    problem = difference(queries.REGISTRY[name](spark, SMALL), oracle_connection(SMALL), sql.SQL[name])
    assert problem is None, problem


def test_every_operator_is_registered_once():
    names = load_entry().queries()
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


def test_stages_keep_the_columns_and_act_on_all_rows(spark):
    docs = queries.table(spark, SMALL, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.cut_lineage(stage(spark, docs, SMALL))
        rows = {r.doc_id: r.text for r in after.collect()}
        assert set(rows) <= set(before)
        if name == "near_dedup":
            low = brute_components(before)
            assert set(rows) == {i for i in before if low[i] == i}
        if name != "bpe":
            assert after.columns == docs.columns and rows
        else:
            assert rows == before
        docs, before = after, rows


def test_a_long_line_that_repeats_between_other_lines_goes(spark):
    line = lambda n: " ".join(f"w{k}" for k in range(n))
    rows = [(i, f"first {i}\n{line(50)}\n{line(49)} {i}\n{line(49)}\nlast {i}", i) for i in range(3)] + [(9, line(50), 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    left = {r.doc_id: r.text for r in corpus_pipeline.delete_repeated_lines(spark, docs, SMALL).collect()}
    assert set(left) == {0, 1, 2} and left[0] == rows[0][1]
    assert all(left[i] == rows[i][1].replace(line(50) + "\n", "", 1) for i in (1, 2))
