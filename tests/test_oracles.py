"""Every registered query against its SQL oracle on the smallest data."""

from __future__ import annotations

import pytest
from compare import difference, load_entry, oracle_connection
from conftest import SMALL

from lacuna.plans import oracles, queries

ENTRY = load_entry()
ORACLES = oracles.all_sql()
QUERIES = queries.REGISTRY


def test_entry_registers_all():
    assert set(QUERIES) <= set(ENTRY.queries()) and set(ORACLES) <= set(ENTRY.oracle_sql())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    # learners have no SQL form
    assert set(QUERIES) - set(ORACLES) == {
        "rf_cv",
        "cv_summary",
        "experiment_gender",
        "rf_grid",
        "rf_importance",
        "permutation_importance",
        "logreg_cv",
        "gbt_cv",
        "mlp_cv",
    }


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    problem = difference(QUERIES[name](spark, SMALL), oracle_connection(SMALL), ORACLES[name])
    assert problem is None, problem


def test_entry(spark):
    rows = ENTRY.entry(spark)
    assert rows.columns[0] == "hadm_id" and rows.columns[-2:] == ["subject_id", "target"]
    assert len(rows.columns) == 1 + 5 * 15 + 2
    assert rows.count() > 0
