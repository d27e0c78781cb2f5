"""The driver contract, and every registered query against its DuckDB
twin on the smallest tables (the driver repeats this at sf0.01)."""

import importlib
import os
import sys

import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
entry_mod = importlib.import_module("__spark_entry__")
oracle_check = importlib.import_module("oracle_check")

from weblex.plans import catalog  # noqa: E402

# The llm queries, when there, are tested in tests/llm.
NAMES = sorted(catalog.QUERIES)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["term", "frequency", "domains"]
    assert df.count() > 0


def test_every_query_has_a_name_and_sql():
    sqls = entry_mod.oracle_sql()
    assert set(sqls) <= set(entry_mod.queries()) >= set(NAMES)
    assert len(NAMES) >= 40


@pytest.fixture(scope="module")
def duck():
    return oracle_check.duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sql = entry_mod.oracle_sql().get(name)
    msg, ok = oracle_check.compare(spark, duck, name, entry_mod.queries()[name], sql, SF_SMALL)
    assert ok, msg
