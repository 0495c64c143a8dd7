"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import difference

import __spark_entry__ as entry
from kinetable.catalog.oracle import ORACLE
from kinetable.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="tables not present")


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    assert difference(frame, SF_DIR, ORACLE[name]) is None


@needs_tables
def test_entry(spark):
    assert entry.entry(spark).count() == 54


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_pair_products_or_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert unwanted not in plan
