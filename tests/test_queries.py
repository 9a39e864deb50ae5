"""Every query against its SQL, and every query without SQL for rows and a stable schema."""

import importlib

import pytest

from conftest import SF

MODULES = [importlib.import_module(f"gradeweave.plans.{n}") for n in ("core_problems", "text_queries", "schedule_queries", "consensus_queries", "catalog_queries", "io_queries")]
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in MODULES for k, s in m.ORACLE.items()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(name, compare):
    compare(QUERIES[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(name, spark):
    df = QUERIES[name](spark, SF)
    assert df.columns and len(set(df.columns)) == len(df.columns)
    df.count()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
