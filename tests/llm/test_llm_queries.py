"""Queries of the subpackage against SQL where there is some, and for rows and schema elsewhere."""

import pytest

from conftest import SF
from gradeweave.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(name, compare):
    compare(queries.QUERIES[name], queries.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_runs(name, spark):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(map(str, r)) for r in df.collect()]
    assert df.columns and len(set(df.columns)) == len(df.columns)
    assert name not in ("p2_found", "p4_found", "p6_found", "p8_found", "p10_found") or len(set(rows)) == len(rows)
