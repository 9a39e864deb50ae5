import os
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from gradeweave.runtime import session, ship

    s = session(4, spark__sql__shuffle__partitions="4")
    ship(s)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*' if p.is_dir() else ''}')")
    return con


def normal(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 9)
    return v.item() if hasattr(v, "item") else v


def bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(str(normal(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="session")
def compare(spark, duck):
    def run(query, sql):
        df = query(spark, SF)
        got = bag([tuple(r) for r in df.collect()], df.columns)
        rel = duck.execute(sql)
        columns = [d[0] for d in rel.description]
        want = bag(rel.fetchall(), columns)
        assert got[0] == want[0]
        assert got[1] == want[1], f"only here {list((got[1] - want[1]).items())[:3]}, only SQL {list((want[1] - got[1]).items())[:3]}"

    return run
