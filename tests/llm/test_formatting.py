import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from gradeweave.llm import formatting

SHAPE = "rec_id bigint, entry_key string, name string, aliases array<string>"


def canon(s):
    return None if s is None else "".join(c for c in s.lower() if c.isalnum())


def brute(rows):
    groups = defaultdict(set)
    for r, _, n, a in rows:
        if r is not None:
            groups[(canon(n), tuple(sorted((canon(x) or ("\1" if x is None else "")) for x in (a or []))))].add(r)
    return groups


def check(spark, rows, **extra):
    df = spark.createDataFrame(rows, SHAPE).repartition(5)
    if extra:
        df = df.withColumns({c: F.lit(v) for c, v in extra.items()})
    groups = brute(rows)
    assert sorted(map(tuple, formatting.copies(df).collect())) == sorted((min(g), r) for g in groups.values() for r in g if r != min(g))
    assert sorted((r.first_id, r.n_copies) for r in formatting.collapsed(df).collect()) == sorted((min(g), len(g)) for g in groups.values())


def test_edges(spark):
    check(spark, [
        (1, "a", "Canal Um", ["A b", "C"]), (2, None, ' "CANAL-um"*', ["c.", "a\tB"]), (3, None, "Canal Um", ["A b"]), (4, None, "Canal Úm", ["A b", "C"]), (5, None, None, None), (6, None, None, []), (7, None, "", []),
        (8, None, "x", [None]), (9, None, "x", [""]), (10, None, "X", [None]), (11, None, "y", ["a", "a"]), (12, None, "y", ["a"]), (12, None, "y", ["A"]), (13, None, "z" * 300_000, ["q"]), (14, None, "Z" * 300_000, ["Q "]), (None, None, "x", [None]),
    ])


def test_random_and_hot(spark):
    random.seed(1)
    rows = [(i, None, random.choice(["Canal um", "canal  UM", "Rede-2", "rede 2"]) if i % 3 else "HOT", random.sample(["a", "b", "C!"], random.randint(0, 3))) for i in range(900)]
    rows += [(1000 + i, None, f"single {i}", ["x"]) for i in range(500)]
    check(spark, rows, canon="x", maybe=1, n=1, id=5, first_id=7)


def test_empty(spark):
    df = spark.createDataFrame([], SHAPE)
    assert formatting.copies(df).count() == 0 and formatting.collapsed(df).count() == 0


def test_filter_has_no_false_negatives():
    import pandas as pd

    rng = np.random.default_rng(0)
    h = rng.integers(-(2**63), 2**63 - 1, 20_000)
    h[:4000] = h[4000:8000]
    rng.shuffle(h)
    parts = [pd.DataFrame(next(formatting._partition_filters(iter([pd.DataFrame({"part": 0, "h": x})]), 1 << 19))) for x in np.array_split(h, 7)]
    words = np.zeros((1 << 19) // 8, np.uint8)
    import zlib

    for chunk, p in pd.concat(parts).groupby("chunk"):
        got = np.frombuffer(zlib.decompress(formatting._merge(p)["again"].iloc[0]), np.uint8)
        words[chunk * formatting.CHUNK:chunk * formatting.CHUNK + len(got)] = got
    u, n = np.unique(h, return_counts=True)
    held = formatting._holds(words, formatting._slots(u, 1 << 19))
    assert held[n > 1].all() and held[n == 1].mean() < 0.05


def test_many_ranges(spark, monkeypatch):
    """More records than one filter holds: ranges with a filter each, the same result, and filters that do not saturate."""
    monkeypatch.setattr(formatting, "MIN_BITS", 1 << 9)
    monkeypatch.setattr(formatting, "MAX_BITS", 1 << 12)
    random.seed(2)
    rows = [(i, None, f"Canal {random.randrange(1500)}", ["x"]) for i in range(2000)]
    assert formatting._layout(len(rows))[1] == 8
    check(spark, rows)
    single = [(i, None, f"Canal {i}", None) for i in range(2000)]
    maybe, _ = formatting.split(spark.createDataFrame(single, SHAPE).repartition(5))
    assert maybe.filter("maybe").count() < 200
