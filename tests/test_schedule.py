"""Repair, neighbours, clipping, stitching and filling on small schedules."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gradeweave.operators import fuse, series
from gradeweave.operators import schedule as S


def frame(spark, rows):
    """rows: (s, e) of one channel in feed order."""
    return spark.createDataFrame([(i, "a", "x", i, s, e, f"T{i}", f"TITLE {i}") for i, (s, e) in enumerate(rows)], "row_id bigint, source string, channel_id string, seq bigint, s bigint, e bigint, title string, norm string")


M, H = 60, 3600


@pytest.mark.parametrize("rows, want", [
    ([(0, 0), (H, 2 * H)], [(0, H), (H, 2 * H)]),  # no stop: up to the next start
    ([(0, 0), (5 * H, 6 * H)], [(0, 3 * H), (5 * H, 6 * H)]),  # at most three hours
    ([(0, -5)], [(0, 45 * M)]),  # inverted, nothing follows
    ([(0, 2 * H), (H, 3 * H)], [(0, H), (H, 3 * H)]),  # over the next start
    ([(0, 9 * H)], [(0, 2 * H)]), ([(0, 13 * H), (12 * H, 13 * H)], [(0, 2 * H), (12 * H, 13 * H)]),
    ([(0, H), (0, H), (H, 2 * H)], [(0, H), (H, 2 * H)]),  # equal starts: the earlier one ends up empty
])
def test_repair(spark, rows, want):
    assert sorted((r.s, r.e) for r in S.repaired(frame(spark, rows)).collect()) == want


def test_repair_is_idempotent(spark):
    rows = [(i * 1700 % 50_000, (i * 1700 % 50_000) + (i * 977 % 9000) - 1000) for i in range(200)]
    once = S.repaired(frame(spark, rows)).select("row_id", "source", "channel_id", "seq", "s", "e", "title", "norm").cache()
    key = lambda df: sorted((r.row_id, r.s, r.e) for r in df.collect())
    assert key(once) == key(S.repaired(once))


def test_neighbours_over_buckets(spark):
    rows = [(i * 37 % 1000, 0) for i in range(300)]
    df = frame(spark, rows)
    for width in (10, 100, 10_000):
        got = {r.row_id: r.nxt for r in series.with_next(df, S.KEYS, "s", S.TIES, "nxt", width).collect()}
        order = sorted(range(len(rows)), key=lambda i: (rows[i][0], i))
        assert got == {i: rows[j][0] for i, j in zip(order, order[1:])} | {order[-1]: None}
        sums = {r.row_id: r.t for r in series.with_running_sum(df, S.KEYS, "seq", ("row_id",), "s", "t", width).collect()}
        total, want = 0, {}
        for i, (s, _) in enumerate(rows):
            total += s
            want[i] = total
        assert sums == want
        before = {r.row_id: r.p for r in series.with_previous(df, S.KEYS, "seq", ("row_id",), "s", "p", width).collect()}
        assert before == {i: (rows[i - 1][0] if i else None) for i in range(len(rows))}


def test_final_clip(spark):
    rows = [(0, 100), (90, 200), (200 + 5 * M, 1000), (1000 + 6 * M, 1000 + 6 * M + 59)]
    assert [(r.s, r.e) for r in S.final_clip(frame(spark, rows)).orderBy("s").collect()] == [(0, 90), (90, 500), (500, 1000)]


LINE = "entry string, source string, row_id bigint, s bigint, e bigint, norm string, title string"


def random_entries(n, seed):
    """Winners and all rows of several sources, of n entries."""
    rng = random.Random(seed)
    winners, rows = [], []
    for k in range(n):
        for i in range(rng.randrange(1, 25)):
            s = rng.randrange(0, 600) * 60
            r = (f"x{k}", rng.choice("abc"), 1000 * k + i, s, s + rng.randrange(0, 150) * 60, f"T{rng.randrange(5)}", "t")
            rows.append((*r, {"a": 0.9, "b": 0.5, "c": 0.5}[r[1]]))
            if r[1] == "a" and r[4] > r[3]:
                winners.append(r)
    return winners, rows


def test_timeline_never_overlaps(spark):
    winners, rows = random_entries(60, 1)
    line = fuse.in_line(spark.createDataFrame(winners, LINE))
    got = fuse.closed(fuse.filled(line, spark.createDataFrame(rows, LINE + ", merit double"))).toPandas().sort_values(["entry", "s"])
    assert (got["e"] - got["s"] >= 60).all() and set(got["kind"]) == {"window", "fill"}
    ends = got.groupby("entry")["e"].transform(lambda e: e.cummax().shift())
    assert not (got["s"] < ends).any()


def test_gaps_against_brute_force(spark):
    """Minute by minute: free time goes to the best row, and from parts that are too short to the rows after them."""
    winners, rows = random_entries(40, 2)
    line = [tuple(r) for r in fuse.in_line(spark.createDataFrame(winners, LINE)).collect()]
    want = set()
    for x in {r[0] for r in rows}:
        taken = {m for r in line if r[0] == x for m in range(r[3] // 60, -(-r[4] // 60))}
        mine = sorted({r for r in rows if r[0] == x and r[4] - r[3] >= fuse.MIN_S}, key=lambda r: (-r[7], r[1], r[3], r[2]))
        claims = {m: [r for r in mine if r[3] <= m * 60 < r[4]] for m in range(800) if m not in taken}
        while True:
            won = {m: c[0] for m, c in claims.items() if c}
            parts, at = [], None
            for m in sorted(won):
                if parts and at == m - 1 and parts[-1][0] == won[m]:
                    parts[-1][1].append(m)
                else:
                    parts.append((won[m], [m]))
                at = m
            # parts of one row count as one where only other rows' claims of no length lie between
            short = [(r, ms) for r, ms in parts if not (60 * len(ms) >= fuse.CLAMP_S or (60 * len(ms) >= fuse.MIN_S and 60 * len(ms) >= fuse.LEAST_SHARE * (r[4] - r[3])))]
            if not short:
                break
            for r, ms in short:
                for m in ms:
                    claims[m].remove(r)
        want |= {(x, r[2], ms[0] * 60, ms[-1] * 60 + 60) for r, ms in parts}
    got = fuse.filled(spark.createDataFrame(line, LINE), spark.createDataFrame(rows, LINE + ", merit double")).filter("kind = 'fill'")
    assert {(r.entry, r.row_id, r.s, r.e) for r in got.collect()} == want


def test_verified_source_fills_the_gap(spark):
    line = spark.createDataFrame([("x", "a", 1, 0, H, "JORNAL", ""), ("x", "a", 2, 2 * H, 3 * H, "NOVELA", "")], LINE)
    spare = spark.createDataFrame([("x", "b", 3, H, 2 * H, "BOLETIM", "", 0.5), ("x", "b", 4, 2 * H, 3 * H, "OUTRA", "", 0.5)], LINE + ", merit double")
    got = fuse.closed(fuse.filled(fuse.in_line(line), spare)).orderBy("s").collect()
    assert [(r.norm, r.kind) for r in got] == [("JORNAL", "window"), ("BOLETIM", "fill"), ("NOVELA", "window")]


def test_winners_in_line(spark):
    m = 60
    cases = {
        "later cuts": ([(0, 60, "A"), (30, 90, "B")], [(0, 30, "A"), (30, 90, "B")]), "same moment": ([(0, 60, "A"), (4, 90, "B")], [(0, 60, "A"), (60, 90, "B")]),
        "same title": ([(0, 60, "A"), (20, 80, "A"), (80, 90, "B")], [(0, 80, "A"), (80, 90, "B")]), "nested": ([(0, 60, "A"), (20, 40, "B")], [(0, 20, "A"), (20, 40, "B")]), "short rest": ([(0, 60, "A"), (59, 61, "A2"), (1, 61, "B")], [(0, 59, "A"), (59, 61, "A2")]),
    }
    rows = [(x, "a", i, s * m, e * m, n, n) for x, (given, _) in cases.items() for i, (s, e, n) in enumerate(given)]
    got = fuse.in_line(spark.createDataFrame(rows, LINE)).collect()
    for x, (_, want) in cases.items():
        assert sorted((r.s // m, r.e // m, r.norm) for r in got if r.entry == x) == want, x
