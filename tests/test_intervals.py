"""Periods and gaps against a brute-force version on small and random intervals."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeweave.operators import intervals

SHAPE = "source string, channel_id string, start timestamp, stop timestamp"


def frame(spark, rows):
    df = spark.createDataFrame([(a, b, s, e) for a, b, s, e in rows], "source string, channel_id string, s bigint, e bigint")
    return df.select("source", "channel_id", F.timestamp_seconds("s").alias("start"), F.timestamp_seconds("e").alias("stop"))


def brute(rows, most=864_000):
    """Gaps and periods second by second borders."""
    gaps, periods = set(), set()
    for key in {(a, b) for a, b, _, _ in rows}:
        spans = sorted((s, e) for a, b, s, e in rows if (a, b) == key and s is not None and e is not None and e > s)
        merged = []
        for s, e in spans:
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        periods |= {(*key, s, e) for s, e in merged}
        gaps |= {(*key, a[1], b[0]) for a, b in zip(merged, merged[1:]) if b[0] - a[1] < most}
    return gaps, periods


def check(spark, rows, bucket):
    df = frame(spark, rows)
    gaps, periods = brute(rows)
    assert sorted(map(tuple, intervals.gaps(df, ("source", "channel_id"), bucket_s=bucket).collect()), key=str) == sorted(gaps, key=str)
    assert sorted((tuple(r)[:4] for r in intervals.periods(df, ("source", "channel_id"), bucket_s=bucket).collect()), key=str) == sorted(periods, key=str)


def test_edges(spark):
    day = 86_400
    check(spark, [
        ("a", "x", 0, 10), ("a", "x", 10, 20), ("a", "x", 21, 30), ("a", "x", 21, 30), ("a", "x", 5, None), ("a", "x", None, 7), ("a", "x", 40, 40), ("a", "x", 50, 45),
        ("a", "y", 0, 5 * day), ("a", "y", day, day + 1), ("a", "y", 5 * day + 1, 6 * day), ("a", "z", 0, 1), ("a", "z", 10 * day + 1, 10 * day + 2), ("a", "w", 0, 1), ("a", "w", 10 * day, 10 * day + 2),
        (None, "x", 0, 1), (None, "x", 3, 4), (None, None, 0, 1), (None, None, 2, 3), ("a", "v", -5, -3), ("a", "v", -1, 2),
    ], day)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("xy"), st.integers(0, 400), st.integers(-10, 120)), min_size=1, max_size=60), st.sampled_from([7, 50, 1000]))
def test_random(spark, rows, bucket):
    check(spark, [(a, b, s, s + n) for a, b, s, n in rows], bucket)


def test_empty_and_clashing_columns(spark):
    df = frame(spark, []).withColumns({c: F.lit(1) for c in ("k0", "b", "s", "e", "p", "m", "island")})
    assert intervals.gaps(df, ("source", "channel_id")).count() == 0
    assert intervals.periods(df, ("source", "channel_id")).count() == 0
    df = frame(spark, [("a", "x", 0, 5), ("a", "x", 7, 9)]).withColumns({c: F.lit(1) for c in ("k0", "b", "s", "e", "p", "m", "island")})
    assert [tuple(r) for r in intervals.gaps(df, ("source", "channel_id")).collect()] == [("a", "x", 5, 7)]


def test_hot_key_is_spread(spark):
    rows = [("a", "x", 100 * i, 100 * i + 50) for i in range(3000)]
    df = frame(spark, rows)
    assert intervals.gaps(df, ("source", "channel_id"), bucket_s=10_000).count() == 2999
    assert intervals.periods(df, ("source", "channel_id"), bucket_s=10_000).count() == 3000
