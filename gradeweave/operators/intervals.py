"""Continuous periods and gaps of overlapping, nested and gapped intervals (problem 3).

The running maximum of previous ends is computed in time buckets, so no key is ever ordered in one task: a first pass
keeps the latest end of each (key, bucket), a window over those few rows turns them into the end carried into each
bucket, and the carried end then takes part in the bucket's own running maximum as its first row.

Defined results: rows with a NULL start or stop, or stop <= start, cover nothing; NULL keys form a group of their own;
touching intervals leave no gap; repeated rows and ties change nothing; an empty table gives an empty result; columns
beyond those named are ignored, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
BUCKET_S = 86_400
TEN_DAYS_S = 864_000


def flagged(df: DataFrame, keys: Sequence[str], start: str, stop: str, bucket_s: int) -> DataFrame:
    """k0.. (keys), b (bucket), s, e in microseconds, p (latest end of all rows before; NULL for the first)."""
    ks = [f"k{i}" for i in range(len(keys))]
    rows = df.select(
        *(F.col(k).alias(a) for k, a in zip(keys, ks)),
        F.unix_micros(F.col(start).cast("timestamp")).alias("s"), F.unix_micros(F.col(stop).cast("timestamp")).alias("e"),
    ).filter("e > s").withColumn("b", F.expr(f"CAST(floor(s / {bucket_s * MICROS}D) AS BIGINT)"))
    before = Window.partitionBy(*ks).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(*ks, "b").agg(F.max("e").alias("m"))
        .withColumn("e", F.max("m").over(before)).filter("e IS NOT NULL")
        .select(*ks, F.lit(None).cast("bigint").alias("s"), "e", "b")
    )
    inside = Window.partitionBy(*ks, "b").orderBy(F.asc_nulls_first("s"), "e").rowsBetween(Window.unboundedPreceding, -1)
    return rows.unionByName(carried).withColumn("p", F.max("e").over(inside)).filter("s IS NOT NULL")


def gaps(df: DataFrame, keys: Sequence[str], start: str = "start", stop: str = "stop",
         max_gap_s: int | None = TEN_DAYS_S, bucket_s: int = BUCKET_S) -> DataFrame:
    """Each uncovered stretch between covered times of one key: keys, gap_start_s, gap_stop_s (epoch seconds)."""
    g = flagged(df, keys, start, stop, bucket_s).filter("s > p")
    if max_gap_s is not None:
        g = g.filter(F.col("s") - F.col("p") < max_gap_s * MICROS)
    return g.select(
        *(F.col(f"k{i}").alias(k) for i, k in enumerate(keys)),
        F.expr(f"p div {MICROS}").alias("gap_start_s"), F.expr(f"s div {MICROS}").alias("gap_stop_s"),
    )


def periods(df: DataFrame, keys: Sequence[str], start: str = "start", stop: str = "stop", bucket_s: int = BUCKET_S) -> DataFrame:
    """Continuous covered periods: keys, period_start_s, period_stop_s, n_rows.

    A period that runs over a bucket's border ends with the pieces that its follow-up buckets hold before their first
    new period; those pieces are found on one row per bucket.
    """
    ks = [f"k{i}" for i in range(len(keys))]
    inside = Window.partitionBy(*ks, "b").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0)
    pieces = (
        flagged(df, keys, start, stop, bucket_s)
        .withColumn("island", F.sum(F.when(F.col("p").isNull() | (F.col("s") > F.col("p")), 1).otherwise(0)).over(inside))
        .groupBy(*ks, "b", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"))
    )
    by_bucket = pieces.groupBy(*ks, "b").agg(
        F.max("island").alias("last"), F.max(F.when(F.col("island") == 0, F.col("e"))).alias("e0"),
        F.max(F.when(F.col("island") == 0, F.col("n"))).alias("n0"))
    order = Window.partitionBy(*ks).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.max(F.when(F.col("last") > 0, F.struct("b", "last"))).over(order)
    tails = (
        by_bucket.withColumn("own", owner).filter("e0 IS NOT NULL")
        .select(*ks, F.col("own.b").alias("b"), F.col("own.last").alias("island"), F.lit(None).cast("bigint").alias("s"), F.col("e0").alias("e"), F.col("n0").alias("n"))
    )
    whole = pieces.filter("island > 0").unionByName(tails).groupBy(*ks, "b", "island").agg(
        F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n"))
    return whole.select(
        *(F.col(a).alias(k) for a, k in zip(ks, keys)),
        F.expr(f"s div {MICROS}").alias("period_start_s"), F.expr(f"e div {MICROS}").alias("period_stop_s"), F.col("n").alias("n_rows"),
    )
