"""Neighbours and running sums in ordered series, without ordering any series in one task.

Series are cut into buckets; what a bucket needs from its neighbours is found on one row per bucket and joins the
bucket as a sentinel row. So a series that holds a third of all rows is spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(at: str, width: int) -> Column:
    return F.expr(f"CAST(floor(`{at}` / {width}D) AS BIGINT)")


def with_next(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str], out: str, width: int = 86_400) -> DataFrame:
    """Adds ``out``: the next row's ``at`` (BIGINT, not NULL) in the order of ``at`` and ``ties``; NULL for the last row."""
    rows = df.withColumn("_b", _bucket(at, width)).withColumn("_sentinel", F.lit(0))
    after = Window.partitionBy(*keys).orderBy("_b")
    borders = (
        rows.groupBy(*keys, "_b").agg(F.min(at).alias("_first")).withColumn(at, F.lead("_first").over(after))
        .filter(F.col(at).isNotNull()).drop("_first").withColumn("_sentinel", F.lit(1))
    )
    inside = Window.partitionBy(*keys, "_b").orderBy("_sentinel", at, *ties)
    both = rows.unionByName(borders, allowMissingColumns=True)
    return both.withColumn(out, F.lead(at).over(inside)).filter("_sentinel = 0").drop("_b", "_sentinel")


def with_previous(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str], value: str, out: str, width: int) -> DataFrame:
    """Adds ``out``: ``value`` of the row before in the order of ``at`` and ``ties``."""
    rows = df.withColumn("_b", _bucket(at, width)).withColumn("_sentinel", F.lit(1))
    order = F.struct(at, *ties)
    before = Window.partitionBy(*keys).orderBy("_b")
    borders = (
        rows.groupBy(*keys, "_b").agg(F.max_by(value, order).alias("_last")).withColumn(value, F.lag("_last").over(before))
        .filter(F.col(value).isNotNull()).drop("_last").withColumn("_sentinel", F.lit(0))
    )
    inside = Window.partitionBy(*keys, "_b").orderBy("_sentinel", at, *ties)
    both = rows.unionByName(borders, allowMissingColumns=True)
    return both.withColumn(out, F.lag(value).over(inside)).filter("_sentinel = 1").drop("_b", "_sentinel")


def with_running_sum(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str], value: str, out: str, width: int) -> DataFrame:
    """Adds ``out``: the sum of ``value`` up to and with this row."""
    rows = df.withColumn("_b", _bucket(at, width)).withColumn("_sentinel", F.lit(1))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    borders = (
        rows.groupBy(*keys, "_b").agg(F.sum(value).alias("_sum")).withColumn(value, F.sum("_sum").over(before))
        .filter(F.col(value).isNotNull()).drop("_sum").withColumn("_sentinel", F.lit(0))
    )
    inside = Window.partitionBy(*keys, "_b").orderBy("_sentinel", at, *ties).rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(borders, allowMissingColumns=True)
    return both.withColumn(out, F.sum(value).over(inside)).filter("_sentinel = 1").drop("_b", "_sentinel")
