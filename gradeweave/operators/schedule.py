"""Programme rows of feeds: filters, repair, stops, now and next, gaps, health.

Rows are keyed by (source, channel_id) and carry start ``s`` and stop ``e`` in epoch seconds. ``rows`` takes them from
the table; rows without a start, a source or a channel are left out, a missing stop equals the start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, titles
from . import intervals, series

KEYS = ("source", "channel_id")
TIES = ("seq", "row_id")
HOUR = 3600
#: The common clock of the test tables: 2026-11-10 12:00:00Z.
CLOCK = 1_794_312_000


def rows(programmes: DataFrame, meaningful: bool = False) -> DataFrame:
    """row_id, source, channel_id, seq, s, e, title, norm, meta; with ``meaningful`` only titles that are no placeholder."""
    r = programmes.filter("start IS NOT NULL AND source IS NOT NULL AND channel_id IS NOT NULL").select(
        "row_id", *KEYS, "seq", F.unix_seconds("start").alias("s"), F.coalesce(F.unix_seconds("stop"), F.unix_seconds("start")).alias("e"),
        "title", titles.normalise(F.col("title")).alias("norm"), "meta")
    return r.filter(titles.is_programme(F.col("norm"))) if meaningful else r


def without_self_named(r: DataFrame, channels: DataFrame, least: int = 5, share: float = 0.8) -> DataFrame:
    """Drops channels of ``least`` rows of which ``share`` are titled with a name of the channel itself."""
    own = channels.select(*KEYS, F.explode(F.concat(F.coalesce("display_names", F.array().cast("array<string>")), F.array("channel_id"))).alias("n"))
    own = own.select(*KEYS, titles.normalise(F.col("n")).alias("norm")).filter("norm != ''").distinct().withColumn("own", F.lit(1))
    counted = r.join(own, [*KEYS, "norm"], "left").groupBy(*KEYS).agg(F.count("*").alias("n"), F.count("own").alias("named"))
    bad = counted.filter((F.col("n") >= least) & (F.col("named") >= F.col("n") * share))
    return r.join(bad, list(KEYS), "left_anti")


def with_rows(r: DataFrame, least: int = 2) -> DataFrame:
    """Drops channels of fewer rows."""
    kept = r.groupBy(*KEYS).agg(F.count("*").alias("n")).filter(F.col("n") >= least).select(*KEYS)
    return r.join(kept, list(KEYS), "left_semi")


def in_window(r: DataFrame, now: int = CLOCK, past_h: int = 6, future_h: int = 72) -> DataFrame:
    return r.filter((F.col("e") > now - past_h * HOUR) & (F.col("s") < now + future_h * HOUR))


def repaired(r: DataFrame) -> DataFrame:
    """Stops set right in the order of starts: none or inverted, over the next start, over 8 hours; rows that end up empty go."""
    n = series.with_next(r, KEYS, "s", TIES, "nxt")
    s, e, nxt = F.col("s"), F.col("e"), F.col("nxt")
    one = (
        F.when(e <= s, F.when(nxt > s, F.least(nxt, s + 3 * HOUR)).otherwise(s + 45 * 60))
        .when(e > nxt, nxt).otherwise(e)
    )
    two = F.when(F.col("e1") - s > 8 * HOUR, F.when((nxt > s) & (nxt - s <= 4 * HOUR), nxt).otherwise(s + 2 * HOUR)).otherwise(F.col("e1"))
    return n.withColumn("e1", one).withColumn("e", two).drop("e1", "nxt").filter("e > s")


def one_per_start(r: DataFrame, keep: str = "first") -> DataFrame:
    """One row for each start of a channel: the first or the last one in the feed."""
    order = F.struct(*TIES)
    whole = F.struct(*(c for c in r.columns if c not in (*KEYS, "s")))
    pick = F.min_by(whole, order) if keep == "first" else F.max_by(whole, order)
    return r.groupBy(*KEYS, "s").agg(pick.alias("r")).select(*KEYS, "s", "r.*")


def inferred_stops(r: DataFrame, rule: str) -> DataFrame:
    """``e`` from the next start. 'cap6': next start up to 6 hours, else 2 hours, last row 1 hour; 'cap4': the earlier of next
    start and 4 hours, last row 1 hour; 'clip': only stops beyond the next start are cut."""
    n = series.with_next(r, KEYS, "s", TIES, "nxt")
    s, e, nxt = F.col("s"), F.col("e"), F.col("nxt")
    stop = {
        "cap6": F.when(nxt.isNull(), s + HOUR).when(nxt - s > 6 * HOUR, s + 2 * HOUR).otherwise(nxt),
        "cap4": F.when(nxt.isNull(), s + HOUR).otherwise(F.least(nxt, s + 4 * HOUR)),
        "clip": F.when(e > nxt, nxt).otherwise(e),
    }[rule]
    return n.withColumn("e", stop).drop("nxt")


def final_clip(r: DataFrame) -> DataFrame:
    """Stops cut at the next start, breaks of up to 5 minutes closed, rows under a minute dropped."""
    n = series.with_next(r, KEYS, "s", TIES, "nxt")
    e, nxt = F.col("e"), F.col("nxt")
    return n.withColumn("e", F.when((e > nxt) | ((nxt > e) & (nxt - e <= 300)), nxt).otherwise(e)).drop("nxt").filter("e - s >= 60")


def now_next(r: DataFrame, now: int = CLOCK, first_current: bool = False) -> DataFrame:
    """Per channel the row on air, the last one by start (or the first), and the next one."""
    order = F.struct("s", *TIES)
    on_air, ahead = (F.col("s") <= now) & (F.col("e") > now), F.col("s") > now
    pick = F.min_by if first_current else F.max_by
    row = F.struct("row_id", "s", "e", "title")
    return r.groupBy(*KEYS).agg(pick(row, F.when(on_air, order)).alias("c"), F.min_by(row, F.when(ahead, order)).alias("n")).select(
        *KEYS, *(F.col(f"{a}.{f}").alias(f"{b}_{f}") for a, b in (("c", "now"), ("n", "next")) for f in ("row_id", "s", "e", "title")))


def breaks(r: DataFrame, gap_s: int = 120, overlap_s: int = 120) -> DataFrame:
    """Per row with a break before the next one: kind 'gap' or 'overlap' and its seconds."""
    n = series.with_next(r, KEYS, "s", TIES, "nxt").withColumn("d", F.col("nxt") - F.col("e"))
    kind = F.when(F.col("d") > gap_s, "gap").when(F.col("d") < -overlap_s, "overlap")
    return n.withColumn("kind", kind).filter("kind IS NOT NULL").select(*KEYS, "row_id", "kind", F.col("e").alias("from_s"), F.col("nxt").alias("to_s"), F.abs("d").alias("seconds"))


def running_breaks(r: DataFrame, now: int = CLOCK, hours: int = 36, bucket_s: int = 6 * HOUR) -> DataFrame:
    """Rows near now that start over 5 minutes after, or over a minute before, the latest stop of all rows before them."""
    near = r.filter((F.col("e") > now) & (F.col("s") < now + hours * HOUR) & (F.col("e") > F.col("s")))
    f = intervals.flagged(near.select(*KEYS, F.timestamp_seconds("s").alias("a"), F.timestamp_seconds("e").alias("b")), KEYS, "a", "b", bucket_s)
    d = F.expr("(s - p) div 1000000")
    kind = F.when(d > 300, "gap").when(d < -60, "overlap")
    return f.withColumn("d", d).withColumn("kind", kind).filter("kind IS NOT NULL").select(
        F.col("k0").alias(KEYS[0]), F.col("k1").alias(KEYS[1]), F.expr("s div 1000000").alias("s"), "kind", F.abs("d").alias("seconds"))


def rollover(r: DataFrame, value: str = "minute", back: int = 240) -> DataFrame:
    """Adds ``day``: how often the clock time went back by over ``back`` minutes up to this row of the feed."""
    n = series.with_previous(r, KEYS, "seq", ("row_id",), value, "before", 1000)
    n = n.withColumn("turn", F.when(F.col("before") - F.col(value) > back, 1).otherwise(0))
    return series.with_running_sum(n, KEYS, "seq", ("row_id",), "turn", "day", 1000).drop("before", "turn")


def richness(meta: str = "meta") -> Column:
    m = lambda f: F.col(f"{meta}.{f}")
    return titles.richness(m("desc"), m("sub_title"), m("season"), m("episode"), m("rating_badge"), m("categories"))


def health(r: DataFrame, now: int = CLOCK, sample: int = 35) -> DataFrame:
    """Per channel: row count, coverage of the next day, hours ahead, breaks, richness of the next rows, and the score."""
    s, e = F.col("s"), F.col("e")
    near = (e > now) & (s < now + 24 * HOUR)
    covered = F.greatest(F.lit(0), F.least(F.lit(now + 24 * HOUR), e) - F.greatest(F.lit(now), s))
    base = r.groupBy(*KEYS).agg(
        F.count("*").alias("n_rows"), F.max(F.when((s <= now) & (e > now), 1).otherwise(0)).alias("has_now"), F.max(F.when(s > now, 1).otherwise(0)).alias("has_next"),
        F.least(F.lit(1.0), F.coalesce(F.sum(F.when(near, covered)), F.lit(0)) / F.lit(86400.0)).alias("coverage"),
        F.greatest(F.lit(0.0), F.coalesce(F.max(F.when(e > now, e)) - now, F.lit(0)) / F.lit(3600.0)).alias("ahead"),
        F.sum(F.when((e > now) & (s < now + 36 * HOUR) & ((e <= s) | (e - s > 12 * HOUR)), 1).otherwise(0)).alias("invalid"),
    )
    b = running_breaks(r, now).groupBy(*KEYS).agg(
        F.count_if(F.col("kind") == "overlap").alias("n_overlaps"), F.count_if(F.col("kind") == "gap").alias("n_gaps"),
        F.sum(F.when(F.col("kind") == "gap", F.col("seconds")).otherwise(0)).alias("gap_s"))
    # the first rows near now, or the first rows of all where none is near
    order = Window.partitionBy(*KEYS).orderBy(F.when(near, 0).otherwise(1), "s", *TIES)
    first = r.withColumn("near", F.when(near, 1).otherwise(0)).withColumn("k", F.row_number().over(order)).filter(F.col("k") <= sample)
    rich = first.groupBy(*KEYS).agg(F.max("near").alias("any"), F.avg(F.when(F.col("near") == 1, richness())).alias("a"), F.avg(richness()).alias("b"))
    rich = rich.select(*KEYS, F.round(F.when(F.col("any") == 1, F.col("a")).otherwise(F.col("b")), 4).alias("richness"))
    j = base.join(b, list(KEYS), "left").join(rich, list(KEYS), "left").fillna(0, ["n_overlaps", "n_gaps", "gap_s"])
    raw = (
        F.lit(0.25) * F.col("has_now") + F.lit(0.10) * F.col("has_next") + F.lit(0.35) * F.col("coverage") + F.lit(0.20) * F.least(F.col("ahead") / 20, F.lit(1.0))
        + F.lit(0.10) * F.least(F.col("n_rows") / F.lit(12.0), F.lit(1.0))
        - F.least(F.lit(0.50), F.col("invalid") * 0.08 + F.col("n_overlaps") * 0.02 + F.least(F.lit(0.45), F.col("n_gaps") * 0.12 + F.col("gap_s") / F.lit(3600.0) * 0.08))
    )
    capped = F.when((F.col("n_gaps") > 0) | (F.col("coverage") < 0.96), F.least(raw, F.lit(0.85))).otherwise(raw)
    capped = F.when(F.col("ahead") < 8, F.least(capped, F.lit(0.35))).otherwise(capped)
    return j.select(
        *KEYS, "n_rows", "has_now", "has_next", F.round("coverage", 4).alias("coverage"), F.round("ahead", 1).alias("future_hours"), "invalid", "n_overlaps", "n_gaps", "richness",
        F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), capped)), 4).alias("score"))


def same_channel_key(c: Column) -> Column:
    """Identifiers of feeds that name one channel alike."""
    return names.id_key(c)
