"""Agreement between sources on one channel, clock shifts, votes, confidence and merit.

Input rows carry an ``entry`` (what the sources are thought to have in common), ``source``, ``channel_id``, start ``s``
and stop ``e`` in epoch seconds and the normalised title ``norm``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity
from ..runtime import materialise, small
from .schedule import CLOCK, HOUR

TOLERANCE_S = 20 * 60
AGREED = 0.68
THRESHOLD = 0.55
MIN_COMPARABLE = 3
SHIFTS = (-3, 3, -1, 1, -2, 2, -4, 4)
#: Time is cut into buckets of so many seconds for the join of overlapping rows.
BUCKET_S = 2 * HOUR


def near_window(rows: DataFrame, now: int = CLOCK) -> DataFrame:
    return rows.filter((F.col("e") >= now - 6 * HOUR) & (F.col("s") <= now + 72 * HOUR))


def _title_score(a: str, b: str, exact: bool) -> Column:
    """1 where one title holds the other, else 0 or their ratio; only titles that need one are given to Python."""
    some = (F.col(a) != "") & (F.col(b) != "")
    same = some & (F.contains(F.col(a), F.col(b)) | F.contains(F.col(b), F.col(a)))
    if exact:
        return F.when(same, 1.0).otherwise(0.0)
    unlike = some & ~same
    return F.when(same, 1.0).when(unlike, similarity.ratio(F.when(unlike, F.col(a)), F.when(unlike, F.col(b)))).otherwise(0.0)


def agreements(left: DataFrame, right: DataFrame, exact: bool = True, bucket_s: int = BUCKET_S) -> DataFrame:
    """entry, a, b, shift, comparable, agreement, similarity for every ordered pair of sources of an entry.

    ``left`` has a column ``shift`` (hours) by which its times are moved. For each row of a the row of b with the best
    (time score, title score) counts; rows compare if they overlap by 35 % of the shorter or start within 20 minutes.
    The join is on entry and time bucket; a pair that meets in several buckets is taken in the first one only.
    """
    span = lambda lo, hi: F.sequence(F.expr(f"CAST(floor(({lo}) / {bucket_s}D) AS BIGINT)"), F.expr(f"CAST(floor(({hi}) / {bucket_s}D) AS BIGINT)"))
    a = left.select("entry", F.col("source").alias("a"), "shift", "row_id", (F.col("s") + F.col("shift") * HOUR).alias("s1"), (F.col("e") + F.col("shift") * HOUR).alias("e1"), F.col("norm").alias("t1"))
    a = a.withColumn("k", F.explode(span(f"s1 - {TOLERANCE_S}", f"e1 + {TOLERANCE_S}")))
    b = right.select("entry", F.col("source").alias("b"), F.col("s").alias("s2"), F.col("e").alias("e2"), F.col("norm").alias("t2")).withColumn("k", F.explode(span("s2", "e2")))
    first = F.greatest(F.expr(f"CAST(floor((s1 - {TOLERANCE_S}) / {bucket_s}D) AS BIGINT)"), F.expr(f"CAST(floor(s2 / {bucket_s}D) AS BIGINT)"))
    overlap = F.greatest(F.lit(0), F.least("e1", "e2") - F.greatest("s1", "s2"))
    shorter = F.greatest(F.lit(1), F.least(F.col("e1") - F.col("s1"), F.col("e2") - F.col("s2")))
    delta = F.abs(F.col("s2") - F.col("s1"))
    pairs = (
        a.join(b, ["entry", "k"]).filter((F.col("a") != F.col("b")) & (F.col("k") == first))
        .withColumn("o", overlap / shorter).filter((F.col("o") >= 0.35) | (delta <= TOLERANCE_S))
        .withColumn("time", F.greatest(F.col("o"), F.lit(1.0) - delta / F.lit(float(TOLERANCE_S)), F.lit(0.0)))
    )
    row = ["entry", "a", "b", "shift", "row_id"]
    if exact:  # scored where the pairs are joined: only the best per row are shuffled, in partial results
        best = pairs.withColumn("score", _title_score("t1", "t2", True)).groupBy(*row).agg(F.max(F.struct("time", "score")).alias("m")).select(*row, F.col("m.score").alias("score"))
    else:  # the title only counts among rows of the best time, so no other pair needs its ratio
        near = pairs.groupBy(*row).agg(F.max("time").alias("top"), F.first("t1").alias("t1"), F.collect_set(F.struct("time", "t2")).alias("c"))
        tops = near.select(*row, "t1", F.explode(F.filter("c", lambda x: x["time"] == F.col("top"))).alias("x")).select(*row, "t1", F.col("x.t2").alias("t2"))
        # an explicit number of partitions: pairs are few bytes but much work, which must not be coalesced into few tasks
        spark = left.sparkSession
        tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        scored = tops.repartition(tasks, "t1", "t2").withColumn("score", _title_score("t1", "t2", False))  # equal pairs meet one worker's memory
        best = scored.groupBy(*row).agg(F.max("score").alias("score"))
    return best.groupBy("entry", "a", "b", "shift").agg(
        F.count("*").alias("comparable"), F.round(F.sum(F.when(F.col("score") >= AGREED, 1).otherwise(0)) / F.count("*"), 4).alias("agreement"), F.round(F.avg("score"), 4).alias("similarity"))


def shifted(rows: DataFrame, exact: bool = True) -> DataFrame:
    """Agreement of every ordered pair, where a shift of whole hours is probed if the clocks as they are agree too little.

    The probes move b against a; the first one that reaches 0.8 counts, else the earliest of the best ones, and only one
    that is better than no shift.
    """
    base = materialise(agreements(rows.withColumn("shift", F.lit(0)), rows, exact))  # a row per pair, used three times
    weak = base.filter((F.col("comparable") >= MIN_COMPARABLE) & (F.col("agreement") < THRESHOLD)).select("entry", "a", "b")
    moved = rows.join(small(weak.select("entry", F.col("b").alias("source")).distinct()), ["entry", "source"], "left_semi")
    probes = agreements(moved.withColumn("shift", F.explode(F.array(*(F.lit(h) for h in SHIFTS)))), rows, exact)
    probes = probes.select("entry", F.col("a").alias("b"), F.col("b").alias("a"), F.col("shift").alias("h"), F.col("comparable").alias("n"), F.col("agreement").alias("g"), F.col("similarity").alias("m"))
    order = F.array_position(F.array(*(F.lit(h) for h in SHIFTS)), F.col("h"))
    usable = weak.join(probes.filter(F.col("n") >= MIN_COMPARABLE), ["entry", "a", "b"]).groupBy("entry", "a", "b").agg(
        F.min_by(F.struct("h", "n", "g", "m"), F.struct(F.when(F.col("g") >= 0.8, 0).otherwise(1), F.when(F.col("g") >= 0.8, F.lit(0.0)).otherwise(-F.col("g")), order)).alias("p"))
    j = base.join(usable, ["entry", "a", "b"], "left")
    use = F.col("p").isNotNull() & (F.col("p.g") > F.col("agreement"))
    return j.select(
        "entry", "a", "b", F.when(use, F.col("p.h")).otherwise(0).alias("shift"), F.when(use, F.col("p.n")).otherwise(F.col("comparable")).alias("comparable"),
        F.when(use, F.col("p.g")).otherwise(F.col("agreement")).alias("agreement"), F.when(use, F.col("p.m")).otherwise(F.col("similarity")).alias("similarity"))


def effective_health() -> Column:
    return F.when((F.col("score") >= 0.99) & (F.col("future_hours") >= 48), 1.0).otherwise(F.col("score"))


def evaluated(candidates: DataFrame, pairs: DataFrame, sources: DataFrame) -> DataFrame:
    """Votes, weights and confidence of each candidate (entry, source with its health columns, tier)."""
    dim = small(sources.filter("key IS NOT NULL").groupBy(F.col("key").alias("source")).agg(F.max("vote_weight").alias("weight"), F.max("family").alias("family")))
    active = candidates.select("source").distinct().join(dim, "source").agg(F.sum("weight").alias("w"))
    total = active.first()[0] or 0.0
    vote = (F.col("comparable") >= MIN_COMPARABLE) & F.col("agreement").isNotNull()
    support = vote & (F.col("agreement") >= THRESHOLD)
    votes = (
        pairs.join(dim.select(F.col("source").alias("b"), F.col("weight").alias("bw"), F.col("family").alias("bf")), "b", "left")
        .groupBy("entry", F.col("a").alias("source")).agg(
            F.count_if(vote).alias("voters"), F.coalesce(F.sum(F.when(vote, F.col("bw"))), F.lit(0.0)).alias("voted"),
            F.count_if(support).alias("supporters"), F.coalesce(F.sum(F.when(support, F.col("bw"))), F.lit(0.0)).alias("supported"),
            F.avg(F.when(support, F.col("agreement"))).alias("avg_support"), F.collect_set(F.when(support, F.col("bf"))).alias("families"))
    )
    c = candidates.join(dim, "source", "left").join(votes, ["entry", "source"], "left")
    zero = lambda x, v=0: F.coalesce(F.col(x), F.lit(v))
    c = c.withColumns({
        "support_votes": zero("supporters") + 1, "vote_sources": zero("voters") + 1,
        "vote_weight": zero("weight", 0.0) + zero("voted", 0.0), "support_weight": zero("weight", 0.0) + zero("supported", 0.0),
        "avg_support": zero("avg_support", 0.0), "eff_health": effective_health(),
        "support_families": F.size(F.array_union(F.coalesce("families", F.array().cast("array<string>")), F.array("family"))),
    })
    c = c.withColumn("weighted_ratio", F.when(F.col("vote_weight") > 0, F.col("support_weight") / F.col("vote_weight")).otherwise(0.0))
    quality = 0.40 * F.col("weighted_ratio") + 0.25 * F.col("eff_health") + 0.20 * F.col("richness") + 0.15 * F.col("avg_support")
    evidence = 0.55 + 0.45 * F.least(F.col("vote_weight") / F.lit(max(total, 0.5)), F.lit(1.0))
    return c.withColumn("confidence", F.bround(100 * F.greatest(F.lit(0.0), F.least(F.lit(1.0), quality * evidence))).cast("int")).withColumns(
        {x: F.round(x, 4) for x in ("weighted_ratio", "avg_support")})


def merit_order() -> list[Column]:
    """Rows at all, tier, healthy local source, coverage, composite merit, votes, richness, hours ahead; the source key ends ties."""
    composite = (0.38 * F.col("weighted_ratio") + 0.22 * F.col("avg_support") + 0.24 * F.col("richness") + 0.10 * F.col("eff_health") + 0.06 * F.least(F.lit(1.0), F.col("future_hours") / 48))
    return [
        F.desc(F.when(F.col("n_rows") > 0, 1).otherwise(0)), F.asc("tier"),
        F.desc(F.when((F.col("tier") == 1) & (F.col("family") == "afiliadas") & (F.col("score") >= 0.70), 1).otherwise(0)),
        F.desc(F.when((F.col("coverage") >= 0.65) & (F.col("score") >= 0.70), 1).otherwise(0)),
        F.desc(F.round(composite, 4)), F.desc("support_votes"), F.desc(F.round("richness", 3)), F.desc(F.round("future_hours", 1)), F.asc("source"),
    ]


def ranked(evaluations: DataFrame) -> DataFrame:
    """Adds ``rank`` per entry; candidates of one entry are at most as many as there are sources."""
    return evaluations.withColumn("rank", F.row_number().over(Window.partitionBy("entry").orderBy(*merit_order())))


def validation(evaluations: DataFrame) -> DataFrame:
    """Status of each entry's first candidate: ok, attention or suspect."""
    first = ranked(evaluations).filter("rank = 1")
    status = (
        F.when(F.col("score") < 0.45, "suspect").when((F.col("support_families") >= 3) & (F.col("confidence") >= 75), "ok")
        .when((F.col("confidence") >= 55) & (F.col("support_families") >= 2), "attention").otherwise("suspect")
    )
    return first.select("entry", "source", "confidence", "support_votes", "vote_sources", "support_families", status.alias("status"))


def elected(rows: DataFrame, merits: DataFrame, now: int = CLOCK, past_h: int = 6, future_h: int = 72, window_h: int = 6) -> DataFrame:
    """entry, window, source, win_score: the source of each 6-hour window, which begins ``past_h`` before now.

    rows: entry, source, s, e, norm, rich; merits: entry, source, merit. Sources that cover a quarter of the window take
    part; coverage, titles shared with other sources, richness and merit decide.
    """
    lo, hi = now - past_h * HOUR, now + future_h * HOUR
    w = window_h * HOUR
    r = rows.filter((F.col("e") > lo) & (F.col("s") < hi)).withColumn("win", F.explode(F.sequence(
        F.greatest(F.lit(0), F.floor((F.col("s") - lo) / w)), F.least(F.lit((hi - lo - 1) // w), F.floor((F.col("e") - 1 - lo) / w)))))
    begin, end = F.lit(lo) + F.col("win") * w, F.least(F.lit(lo) + (F.col("win") + 1) * w, F.lit(hi))
    r = r.withColumn("covered", F.least("e", end) - F.greatest("s", begin)).withColumn("size", end - begin)
    shared = r.filter("norm != ''").groupBy("entry", "win", "norm").agg(F.count_distinct("source").alias("n_src"))
    several = merits.groupBy("entry").agg(F.count("*").alias("n_all"))
    per = r.join(shared, ["entry", "win", "norm"], "left").groupBy("entry", "win", "source").agg(
        F.least(F.lit(1.0), F.sum("covered") / F.max("size")).alias("cov"), F.avg("rich").alias("rich"), F.avg(F.when(F.col("n_src") >= 2, 1.0).otherwise(0.0)).alias("agreed"))
    s = per.filter("cov >= 0.25").join(merits, ["entry", "source"]).join(several, "entry")
    local = F.when(F.col("n_all") > 1, F.col("agreed")).otherwise(1.0)
    score = 0.40 * F.col("cov") + 0.30 * local + 0.20 * F.col("rich") + 0.10 * F.col("merit") - F.when(F.col("cov") < 0.98, 0.65 * (1 - F.col("cov"))).otherwise(0.0)
    s = s.withColumn("win_score", F.round(score, 6))
    best = s.groupBy("entry", "win").agg(F.min_by(F.struct("source", "win_score"), F.struct(-F.col("win_score"), -F.col("merit"), F.col("source"))).alias("b"))
    return best.select("entry", F.col("win").cast("int").alias("win"), "b.*")
