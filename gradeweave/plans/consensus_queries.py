"""Agreement, shifts, votes, merit and the election of windows, over channels that several sources share."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import consensus as C
from ..operators import fuse
from ..operators import schedule as S
from ..runtime import load, materialise
from .schedule_queries import HEALTH, NOW, REPAIRED, _RICH, fixed

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def entries(spark, sf_dir):
    """Repaired rows; the entry is the channel's identifier without prefix, domain and marks."""
    return fixed(spark, sf_dir).withColumn("entry", S.same_channel_key(F.col("channel_id")))


_ENTRY = "regexp_replace(regexp_replace(regexp_replace(lower(channel_id), '\\.(?:br|us|uk|pt|ar|mx|cl|co|pe|ca|latam|int|bt)$', '', 'g'), '^(?:auto|yt|br|canais)\\.', '', 'g'), '[^a-z0-9]', '', 'g')"
_NEAR = f"{{0}}, x AS (SELECT *, {_ENTRY} AS entry FROM f), nr AS (SELECT * FROM x WHERE e >= {NOW} - 21600 AND s <= {NOW} + 259200)"


def _agree(name: str, left: str, shift: str) -> str:
    return f"""{name}_p AS (SELECT a.entry, a.source AS a, b.source AS b, {shift} AS shift, a.row_id, a.norm AS t1, b.norm AS t2,
  greatest(0, least(a.e + {shift} * 3600, b.e) - greatest(a.s + {shift} * 3600, b.s)) / greatest(1, least(a.e - a.s, b.e - b.s))::DOUBLE AS o, abs(b.s - a.s - {shift} * 3600) AS d FROM {left} JOIN nr b ON a.entry = b.entry AND a.source != b.source
  WHERE b.s <= a.e + {shift} * 3600 + 1200 AND b.e >= a.s + {shift} * 3600 - 1200),
{name}_q AS (SELECT *, greatest(o, 1.0::DOUBLE - d / 1200.0::DOUBLE, 0.0::DOUBLE) AS ts, CASE WHEN t1 != '' AND t2 != '' AND (contains(t1, t2) OR contains(t2, t1)) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS sc FROM {name}_p WHERE o >= 0.35 OR d <= 1200),
{name}_b AS (SELECT entry, a, b, shift, row_id, arg_max(sc, (ts, sc)) AS sc FROM {name}_q GROUP BY ALL),
{name} AS (SELECT entry, a, b, shift, count(*) AS comparable, round(count(*) FILTER (sc >= 0.68) / count(*), 4) AS agreement, round(avg(sc), 4) AS similarity FROM {name}_b GROUP BY ALL)"""


_PAIRS = f"{_NEAR.format(REPAIRED)}, {_agree('ag', 'nr a', '0')}"


@query(f"{_PAIRS} SELECT entry, a, b, comparable, agreement, similarity FROM ag")
def pair_agreement(spark, sf_dir):
    r = C.near_window(entries(spark, sf_dir))
    return C.agreements(r.withColumn("shift", F.lit(0)), r).drop("shift")


@query()
def pair_agreement_ratio(spark, sf_dir):
    r = C.near_window(entries(spark, sf_dir))
    return C.agreements(r.withColumn("shift", F.lit(0)), r, exact=False).drop("shift")


_SHIFTED = f"""wk AS (SELECT entry, a, b FROM ag WHERE comparable >= 3 AND agreement < 0.55),
ls AS (SELECT h, k FROM (VALUES {", ".join(f"({h}, {i})" for i, h in enumerate(C.SHIFTS))}) v(h, k)),
{_agree('pr', '(SELECT nr.*, h FROM nr, ls) a', 'a.h')},
us AS (SELECT wk.*, h, k, pr.comparable AS n, pr.agreement AS g, pr.similarity AS m FROM wk JOIN pr ON pr.entry = wk.entry AND pr.a = wk.b AND pr.b = wk.a JOIN ls ON ls.h = pr.shift WHERE pr.comparable >= 3),
be AS (SELECT entry, a, b, arg_min({{'h': h, 'n': n, 'g': g, 'm': m}}, (CASE WHEN g >= 0.8 THEN 0 ELSE 1 END, CASE WHEN g >= 0.8 THEN 0.0 ELSE -g END, k)) AS p FROM us GROUP BY ALL),
sh AS (SELECT entry, a, b, CASE WHEN p.g > agreement THEN p.h ELSE 0 END AS shift, CASE WHEN p.g > agreement THEN p.n ELSE comparable END AS comparable, CASE WHEN p.g > agreement THEN p.g ELSE agreement END AS agreement,
 CASE WHEN p.g > agreement THEN p.m ELSE similarity END AS similarity FROM ag LEFT JOIN be USING (entry, a, b))"""


@query(f"{_PAIRS}, {_SHIFTED} SELECT * FROM sh")
def shift_detection(spark, sf_dir):
    return C.shifted(materialise(C.near_window(entries(spark, sf_dir))))


@query()
def shift_detection_ratio(spark, sf_dir):
    return C.shifted(materialise(C.near_window(entries(spark, sf_dir))), exact=False)


def _candidates(spark, sf_dir):
    r = materialise(entries(spark, sf_dir))
    h = S.health(r).withColumn("entry", S.same_channel_key(F.col("channel_id")))
    best = h.groupBy("entry", "source").agg(F.min_by(F.struct("channel_id", "n_rows", "score", "coverage", "future_hours", "richness"), F.struct(-F.col("n_rows"), F.col("channel_id"))).alias("b"))
    return r, best.select("entry", "source", "b.*", F.lit(1).alias("tier"))


def evaluations(spark, sf_dir, exact: bool = False):
    """Rows, evaluated candidates and pairs; ``exact`` counts only titles that SQL finds alike, without their ratio."""
    r, cands = _candidates(spark, sf_dir)
    pairs = materialise(C.shifted(materialise(C.near_window(r).select("entry", "source", "channel_id", "row_id", "s", "e", "norm")), exact))
    return r, C.evaluated(cands, pairs, load(spark, sf_dir, "sources")), pairs


def _timeline(spark, sf_dir):
    r, ev, pairs = evaluations(spark, sf_dir)
    return fuse.timeline(r, materialise(ev), pairs), r


_CANDS = f"""ca AS (SELECT entry, source, unnest(arg_min({{'channel_id': channel_id, 'n_rows': n_rows, 'score': score, 'coverage': coverage, 'future_hours': future_hours, 'richness': richness}}, (-n_rows, channel_id))) , 1 AS tier FROM (SELECT *, {_ENTRY} AS entry FROM h) GROUP BY entry, source),
tw AS (SELECT greatest(sum(vote_weight), 0.5) AS w FROM sources WHERE key IN (SELECT source FROM ca)),
vo AS (SELECT entry, a AS source, count(*) FILTER (comparable >= 3) AS voters, sum(vote_weight) FILTER (comparable >= 3) AS voted, count(*) FILTER (comparable >= 3 AND agreement >= 0.55) AS supporters,
 sum(vote_weight) FILTER (comparable >= 3 AND agreement >= 0.55) AS supported, avg(agreement) FILTER (comparable >= 3 AND agreement >= 0.55) AS avg_support, list(DISTINCT family) FILTER (comparable >= 3 AND agreement >= 0.55) AS fam
 FROM sh LEFT JOIN sources ON key = b GROUP BY ALL),
e1 AS (SELECT ca.*, family, coalesce(supporters, 0) + 1 AS support_votes, coalesce(voters, 0) + 1 AS vote_sources, vote_weight + coalesce(voted, 0) AS vw, vote_weight + coalesce(supported, 0) AS sw, coalesce(avg_support, 0) AS avg_support,
 CASE WHEN score >= 0.99 AND future_hours >= 48 THEN 1.0 ELSE score END AS eff, len(list_distinct(list_append(coalesce(fam, []), family))) AS support_families FROM ca LEFT JOIN sources ON key = source LEFT JOIN vo USING (entry, source)),
e2 AS (SELECT *, CASE WHEN vw > 0 THEN sw / vw ELSE 0 END AS wr FROM e1),
ev AS (SELECT * REPLACE (round(avg_support, 4) AS avg_support), round(wr, 4) AS weighted_ratio, round_even(100 * greatest(0, least(1, (0.40::DOUBLE * wr + 0.25::DOUBLE * eff + 0.20::DOUBLE * richness + 0.15::DOUBLE * avg_support) * (0.55::DOUBLE + 0.45::DOUBLE * least(vw / w, 1)))), 0)::INT AS confidence FROM e2, tw)"""
_MERIT = """rk AS (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY (n_rows > 0)::INT DESC, tier, (tier = 1 AND family = 'afiliadas' AND score >= 0.70)::INT DESC, (coverage >= 0.65 AND score >= 0.70)::INT DESC,
 round(0.38::DOUBLE * weighted_ratio + 0.22::DOUBLE * avg_support + 0.24::DOUBLE * richness + 0.10::DOUBLE * eff + 0.06::DOUBLE * least(1.0::DOUBLE, future_hours / 48), 4) DESC, support_votes DESC, round(richness, 3) DESC, round(future_hours, 1) DESC, source) AS rank FROM ev)"""
_FULL = f"{_NEAR.format(HEALTH)}, {_agree('ag', 'nr a', '0')}, {_SHIFTED}, {_CANDS}"


def _confidence(ev):
    return ev.select("entry", "source", "support_votes", "vote_sources", "support_families", "weighted_ratio", "avg_support", "confidence")


def _winner(ev):
    return C.ranked(ev).filter("rank = 1").select("entry", "source", "channel_id", "confidence")


def _status(ev):
    return C.validation(ev).select("entry", "source", "confidence", "status")


@query(f"{_FULL} SELECT entry, source, support_votes, vote_sources, support_families, weighted_ratio, avg_support, confidence FROM ev")
def consensus_confidence(spark, sf_dir):
    return _confidence(evaluations(spark, sf_dir, exact=True)[1])


@query()
def consensus_confidence_ratio(spark, sf_dir):
    return _confidence(evaluations(spark, sf_dir)[1])


@query(f"{_FULL}, {_MERIT} SELECT entry, source, channel_id, confidence FROM rk WHERE rank = 1")
def merit_winner(spark, sf_dir):
    return _winner(evaluations(spark, sf_dir, exact=True)[1])


@query()
def merit_winner_ratio(spark, sf_dir):
    return _winner(evaluations(spark, sf_dir)[1])


@query(f"{_FULL}, {_MERIT} SELECT entry, source, confidence, CASE WHEN score < 0.45 THEN 'suspect' WHEN support_families >= 3 AND confidence >= 75 THEN 'ok' WHEN confidence >= 55 AND support_families >= 2 THEN 'attention' ELSE 'suspect' END AS status FROM rk WHERE rank = 1")
def validation_status(spark, sf_dir):
    return _status(evaluations(spark, sf_dir, exact=True)[1])


@query()
def validation_status_ratio(spark, sf_dir):
    return _status(evaluations(spark, sf_dir)[1])


@query(f"""{HEALTH}, x AS (SELECT *, {_ENTRY} AS entry, {_RICH} AS rich FROM f), me AS (SELECT DISTINCT entry, source, 0.0::DOUBLE AS merit FROM x),
r1 AS (SELECT *, unnest(range(greatest(0, (s - ({NOW} - 21600)) // 21600), least(12, (e - 1 - ({NOW} - 21600)) // 21600) + 1)) AS win FROM x WHERE e > {NOW} - 21600 AND s < {NOW} + 259200),
r2 AS (SELECT *, {NOW} - 21600 + win * 21600 AS b0, least({NOW} - 21600 + (win + 1) * 21600, {NOW} + 259200) AS b1 FROM r1),
st AS (SELECT entry, win, norm, count(DISTINCT source) AS n_src FROM r2 WHERE norm != '' GROUP BY ALL),
pe AS (SELECT entry, win, source, least(1.0::DOUBLE, sum(least(e, b1) - greatest(s, b0)) / max(b1 - b0)) AS cov, avg(rich) AS rich, avg(CASE WHEN n_src >= 2 THEN 1.0 ELSE 0.0 END) AS agreed FROM r2 LEFT JOIN st USING (entry, win, norm) GROUP BY ALL),
sw AS (SELECT pe.*, round(0.40::DOUBLE * cov + 0.30::DOUBLE * CASE WHEN n_all > 1 THEN agreed ELSE 1.0 END + 0.20::DOUBLE * rich - CASE WHEN cov < 0.98 THEN 0.65::DOUBLE * (1 - cov) ELSE 0 END, 6) AS win_score
 FROM pe JOIN (SELECT entry, count(*) AS n_all FROM me GROUP BY 1) USING (entry) WHERE cov >= 0.25)
SELECT entry, win::INT AS win, arg_min(source, (-win_score, source)) AS source, max(win_score) AS win_score FROM sw GROUP BY entry, win""")
def window_election_6h(spark, sf_dir):
    r = entries(spark, sf_dir).withColumn("rich", S.richness())
    merits = r.select("entry", "source").distinct().withColumn("merit", F.lit(0.0))
    return C.elected(r, merits)


@query(f"{REPAIRED}, x AS (SELECT *, {_ENTRY} AS entry FROM f) SELECT entry, ((s - ({NOW} - 21600)) // 21600)::BIGINT AS win, norm, count(DISTINCT source) AS n_sources FROM x WHERE s >= {NOW} - 21600 AND s < {NOW} + 259200 GROUP BY ALL HAVING count(DISTINCT source) >= 2")
def title_support(spark, sf_dir):
    r = entries(spark, sf_dir).filter((F.col("s") >= NOW - 21600) & (F.col("s") < NOW + 259200))
    return r.groupBy("entry", F.expr(f"(s - {NOW - 21600}) div 21600").alias("win"), "norm").agg(F.count_distinct("source").alias("n_sources")).filter("n_sources >= 2")


@query()
def timeline_stitch(spark, sf_dir):
    return _timeline(spark, sf_dir)[0].select("entry", "s", "e", "source", "row_id", "kind")


@query()
def gap_fill(spark, sf_dir):
    return _timeline(spark, sf_dir)[0].filter("kind = 'fill'").select("entry", "s", "e", "source", "row_id")


@query()
def fused_schedule(spark, sf_dir):
    t, r = _timeline(spark, sf_dir)
    return fuse.with_metadata(materialise(t), r).select("entry", "s", "e", "title", "sub_title", F.length("desc").alias("desc_chars"), "season", "episode", F.array_join("categories", ",").alias("categories"), "date", "rating_badge")


_M = "m.meta"


@query(f"""{REPAIRED}, x AS (SELECT *, {_ENTRY} AS entry FROM f), li AS (SELECT entry, s, min(e) AS e, norm, min(title) AS title FROM x WHERE e > {NOW} - 21600 AND s < {NOW} + 259200 GROUP BY entry, s, norm),
ne AS (SELECT li.entry, li.s, li.norm, m.row_id, m.s AS s2, m.meta FROM li JOIN x m ON m.entry = li.entry AND m.norm = li.norm AND abs(m.s - li.s) <= 1500)
SELECT entry, s, norm, length(arg_max(coalesce(meta.desc, ''), (length(coalesce(meta.desc, '')), -row_id)))::INT AS desc_chars, length(arg_max(coalesce(meta.sub_title, ''), (length(coalesce(meta.sub_title, '')), -row_id)))::INT AS sub_chars,
 coalesce(arg_min(meta.season, (s2, row_id)) FILTER (meta.season IS NOT NULL), 0) AS season, coalesce(arg_min(meta.rating_badge, (s2, row_id)) FILTER (coalesce(meta.rating_badge, '') != ''), '') AS badge,
 array_to_string(list_sort(list_distinct(flatten(list(coalesce(meta.categories, []))))), ',') AS categories FROM ne GROUP BY ALL""")
def metadata_fusion(spark, sf_dir):
    r = entries(spark, sf_dir)
    near = r.filter((F.col("e") > NOW - 21600) & (F.col("s") < NOW + 259200))
    line = near.groupBy("entry", "s", "norm").agg(F.min("e").alias("e"), F.min("title").alias("title"), F.min("source").alias("source"))
    m = fuse.near_metadata(line, r)
    return m.select("entry", "s", "norm", F.length(F.coalesce("desc", F.lit(""))).alias("desc_chars"), F.length(F.coalesce("sub_title", F.lit(""))).alias("sub_chars"), F.coalesce("season", F.lit(0)).alias("season"),
                    F.coalesce("rating_badge", F.lit("")).alias("badge"), F.array_join("categories", ",").alias("categories"))
