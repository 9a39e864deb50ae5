"""Schedules of (source, channel_id): repair, stops, breaks, now and next, health."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import titles
from ..operators import schedule as S
from ..runtime import load
from .sqlgen import lit, rewrite
from .text_queries import _RICH

QUERIES, ORACLE = {}, {}
NOW = S.CLOCK


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


_NORM = rewrite("coalesce(title, '')", titles.TITLE_NORM)
_OK = f"length(norm) >= 2 AND norm NOT IN ({', '.join(map(lit, titles.PLACEHOLDERS))}) AND NOT ({' OR '.join(f'contains(norm, {lit(p)})' for p in titles.PLACEHOLDER_PARTS)})"
ROWS = f"""WITH r AS (SELECT row_id, source, channel_id, seq, epoch(start)::BIGINT AS s, coalesce(epoch(stop)::BIGINT, epoch(start)::BIGINT) AS e, title, {_NORM} AS norm, meta
 FROM programmes WHERE start IS NOT NULL AND source IS NOT NULL AND channel_id IS NOT NULL)"""
_LEAD = "lead(s) OVER (PARTITION BY source, channel_id ORDER BY s, seq, row_id)"
GOOD = f"{ROWS}, m AS (SELECT * FROM r WHERE {_OK})"
REPAIRED = f"""{GOOD}, n AS (SELECT *, {_LEAD} AS nxt FROM m),
a AS (SELECT * REPLACE (CASE WHEN e <= s THEN CASE WHEN nxt > s THEN least(nxt, s + 10800) ELSE s + 2700 END WHEN e > nxt THEN nxt ELSE e END AS e) FROM n),
f AS (SELECT * FROM (SELECT * REPLACE (CASE WHEN e - s > 28800 THEN CASE WHEN nxt > s AND nxt - s <= 14400 THEN nxt ELSE s + 7200 END ELSE e END AS e) FROM a) WHERE e > s)"""


def base(spark, sf_dir, meaningful=True):
    return S.rows(load(spark, sf_dir, "programmes"), meaningful)


def fixed(spark, sf_dir):
    return S.repaired(base(spark, sf_dir))


@query(f"{REPAIRED} SELECT row_id, source, channel_id, s, e FROM f")
def schedule_repair(spark, sf_dir):
    return fixed(spark, sf_dir).select("row_id", *S.KEYS, "s", "e")


@query(f"{ROWS}, k AS (SELECT *, row_number() OVER (PARTITION BY source, channel_id, s ORDER BY seq, row_id) AS k FROM r) SELECT row_id, source, channel_id, s FROM k WHERE k = 1")
def dedupe_first_start(spark, sf_dir):
    return S.one_per_start(base(spark, sf_dir, False)).select("row_id", *S.KEYS, "s")


@query(f"{ROWS}, k AS (SELECT *, row_number() OVER (PARTITION BY source, channel_id, s ORDER BY seq DESC, row_id DESC) AS k FROM r) SELECT row_id, source, channel_id, s FROM k WHERE k = 1")
def dedupe_last_start(spark, sf_dir):
    return S.one_per_start(base(spark, sf_dir, False), "last").select("row_id", *S.KEYS, "s")


_STOPS = {
    "cap6": "CASE WHEN nxt IS NULL THEN s + 3600 WHEN nxt - s > 21600 THEN s + 7200 ELSE nxt END",
    "cap4": "CASE WHEN nxt IS NULL THEN s + 3600 ELSE least(nxt, s + 14400) END",
    "clip": "CASE WHEN e > nxt THEN nxt ELSE e END",
}


@query(f"{ROWS}, n AS (SELECT *, {_LEAD} AS nxt FROM r) " + " UNION ALL ".join(f"SELECT row_id, '{k}' AS rule, {v} AS e FROM n" for k, v in _STOPS.items()))
def stop_inference(spark, sf_dir):
    r = base(spark, sf_dir, False)
    parts = [S.inferred_stops(r, k).select("row_id", F.lit(k).alias("rule"), "e") for k in _STOPS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(f"{REPAIRED}, c AS (SELECT *, {_LEAD} AS nx FROM f), z AS (SELECT row_id, s, CASE WHEN e > nx OR (nx > e AND nx - e <= 300) THEN nx ELSE e END AS e FROM c) SELECT * FROM z WHERE e - s >= 60")
def final_clip(spark, sf_dir):
    return S.final_clip(fixed(spark, sf_dir)).select("row_id", "s", "e")


def _now_next_sql(direction: str) -> str:
    o = f"(s, seq, row_id)"
    return f"""{REPAIRED} SELECT source, channel_id, {direction}(row_id, {o}) FILTER (s <= {NOW} AND e > {NOW}) AS now_row_id, arg_min(row_id, {o}) FILTER (s > {NOW}) AS next_row_id FROM f GROUP BY ALL"""


@query("SELECT source, channel_id, coalesce(now_row_id, -1) AS now_row_id, coalesce(next_row_id, -1) AS next_row_id FROM (" + _now_next_sql("arg_max") + ")")
def now_next(spark, sf_dir):
    r = S.now_next(fixed(spark, sf_dir))
    return r.select(*S.KEYS, *(F.coalesce(c, F.lit(-1)).alias(c) for c in ("now_row_id", "next_row_id")))


_BREAKS = f"n AS (SELECT *, {_LEAD} - e AS d FROM m), b AS (SELECT *, CASE WHEN d > 120 THEN 'gap' WHEN d < -120 THEN 'overlap' END AS kind FROM n)"


@query(f"{GOOD}, {_BREAKS} SELECT source, channel_id, row_id, e AS from_s, d AS seconds FROM b WHERE kind = 'gap'")
def audit_gaps(spark, sf_dir):
    return S.breaks(base(spark, sf_dir)).filter("kind = 'gap'").select(*S.KEYS, "row_id", "from_s", "seconds")


@query(f"{GOOD}, {_BREAKS} SELECT source, channel_id, row_id, e AS from_s, -d AS seconds FROM b WHERE kind = 'overlap'")
def audit_overlaps(spark, sf_dir):
    return S.breaks(base(spark, sf_dir)).filter("kind = 'overlap'").select(*S.KEYS, "row_id", "from_s", "seconds")


_RUN = f"""w AS (SELECT *, max(e) OVER (PARTITION BY source, channel_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM f WHERE e > {NOW} AND s < {NOW} + 129600),
 g AS (SELECT source, channel_id, CASE WHEN s - p > 300 THEN 'gap' WHEN s - p < -60 THEN 'overlap' END AS kind, abs(s - p) AS seconds FROM w)"""


@query(f"{REPAIRED}, {_RUN} SELECT source, channel_id, kind, count(*) AS n, sum(seconds)::BIGINT AS seconds FROM g WHERE kind IS NOT NULL GROUP BY ALL")
def running_gap_stats(spark, sf_dir):
    return S.running_breaks(fixed(spark, sf_dir)).groupBy(*S.KEYS, "kind").agg(F.count("*").alias("n"), F.sum("seconds").alias("seconds"))


_HEALTH = f"""{_RUN}, gb AS (SELECT source, channel_id, count(*) FILTER (kind = 'overlap') AS n_overlaps, count(*) FILTER (kind = 'gap') AS n_gaps, coalesce(sum(seconds) FILTER (kind = 'gap'), 0) AS gap_s FROM g GROUP BY ALL),
ba AS (SELECT source, channel_id, count(*) AS n_rows, max(CASE WHEN s <= {NOW} AND e > {NOW} THEN 1 ELSE 0 END) AS has_now, max(CASE WHEN s > {NOW} THEN 1 ELSE 0 END) AS has_next,
 least(1.0::DOUBLE, coalesce(sum(greatest(0, least({NOW} + 86400, e) - greatest({NOW}, s))) FILTER (e > {NOW} AND s < {NOW} + 86400), 0) / 86400.0::DOUBLE) AS coverage,
 greatest(0.0::DOUBLE, coalesce(max(e) FILTER (e > {NOW}) - {NOW}, 0) / 3600.0::DOUBLE) AS ahead, count(*) FILTER (e > {NOW} AND s < {NOW} + 129600 AND e - s > 43200) AS invalid FROM f GROUP BY ALL),
k AS (SELECT *, (e > {NOW} AND s < {NOW} + 86400)::INT AS near FROM f),
o AS (SELECT *, row_number() OVER (PARTITION BY source, channel_id ORDER BY near DESC, s, seq, row_id) AS k FROM k),
ri AS (SELECT source, channel_id, round(CASE WHEN max(near) = 1 THEN avg({_RICH}) FILTER (near = 1) ELSE avg({_RICH}) END, 4) AS richness FROM o WHERE k <= 35 GROUP BY ALL),
j AS (SELECT ba.*, coalesce(n_overlaps, 0) AS n_overlaps, coalesce(n_gaps, 0) AS n_gaps, coalesce(gap_s, 0) AS gap_s, richness FROM ba LEFT JOIN gb USING (source, channel_id) LEFT JOIN ri USING (source, channel_id)),
sc AS (SELECT *, 0.25::DOUBLE * has_now + 0.10::DOUBLE * has_next + 0.35::DOUBLE * coverage + 0.20::DOUBLE * least(ahead / 20, 1.0::DOUBLE) + 0.10::DOUBLE * least(n_rows / 12.0::DOUBLE, 1.0::DOUBLE)
 - least(0.50::DOUBLE, invalid * 0.08::DOUBLE + n_overlaps * 0.02::DOUBLE + least(0.45::DOUBLE, n_gaps * 0.12::DOUBLE + gap_s / 3600.0::DOUBLE * 0.08::DOUBLE)) AS raw FROM j),
c1 AS (SELECT *, CASE WHEN n_gaps > 0 OR coverage < 0.96 THEN least(raw, 0.85::DOUBLE) ELSE raw END AS q FROM sc),
h AS (SELECT source, channel_id, n_rows, has_now, has_next, round(coverage, 4) AS coverage, round(ahead, 1) AS future_hours, invalid, n_overlaps, n_gaps, richness,
 round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN ahead < 8 THEN least(q, 0.35::DOUBLE) ELSE q END)), 4) AS score FROM c1)"""
HEALTH = f"{REPAIRED}, {_HEALTH}"


@query(f"{HEALTH} SELECT * FROM h")
def schedule_health(spark, sf_dir):
    return S.health(fixed(spark, sf_dir))


@query(f"{HEALTH}, bw AS (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY score DESC, richness DESC, source) AS k FROM h) SELECT channel_id, source, score, n_rows FROM bw WHERE k = 1")
def health_winner(spark, sf_dir):
    h = S.health(fixed(spark, sf_dir))
    best = h.groupBy("channel_id").agg(F.min_by(F.struct("source", "score", "n_rows"), F.struct(-F.col("score"), -F.col("richness"), F.col("source"))).alias("b"))
    return best.select("channel_id", "b.*")


_OWN = f"""c AS (SELECT DISTINCT source, channel_id, unnest(list_append(coalesce(display_names, []), channel_id)) AS title FROM source_channels),
o AS (SELECT DISTINCT source, channel_id, {_NORM} AS norm FROM c), bad AS (SELECT source, channel_id FROM m LEFT JOIN (SELECT *, 1 AS own FROM o WHERE norm != '') USING (source, channel_id, norm) GROUP BY ALL HAVING count(*) >= 5 AND count(own) >= count(*) * 0.8)"""


@query(f"{GOOD}, {_OWN} SELECT source, channel_id, count(*) AS n_rows FROM m ANTI JOIN bad USING (source, channel_id) GROUP BY ALL")
def own_name_channel_drop(spark, sf_dir):
    r = S.without_self_named(base(spark, sf_dir), load(spark, sf_dir, "source_channels"))
    return r.groupBy(*S.KEYS).agg(F.count("*").alias("n_rows"))


@query(f"{GOOD} SELECT source, channel_id, count(*) AS n_rows FROM m GROUP BY ALL HAVING count(*) >= 2")
def min_rows_filter(spark, sf_dir):
    return S.with_rows(base(spark, sf_dir)).groupBy(*S.KEYS).agg(F.count("*").alias("n_rows"))


@query(f"{REPAIRED} SELECT row_id FROM f WHERE e > {NOW} - 21600 AND s < {NOW} + 259200")
def output_window(spark, sf_dir):
    return S.in_window(fixed(spark, sf_dir)).select("row_id")


@query(f"""{ROWS}, t AS (SELECT *, (s % 86400) // 60 AS minute FROM r), l AS (SELECT *, CASE WHEN lag(minute) OVER (PARTITION BY source, channel_id ORDER BY seq, row_id) - minute > 240 THEN 1 ELSE 0 END AS turn FROM t)
SELECT row_id, sum(turn) OVER (PARTITION BY source, channel_id ORDER BY seq, row_id ROWS UNBOUNDED PRECEDING)::BIGINT AS day FROM l""")
def midnight_rollover(spark, sf_dir):
    r = base(spark, sf_dir, False).withColumn("minute", F.expr("(s % 86400) div 60"))
    return S.rollover(r).select("row_id", F.col("day").cast("bigint").alias("day"))


@query(f"{REPAIRED} SELECT source, count(DISTINCT channel_id) AS n_channels, count(*) AS n_rows, sum(e - s)::BIGINT AS seconds, count(*) FILTER (e - s > 14400) AS long_rows FROM f GROUP BY ALL")
def source_summary(spark, sf_dir):
    return fixed(spark, sf_dir).groupBy("source").agg(
        F.count_distinct("channel_id").alias("n_channels"), F.count("*").alias("n_rows"), F.sum(F.col("e") - F.col("s")).alias("seconds"), F.count_if(F.col("e") - F.col("s") > 14400).alias("long_rows"))
