"""Queries and oracle SQL of the general problems 3 and 5."""

from __future__ import annotations

from ..operators import instants, intervals
from ..runtime import load
from .sqlgen import lit

KEYS = ("source", "channel_id")


def p3_found(spark, sf_dir):
    return intervals.gaps(load(spark, sf_dir, "programmes"), KEYS)


def p3_periods(spark, sf_dir):
    return intervals.periods(load(spark, sf_dir, "programmes"), KEYS)


def p5_found(spark, sf_dir):
    return instants.instants(load(spark, sf_dir, "xmltv_programme"), load(spark, sf_dir, "sources"))


QUERIES = {"p3_found": p3_found, "p3_periods": p3_periods, "p5_found": p5_found}

_FLAGGED = """
WITH r AS (SELECT source, channel_id, epoch_us(start) AS s, epoch_us(stop) AS e FROM programmes WHERE stop > start),
f AS (SELECT *, max(e) OVER (PARTITION BY source, channel_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p FROM r)
"""
ORACLE = {
    "p3_found": _FLAGGED + """
SELECT source, channel_id, p // 1000000 AS gap_start_s, s // 1000000 AS gap_stop_s FROM f WHERE s > p AND s - p < 864000000000
""",
    "p3_periods": _FLAGGED + """
, g AS (SELECT *, sum(CASE WHEN p IS NULL OR s > p THEN 1 ELSE 0 END) OVER (PARTITION BY source, channel_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM f)
SELECT source, channel_id, min(s) // 1000000 AS period_start_s, max(e) // 1000000 AS period_stop_s, count(*) AS n_rows FROM g GROUP BY source, channel_id, i
""",
}


def _instants_sql() -> str:
    """Another way to the same: a pattern per notation, the calendar of the database and its zones."""
    month = " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in instants.MONTHS.items())
    zones = " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in instants.ABBREVIATIONS.items())
    zone = r"\s*((?:GMT|UTC)?[+-]\d{1,2}:?(?:\d{2})?|" + "|".join(sorted(instants.ABBREVIATIONS, key=len, reverse=True)) + ")?"
    rest = r"(?:\s*|\s+[^\s\d:+-].*|\s*\(.*)$"
    forms = (
        (r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})?", ("y", "m", "d", "h", "i", "s")),
        (r"^(\d{4})-(\d{1,2})-(\d{1,2})(?:T|\s+)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?", ("y", "m", "d", "h", "i", "s")),
        (r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2}),?\s+(\d{1,2})[:h](\d{2})(?::(\d{2}))?", ("d", "m", "y", "h", "i", "s")),
        (r"^(\d{1,2})\s+(\p{L}{3})\p{L}*\.?\s+(\d{4}),?\s+(\d{1,2})[:h](\d{2})(?::(\d{2}))?", ("d", "m", "y", "h", "i", "s")),
    )
    case = " ".join(f"WHEN regexp_matches(v, {lit('(?i)' + p + zone + rest)}) THEN regexp_extract(v, {lit('(?i)' + p + zone + rest)}, {list(n) + ['z']!r})" for p, n in forms)
    minutes = lambda c: f"""CASE WHEN {c} = '' THEN NULL WHEN regexp_matches({c}, '[+-]') THEN (CASE WHEN contains({c}, '-') THEN -1 ELSE 1 END) * (CAST(regexp_extract({c}, '[+-](\\d{{1,2}})', 1) AS INT) * 60 + coalesce(try_cast(nullif(regexp_extract({c}, '[+-]\\d{{1,2}}:?(\\d{{2}})$', 1), '') AS INT), 0)) ELSE CASE upper({c}) {zones} END END"""
    return rf"""
WITH x AS (SELECT raw_id, source, 'start' AS field, trim(_start, chr(9) || ' ' || chr(160)) AS v FROM xmltv_programme UNION ALL SELECT raw_id, source, 'stop', trim(_stop, chr(9) || ' ' || chr(160)) FROM xmltv_programme),
p AS (SELECT *, CASE WHEN regexp_matches(v, '^\d{{10}}(?:\d{{3}})?$') THEN CAST(v[1:10] AS BIGINT) END AS ep, CASE WHEN regexp_matches(v, '^\d{{10}}(?:\d{{3}})?$') THEN NULL {case} END AS c FROM x WHERE v IS NOT NULL),
l AS (SELECT raw_id, source, field, ep, c.z AS z, try_strptime((CASE WHEN length(c.y) = 2 THEN '20' || c.y ELSE c.y END) || '-' || lpad(CASE WHEN regexp_matches(c.m, '^\d+$') THEN c.m ELSE coalesce(CAST(CASE lower(c.m) {month} END AS VARCHAR), '99') END, 2, '0') || '-' || lpad(c.d, 2, '0') || ' ' ||
  lpad(c.h, 2, '0') || ':' || c.i || ':' || CASE WHEN c.s = '' THEN '00' ELSE c.s END, '%Y-%m-%d %H:%M:%S') AS t FROM p),
s AS (SELECT key AS source, coalesce(trim(default_offset), '') AS o, CAST(round(coalesce(timeshift_hours, 0) * 3600) AS BIGINT) AS sh FROM sources),
j AS (SELECT l.*, coalesce(o, '') AS o, coalesce(sh, 0) AS sh, coalesce({minutes('z')}, CASE WHEN contains(coalesce(o, ''), '/') THEN NULL ELSE coalesce({minutes("coalesce(o, '')")}, 0) END) AS mi FROM l LEFT JOIN s USING (source)),
u AS (SELECT *, CASE WHEN ep IS NULL AND mi IS NULL AND t IS NOT NULL THEN timezone(o, t) END AS tz FROM j),
r AS (SELECT raw_id, field, sh + CASE WHEN ep IS NOT NULL THEN ep WHEN mi IS NOT NULL THEN epoch(t)::BIGINT - mi * 60 WHEN timezone(o, tz - INTERVAL 1 HOUR) = t THEN epoch(tz)::BIGINT - 3600 ELSE epoch(tz)::BIGINT END AS utc_s FROM u)
SELECT * FROM r WHERE utc_s IS NOT NULL
"""


ORACLE["p5_found"] = _instants_sql()
