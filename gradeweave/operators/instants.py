"""Mixed time notations to instants in UTC (problem 5).

One alternation with named groups covers every notation; a single replacement writes its components in a fixed order,
calendar ranges are checked on the integers, and the instant is put together by day arithmetic. All of it stays in
generated JVM code. Zone names take the JVM's zone rules, where a local time that occurs twice means the first.

Defined results: NULL, blank, unreadable and impossible values give NULL; a zone in the value counts before the
source's default; NULL, '' and unknown defaults and unknown or NULL sources mean UTC without shift; fractions of a
second are cut off; blanks around and remarks after a value are ignored; a value of any length is matched as a whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import small

#: Minutes from UTC of zone abbreviations.
ABBREVIATIONS = {
    "Z": 0, "UT": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120, "EEST": 180, "MSK": 180,
    "IST": 330, "BRT": -180, "BRST": -120, "AMT": -240, "AMST": -180, "ACT": -300, "FNT": -120, "ART": -180,
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
#: First three letters of month names in Portuguese, Spanish, English, French and Italian.
MONTHS = {
    "jan": 1, "ene": 1, "gen": 1, "fev": 2, "feb": 2, "mar": 3, "abr": 4, "apr": 4, "avr": 4, "mai": 5, "may": 5, "mag": 5,
    "jun": 6, "giu": 6, "jul": 7, "lug": 7, "ago": 8, "aug": 8, "set": 9, "sep": 9, "out": 10, "oct": 10, "ott": 10,
    "nov": 11, "dez": 12, "dec": 12, "dic": 12,
}
_ZONE = r"(?:\s*(?:(?:GMT|UTC)?(?<{p}sg>[+-])(?<{p}oh>\d{{1,2}})(?::?(?<{p}om>\d{{2}}))?(?!\d)|(?<{p}ab>" + "|".join(sorted(ABBREVIATIONS, key=len, reverse=True)) + r")(?![\p{{L}}\d+-])))?"
_REST = r"(?:\s*$|\s+[^\s\d:+-].*$|\s*\(.*$)"
_FORMS = (
    # digits in a row, with or without seconds
    r"(?<ay>\d{4})(?<am>\d{2})(?<ad>\d{2})(?<ah>\d{2})(?<ai>\d{2})(?<as>\d{2})?(?!\d)" + _ZONE.format(p="a"),
    # year first
    r"(?<by>\d{4})-(?<bm>\d{1,2})-(?<bd>\d{1,2})(?:[Tt]|\s+)(?<bh>\d{1,2}):(?<bi>\d{2})(?::(?<bs>\d{2})(?:[.,]\d+)?)?(?![\d:])" + _ZONE.format(p="b"),
    # day first, with slashes
    r"(?<cd>\d{1,2})/(?<cm>\d{1,2})/(?<cy>\d{4}|\d{2})(?:,?\s+)(?<ch>\d{1,2})[:h](?<ci>\d{2})(?::(?<cs>\d{2}))?(?![\d:])" + _ZONE.format(p="c"),
    # day, name of the month, year
    r"(?<dd>\d{1,2})\s+(?:de\s+)?(?<dn>\p{L}{3})\p{L}*\.?\s+(?:de\s+)?(?<dy>\d{4}),?\s+(?<dh>\d{1,2})[:h](?<di>\d{2})(?::(?<ds>\d{2}))?(?![\d:])" + _ZONE.format(p="d"),
    # epoch milliseconds or seconds
    r"(?<ep>-?\d{10})(?:\d{3})?(?![\d:])",
)
PATTERN = r"(?iu)^(?:" + "|".join(_FORMS) + ")" + _REST
_PARTS = (("ay", "by", "cy", "dy"), ("am", "bm", "cm"), ("ad", "bd", "cd", "dd"), ("ah", "bh", "ch", "dh"), ("ai", "bi", "ci", "di"), ("as", "bs", "cs", "ds"),
          ("dn",), ("asg", "bsg", "csg", "dsg"), ("aoh", "boh", "coh", "doh"), ("aom", "bom", "com", "dom"), ("aab", "bab", "cab", "dab"), ("ep",))
_NAMES = ("y", "m", "d", "h", "i", "s", "mon", "sg", "oh", "om", "ab", "ep")
_MARK = "\u0001"
_TEMPLATE = _MARK + "|".join("".join(f"${{{g}}}" for g in part) for part in _PARTS)


def _lookup(entries: dict[str, int], key: Column) -> Column:
    return F.create_map(*(F.lit(x) for kv in entries.items() for x in kv))[key]


def zone_minutes(value: Column) -> Column:
    """Minutes from UTC of an offset or abbreviation; NULL for a zone name."""
    v = F.upper(F.trim(value))
    shape = r"^(?:GMT|UTC)?([+-])(\d{1,2}):?(\d{2})?$"
    sign = F.when(F.regexp_extract(v, shape, 1) == "-", -1).otherwise(1)
    hours = F.regexp_extract(v, shape, 2).try_cast("int")
    minutes = F.coalesce(F.regexp_extract(v, shape, 3).try_cast("int"), F.lit(0))
    return F.coalesce(sign * (hours * 60 + minutes), _lookup(ABBREVIATIONS, v))


def components(value: Column) -> Column:
    """Array of the twelve components as text, NULL where the value has none of the notations."""
    out = F.regexp_replace(F.regexp_replace(value, r"^[\s\u00a0\u200b\ufeff]+|[\s\u00a0\u200b\ufeff]+$", ""), PATTERN, _TEMPLATE)
    return F.when(out.startswith(_MARK), F.split(F.substring(out, 2, 1_000_000), r"\|", -1))


def with_instant(df: DataFrame, value: str, default_min: str, default_zone: str, out: str) -> DataFrame:
    """Adds ``out``: epoch seconds in UTC, before any shift of the source. default_zone: a checked zone name or NULL."""
    c = "_comp"
    num = lambda k: F.col(c)[_NAMES.index(k)].try_cast("bigint")
    txt = lambda k: F.col(c)[_NAMES.index(k)]
    df = df.withColumn(c, components(F.col(value)))
    year = F.when(F.length(txt("y")) == 2, num("y") + 2000).otherwise(num("y"))
    df = df.withColumns({
        "_y": year, "_m": F.coalesce(num("m"), _lookup(MONTHS, F.lower(txt("mon"))).cast("bigint")), "_d": num("d"), "_h": num("h"), "_i": num("i"),
        "_s": F.coalesce(num("s"), F.lit(0)),
        "_off": F.when(txt("sg") != "", F.when(txt("sg") == "-", -1).otherwise(1) * (num("oh") * 60 + F.coalesce(num("om"), F.lit(0)))).otherwise(_lookup(ABBREVIATIONS, F.upper(txt("ab")))),
        "_ep": num("ep"),
    })
    leap = "((_y % 4 = 0 AND _y % 100 != 0) OR _y % 400 = 0)"
    month_days = f"CASE WHEN _m = 2 THEN IF({leap}, 29, 28) WHEN _m IN (4, 6, 9, 11) THEN 30 ELSE 31 END"
    valid = f"_y >= 1 AND _m BETWEEN 1 AND 12 AND _d BETWEEN 1 AND {month_days} AND _h <= 23 AND _i <= 59 AND _s <= 59"
    yy = "(IF(_m <= 2, _y - 1, _y))"
    days = f"({yy} * 365 + {yy} div 4 - {yy} div 100 + {yy} div 400 + (153 * (_m + IF(_m > 2, -3, 9)) + 2) div 5 + _d - 719469)"
    local = F.expr(f"CASE WHEN {valid} THEN {days} * 86400 + _h * 3600 + _i * 60 + _s END")
    df = df.withColumn("_local", local)
    by_zone = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds("_local"), F.coalesce(F.col(default_zone), F.lit("UTC"))))
    minutes = F.coalesce(F.col("_off"), F.when(F.col(default_zone).isNull(), F.coalesce(F.col(default_min), F.lit(0))))
    instant = F.coalesce(F.col("_ep"), F.when(minutes.isNotNull(), F.col("_local") - minutes * 60).otherwise(by_zone))
    return df.withColumn(out, instant).drop("_comp", "_y", "_m", "_d", "_h", "_i", "_s", "_off", "_ep", "_local")


def known_zones(spark: SparkSession) -> list[str]:
    """Region names the JVM has rules for."""
    return sorted(z for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds().toArray() if re.match(r"[A-Z][A-Za-z_]+/", z))


def source_clocks(sources: DataFrame, key: str = "key", offset: str = "default_offset", shift: str = "timeshift_hours") -> DataFrame:
    """_src, _zone (checked name or NULL), _zmin, _shift_s; the first row of a key by its text counts if keys repeat."""
    zone = F.trim(F.col(offset))
    named = F.when(zone.isin(known_zones(sources.sparkSession)), zone)
    return sources.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_src"),
        F.struct(named.alias("_zone"), zone_minutes(zone).alias("_zmin"), F.coalesce(F.expr(f"CAST(round(`{shift}` * 3600) AS BIGINT)"), F.lit(0)).alias("_shift_s")).alias("c"),
    ).groupBy("_src").agg(F.min("c").alias("c")).select("_src", "c.*")


def instants(rows: DataFrame, sources: DataFrame, row_id: str = "raw_id", source: str = "source",
             fields: dict[str, str] | None = None) -> DataFrame:
    """One row (id, field, utc_s) for each value of each field that can be read. fields: column -> name in the result."""
    fields = fields or {"_start": "start", "_stop": "stop"}
    long = rows.select(
        F.col(row_id).alias(row_id), F.col(source).alias("_src"),
        F.explode(F.array(*(F.struct(F.lit(n).alias("field"), F.col(c).cast("string").alias("value")) for c, n in fields.items()))).alias("v"),
    ).select(row_id, "_src", "v.*").filter("value IS NOT NULL")
    joined = long.join(small(source_clocks(sources)), "_src", "left")
    out = with_instant(joined, "value", "_zmin", "_zone", "utc")
    # the generator drops unreadable values; a filter would be pushed down and evaluate the whole pattern a second time
    return out.select(row_id, "field", F.explode(F.array_compact(F.array(F.col("utc") + F.coalesce("_shift_s", F.lit(0))))).alias("utc_s"))
