"""Notations, zones and impossible values."""

import datetime as dt
import zoneinfo

import pytest
from pyspark.sql import functions as F

from gradeweave.operators import instants


def utc(*a):
    return int(dt.datetime(*a, tzinfo=dt.timezone.utc).timestamp())


def in_zone(zone, *a):
    return int(dt.datetime(*a, tzinfo=zoneinfo.ZoneInfo(zone)).timestamp())


SOURCES = [("plus", "+0000", 0.0), ("minus", "-03:00", 0.0), ("india", "+0530", 0.0), ("lisbon", "Europe/Lisbon", 0.0), ("york", "America/New_York", 0.0), ("none", None, 0.0), ("blank", "", 0.0), ("shift", "-0300", 1.5), ("odd", "Nowhere/Land", 0.0), ("word", "BRT", -1.0)]
CASES = [
    ("plus", "20261020064500", utc(2026, 10, 20, 6, 45)), ("minus", "20261020064500", utc(2026, 10, 20, 9, 45)), ("india", "202610200645", utc(2026, 10, 20, 1, 15)),
    ("minus", "20261020064500 +0100", utc(2026, 10, 20, 5, 45)), ("minus", "20261020064500+0100 (est.)", utc(2026, 10, 20, 5, 45)), ("minus", "20261020064500 -0400 #2", utc(2026, 10, 20, 10, 45)),
    ("minus", "20261020064500 +0000 confirmado", utc(2026, 10, 20, 6, 45)), ("minus", "2026-10-20T06:45:00Z", utc(2026, 10, 20, 6, 45)), ("minus", "2026-10-20T06:45:00.000Z", utc(2026, 10, 20, 6, 45)),
    ("minus", "2026-10-20T06:45:00.000000-0300", utc(2026, 10, 20, 9, 45)), ("plus", "2026-10-20 06:45 BRT", utc(2026, 10, 20, 9, 45)), ("plus", "2026-10-20 06:45 GMT-4", utc(2026, 10, 20, 10, 45)),
    ("plus", "2026-10-20 06:45 GMT+5:30", utc(2026, 10, 20, 1, 15)), ("plus", "2026-10-20 06:45 CEST", utc(2026, 10, 20, 4, 45)), ("minus", " \t20/10/2026 6h45 ", utc(2026, 10, 20, 9, 45)),
    ("minus", "20/10/26 06:45", utc(2026, 10, 20, 9, 45)), ("minus", "20 out 2026, 06h45", utc(2026, 10, 20, 9, 45)), ("minus", "7 nov 2026, 17h40", utc(2026, 11, 7, 20, 40)),
    ("minus", "1793373900000", 1793373900), ("minus", "1793373900", 1793373900), ("shift", "1793373900", 1793373900 + 5400), ("shift", "20261020064500", utc(2026, 10, 20, 9, 45) + 5400), ("word", "20261020064500", utc(2026, 10, 20, 8, 45)),
    ("lisbon", "20261025013000", in_zone("Europe/Lisbon", 2026, 10, 25, 1, 30)), ("york", "20261101013000", in_zone("America/New_York", 2026, 11, 1, 1, 30)), ("york", "20261101033000", in_zone("America/New_York", 2026, 11, 1, 3, 30)),
    ("none", "20261020064500", utc(2026, 10, 20, 6, 45)), ("blank", "20261020064500", utc(2026, 10, 20, 6, 45)), ("odd", "20261020064500", utc(2026, 10, 20, 6, 45)), ("unknown", "20261020064500", utc(2026, 10, 20, 6, 45)),
    (None, "20261020064500", utc(2026, 10, 20, 6, 45)), ("plus", "20280229120000", utc(2028, 2, 29, 12, 0)),
    *((("plus", v, None)) for v in (None, "", "   ", "null", "a definir", "--:--", "ontem 21h", "2026-11-??", "??/11/2026 20:30", "00000000000000", "20261399256100", "20260229120000", "31/11/2026 08:00", "20261020240000", "20261020066000", "2026-13-01 10:00", "123", "x" * 100_000, "2026102006" * 5)),
]


@pytest.fixture(scope="module")
def result(spark):
    src = spark.createDataFrame(SOURCES, "key string, default_offset string, timeshift_hours double").withColumn("utc", F.lit(1))
    rows = spark.createDataFrame([(i, s, v) for i, (s, v, _) in enumerate(CASES)], "raw_id bigint, source string, _start string").withColumns({"_stop": F.lit(None).cast("string"), "value": F.lit("x"), "_zone": F.lit("x")})
    return {r.raw_id: r.utc_s for r in instants.instants(rows, src).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_case(i, result):
    assert result.get(i) == CASES[i][2], CASES[i]


def test_empty(spark):
    src = spark.createDataFrame([], "key string, default_offset string, timeshift_hours double")
    rows = spark.createDataFrame([], "raw_id bigint, source string, _start string, _stop string")
    assert instants.instants(rows, src).count() == 0


def test_repeated_rows_and_sources(spark):
    src = spark.createDataFrame([("a", "+0000", 0.0), ("a", "+0000", 0.0)], "key string, default_offset string, timeshift_hours double")
    rows = spark.createDataFrame([(1, "a", "20261020064500", None)] * 2, "raw_id bigint, source string, _start string, _stop string")
    assert instants.instants(rows, src).count() == 2
