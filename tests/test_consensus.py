"""Agreement of titles that are neither equal nor contained."""

from difflib import SequenceMatcher

from pyspark.sql import functions as F

from gradeweave.operators import consensus as C
from gradeweave.plans import consensus_queries as Q

TITLES = ["JORNAL DA NOITE", "CINE BODEGAVO", "A CASA DO VALE", "MESA REDONDA", "ARQUIVO AZUL"]
TYPOS = ["JORNAL DA NIOTE", "CINE BODEGVAO", "A CASA DO VAEL", "MESA REDODNA", "ARQIUVO AZUL"]


def rows(spark, shift_h=0):
    out = [(i, "a", "X", i * 3600, i * 3600 + 3600, t) for i, t in enumerate(TITLES)]
    out += [(10 + i, "b", "X", (i + shift_h) * 3600, (i + shift_h) * 3600 + 3600, t) for i, t in enumerate(TYPOS)]
    return spark.createDataFrame(out, "row_id bigint, source string, entry string, s bigint, e bigint, norm string")


def test_typos_agree_by_ratio(spark):
    got = {(r.a, r.b): r for r in C.shifted(rows(spark), exact=False).collect()}
    want = sum(SequenceMatcher(None, a, b).ratio() for a, b in zip(TITLES, TYPOS)) / len(TITLES)
    assert got["a", "b"].agreement == 1.0 and got["a", "b"].similarity == round(want, 4)
    assert {r.agreement for r in C.shifted(rows(spark)).collect()} == {0.0}


def test_typos_show_a_shift(spark):
    got = {(r.a, r.b): (r.shift, r.agreement) for r in C.shifted(rows(spark, 1), exact=False).collect()}
    assert got == {("a", "b"): (-1, 1.0), ("b", "a"): (1, 1.0)}


def test_timelines_use_ratios(spark, monkeypatch):
    """The rows of a source whose titles differ by typos are aligned, voted on and supported."""
    r = rows(spark).withColumn("channel_id", F.lit("x"))
    cands = r.select("entry", "source", "channel_id").distinct()
    monkeypatch.setattr(Q, "_candidates", lambda spark, sf_dir: (r, cands))
    monkeypatch.setattr(Q, "load", lambda *a: None)
    monkeypatch.setattr(Q.C, "near_window", lambda r: r)
    monkeypatch.setattr(Q.C, "evaluated", lambda cands, pairs, sources: pairs)
    assert {p.agreement for p in Q.evaluations(spark, "")[1].collect()} == {1.0}
    assert {p.agreement for p in Q.evaluations(spark, "", exact=True)[1].collect()} == {0.0}
