import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeweave.llm import leakage
from gradeweave.llm.words import resolved, word_spans, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 5), min_size=2, max_size=30), min_size=1, max_size=8), st.integers(1, 4))
def test_index_finds_every_occurrence(runs, size):
    index = leakage.FMIndex([np.array(r) for r in runs])
    grams = {tuple(r[i:i + size]) for r in runs for i in range(len(r) - size + 1)} | {tuple(random.choices(range(1, 7), k=size))}
    phrases = np.array(sorted(grams)).reshape(-1, size) if grams else np.zeros((0, size), int)
    which, lo, hi = index.search(phrases)
    found = {tuple(phrases[w]): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, lo, hi)}
    starts = index.starts
    want = {}
    for k, r in enumerate(runs):
        for i in range(len(r) - size + 1):
            want.setdefault(tuple(r[i:i + size]), []).append(int(starts[k]) + i)
    assert found == {g: sorted(v) for g, v in want.items()}


def brute(docs, items, n=10):
    grams = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - n + 1):
            grams.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = set()
    for d, t in docs:
        w = words(t)
        for k in range(len(w) - n + 1):
            out |= {(d, i) for i in grams.get(tuple(w[k:k + n]), ())}
    return out


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("d", "t", "item_id", "lang")})
    return d, spark.createDataFrame(items, "item_id bigint, text string")


ITEM = "um dois três quatro cinco seis sete oito nove dez onze doze treze quatorze"


def test_disguises_and_edges(spark):
    w = ITEM.split()
    docs = [(1, "antes " + " ".join(w[:10]) + " depois"), (2, " ".join(w[:9])), (3, "X: " + ", ".join(w[2:13]).upper() + "!"), (4, "\n".join(w)), (5, ITEM.replace("ê", "&ecirc;")), (6, None), (7, ""), (8, "  "),
            (9, " ".join(w[:5] + ["outra"] + w[5:])), (10, ITEM), (10, ITEM), (11, "palavra " * 60_000 + ITEM), (12, " ".join(x[:2] + "​" + x[2:] for x in w))]
    items = [(1, ITEM), (2, ITEM), (3, "curto demais"), (4, None), (None, ITEM)]
    d, i = frames(spark, docs, items)
    got = leakage.leaks(d, i)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(a, b) for a in (1, 3, 4, 5, 10, 11, 12) for b in (1, 2)} == brute([x for x in docs if x[1]], [(a, b) for a, b in items if a and b])
    clean = {r.doc_id: r.clean_text for r in leakage.without_leaks(d.filter("doc_id = 1"), got).collect()}
    assert clean == {1: "antes  depois"}


def test_random_against_brute_force(spark, monkeypatch):
    random.seed(5)
    vocabulary = [f"p{i}" for i in range(12)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.randint(5, 30)))) for i in range(20)]
    docs = [(i, " ".join(random.choices(vocabulary, k=20) + random.choice(items)[1].split()[:random.randint(0, 30)] + random.choices(vocabulary, k=20))) for i in range(120)]
    d, i = frames(spark, docs, items)
    for block in (3, 100):
        assert {(r.doc_id, r.item_id) for r in leakage.leaks(d, i, block_items=block).collect()} == brute(docs, items)


def test_spans_merge(spark):
    w = ITEM.split()
    d, i = frames(spark, [(1, "x " + " ".join(w) + " y " + " ".join(w[:10]))], [(1, ITEM)])
    got = sorted((r.first_word, r.last_word) for r in leakage.leaks(d, i).collect())
    assert got == [(1, 14), (16, 25)]


def test_empty(spark):
    d, i = frames(spark, [], [(1, ITEM)])
    assert leakage.leaks(d, i).count() == 0
    d, i = frames(spark, [(1, ITEM)], [])
    assert leakage.leaks(d, i).count() == 0


def test_word_spans():
    for t in ("A&eacute;b, c_d-e  ﬁm ½ x", "", None, "à é"):
        w, s = words(t), word_spans(t)
        assert len(w) == len(s)
        assert all(words(resolved(t)[a:b]) and x in words(resolved(t)[a:b]) for x, (a, b) in zip(w, s))
