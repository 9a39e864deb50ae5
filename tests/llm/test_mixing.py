from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from gradeweave.llm import mixing

DSHAPE = "doc_id bigint, text string, source string"
TSHAPE = "source string, target_share double, max_repeats int"


def docs(spark, per):
    rows, n = [], 0
    for s, k in per.items():
        for i in range(k):
            n += 1
            rows.append((n, f"{s} texto número {i} " + "palavra " * (5 + (i * 7) % 23), s))
    return rows


def test_shares_and_caps(spark):
    rows = docs(spark, {"a": 400, "b": 60, "c": 15})
    t = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 2), ("c", 0.1, 3)], TSHAPE)
    d = spark.createDataFrame(rows, DSHAPE).withColumns({c: F.lit(1) for c in ("h", "tokens", "cap", "rate", "copies", "posterior", "m", "b")})
    r = {x.source: x for x in mixing.report(d, t).collect()}
    for s, share, cap in (("a", 0.6, 1), ("b", 0.3, 2), ("c", 0.1, 3)):
        assert abs(r[s].actual_share - share) < 0.02 and abs(r[s].soft_share - share) < 0.03 and r[s].most_copies <= cap
    assert r["c"].tokens_used > 2.5 * r["c"].tokens  # the scarcest source is used up


def test_equal_texts_count_once(spark):
    rows = docs(spark, {"a": 50, "b": 50})
    rows += [(1000 + i, rows[0][1], "a") for i in range(40)] + [(2000, rows[0][1], "b"), (2001, None, "a"), (2002, "", "a"), (2003, "sem fonte", None), (2004, "fora", "z"), (None, "sem id", "a"), (2005, "muito " * 50_000, "a")]
    t = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1)], TSHAPE)
    got = mixing.mix(spark.createDataFrame(rows, DSHAPE), t).collect()
    texts = {i: x for i, x, _ in rows}
    used = Counter()
    for r in got:
        used[texts[r.doc_id]] += r.copies
    assert used[rows[0][1]] <= 2 and not {2000, 2001, 2002, 2003, 2004} & {r.doc_id for r in got}


def test_rounding_follows_the_rates(spark):
    u = spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), F.lit("a").alias("source"), F.lit(10).cast("bigint").alias("tokens"), F.lit(1.37).alias("rate"))
    r = mixing.rounded(u).agg(F.sum("copies").alias("n"), F.min("copies").alias("lo"), F.max("copies").alias("hi")).first()
    assert abs(r.n - 1370) <= 1 and (r.lo, r.hi) == (1, 2)


def test_empty(spark):
    t = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1)], TSHAPE)
    e = spark.createDataFrame([], DSHAPE)
    assert mixing.mix(e, t).count() == 0 and mixing.report(e, t).count() == 2
    assert mixing.mix(e, spark.createDataFrame([], TSHAPE)).count() == 0


def test_classifier_learns_sources():
    texts = [(s, f"{w} {w} comum {i % 7}") for i in range(300) for s, w in (("a", "futebol"), ("b", "novela"))]
    c = mixing.Classifier(texts, ["a", "b"])
    assert c.heat > 0 and c.posterior("futebol futebol")[0] > 0.9 and c.posterior("novela")[1] > 0.8
    assert abs(c.posterior("nada").sum() - 1) < 1e-9
    noise = mixing.Classifier([(s, f"igual {i}") for i in range(300) for s in "ab"], ["a", "b"])
    assert abs(noise.posterior("igual 5")[0] - 0.5) < 0.1 and 0.9 < noise.posterior("igual 5", "a")[0] < 0.97  # the label's own say
    assert c.posterior("futebol futebol futebol futebol", "b")[0] > 0.5  # words may outweigh a label


def test_codes_of_posteriors():
    c = mixing.Classifier([], ["a", "b", "c"])
    p = mixing.spread(np.array([c.code("x", "b")]), 3)[0]
    assert abs(p.sum() - 1) < 1e-9 and abs(p - c.posterior("x", "b")).max() < 0.04
    for k in (1, 2, 3, 8):
        codes = np.array([(0, q, min(1, k - 1), r) for q in range(mixing.LEVELS + 1) for r in range(mixing.LEVELS + 1 - q)])
        assert k == 1 or np.allclose(mixing.spread(codes, k).sum(axis=1)[codes[:, 1] + codes[:, 3] == mixing.LEVELS], 1)


def test_fit_meets_labels_and_nears_domains():
    rng = np.random.default_rng(2)
    label, cap, tokens = rng.integers(0, 3, 300), rng.integers(1, 4, 300).astype(float), rng.integers(10, 999, 300).astype(float)
    posterior = rng.dirichlet([1, 1, 1], 300) * 0.5 + 0.5 * np.eye(3)[label]
    want = np.array([0.5, 0.3, 0.2]) * min((tokens * cap)[label == k].sum() / s for k, s in enumerate((0.5, 0.3, 0.2)))
    rate, steps, converged = mixing.fit(label, cap, tokens, posterior, want)
    assert converged and (rate >= 0).all() and (rate <= cap + 1e-12).all()
    by_label = np.array([(rate * tokens)[label == k].sum() for k in range(3)])
    assert abs(by_label / want - 1).max() < 1e-6
    flat = np.concatenate([[want[k] / (tokens * cap)[label == k].sum()] for k in range(3)])[label] * cap
    off = lambda r: np.abs((r * tokens) @ posterior - want).sum()
    assert off(rate) < 0.7 * off(flat)


def test_tokens_are_closed(spark):
    """Uneven texts: the tokens used come within half a percent of the share, not only the copies."""
    rows = [(i, f"a{i} " + "palavra " * (1 + i % 11), "a") for i in range(500)] + [(1000 + i, f"b{i} " + "palavra " * (5 + 90 * (i % 5 == 0)), "b") for i in range(300)]
    t = spark.createDataFrame([("a", 0.9, 1), ("b", 0.1, 2)], TSHAPE)
    r = {x.source: x for x in mixing.report(spark.createDataFrame(rows, DSHAPE), t).collect()}
    assert all(abs(x.actual_share / x.target_share - 1) < 0.005 and x.converged for x in r.values()), r
