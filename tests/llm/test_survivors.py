import random

from pyspark.sql import functions as F

from gradeweave.llm import survivors

SHAPE = "row_id bigint, airing_id bigint, source string, title string, sub_title string, description string, season int, episode int, rating_badge string, f bigint"
SOURCES = [("a", 1, 0.5), ("b", 2, 1.0), ("c", 3, 1.0), ("d", None, None)]


def frames(spark, rows):
    df = spark.createDataFrame(rows, SHAPE).withColumn("fetched_at", F.timestamp_seconds("f")).withColumns({c: F.lit(1) for c in ("w", "p", "order", "n", "value", "field")})
    return df, spark.createDataFrame(SOURCES, "key string, priority int, vote_weight double").withColumn("w", F.lit(1))


def is_value(v):
    if v is None:
        return False
    t = str(v).strip(" \t\n.\xa0").lower()
    return any(c.isalnum() for c in t) and t not in ("n/a", "null", "sem título", "sem sinopse", "none") and not str(v).startswith("{{")


def brute(rows):
    rank = {k: (-(w or 0), p if p is not None else 2**31) for k, p, w in SOURCES}
    out = set()
    for g in {r[1] for r in rows if r[1] is not None}:
        members = [r for r in rows if r[1] == g and r[0] is not None]
        if len(members) < 2:
            continue
        for i, f in enumerate(survivors.FIELDS):
            ok = [r for r in members if is_value(r[3 + i])]
            if ok:
                best = min(ok, key=lambda r: (*rank.get(r[2], (0, 2**31)), -(r[9] if r[9] is not None else -(2**62)), r[0]))
                out.add((g, f, best[0]))
    return out


def test_brute_force(spark):
    random.seed(3)
    texts = [None, "", "  ", " ", "--", "?", "...", "N/A", "null", "Sem título", "SEM SINOPSE", "{{title}}", "Jornal", "JORNAL", "Jornal HD", "x" * 50_000]
    rows = [(i, random.choice([None, 1, 2, 3, 4, 5 + i]), random.choice(["a", "b", "c", "d", "z", None]), *random.choices(texts, k=3), random.choice([None, 1, 2]), random.choice([None, 5]), random.choice(["L", "-", None, " 14 "]), random.choice([None, 5, 6])) for i in range(300)]
    df, src = frames(spark, rows)
    assert {tuple(r) for r in survivors.best_rows(df, src).collect()} == brute(rows)


def test_empty(spark):
    df, src = frames(spark, [])
    assert survivors.best_rows(df, src).count() == survivors.merged(df, src).count() == survivors.consensus(df, src).count() == 0


def test_consensus(spark):
    t = lambda i, s, title: (i, 1, s, title, None, None, None, None, None, i)
    df, src = frames(spark, [t(1, "b", "O Farol do Nort"), t(2, "c", "O Farol do Norte"), t(3, "a", "O Farol do Norte"), t(4, "a", "O Barco do Norte"), t(5, "c", "n/a"), (6, 2, "a", "só um", *[None] * 6)])
    got = {(r.airing_id, r.field): (r.value, r.token_distance) for r in survivors.consensus(df, src).collect()}
    assert got == {(1, "title"): ("O Farol do Norte", 0)}


def test_consensus_of_a_large_group(spark):
    random.seed(1)
    base = "um dois tres quatro cinco seis".split()
    rows = []
    for i in range(400):
        w = list(base)
        if i % 3:
            w[random.randrange(6)] = random.choice("xyz")
        rows.append((i, 7, "b", " ".join(w), *[None] * 6))
    df, src = frames(spark, rows)
    r = survivors.consensus(df, src).collect()
    assert [(x.value, x.token_distance) for x in r] == [(" ".join(base), 0)]


def test_groups_in_chunks(spark):
    """Groups cut into chunks: by seniority every field comes from its first valued row, whatever the chunks."""
    random.seed(4)
    base = "um dois tres quatro cinco seis sete oito".split()
    rows = []
    for i in range(700):
        w = list(base)
        for _ in range(random.randrange(4)):
            k = random.randrange(len(w))
            w[k:k + 1] = random.choice([[], [w[k], "extra"], [random.choice("xyzuvw")]])
        rows.append((i, i % 2, random.choice("abcdz"), " ".join(w), random.choice([None, "Um  dois", "um dois", "tres"]), None, None, None, None, random.choice([None, 5, 6])))
    df, src = frames(spark, rows)
    for chunk in (2, 5, 64):
        got = survivors.consensus(df, src, seniority=True, chunk=chunk).collect()
        assert {(r.airing_id, r.field, r.row_id) for r in got} == brute(rows) and all(r.token_distance == 0 for r in got)
    # progressive alignment is no optimum over all values: votes may miss a token, the outcome stays next to the base
    assert all(survivors.distance(r.value.split(), base) <= 1 for r in survivors.consensus(df, src, ("title",), chunk=5).collect())
    assert {r.value for r in survivors.consensus(df, src, ("title",), chunk=1000).collect()} == {" ".join(base)}


def test_best_rows_align_nothing(spark):
    """The first row with a value needs no other value: no Python step, whatever the size of the group, and no say of the many."""
    t = lambda i, g, s, title: (i, g, s, title, *[None] * 5, 5)
    rows = [t(0, 1, "b", "Um Barco"), *(t(i, 1, "a", "O Farol do Norte") for i in range(1, 200)), t(200, 2, "b", "n/a"), t(201, 2, "a", "O Farol"), t(202, 2, "d", "O Barco"), t(203, 3, "b", "só um")]
    df, src = frames(spark, rows)
    best = survivors.best_rows(df, src)
    assert {tuple(r) for r in best.collect()} == brute(rows) == {(1, "title", 0), (2, "title", 201)}
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan and plan.count("Window") == 0
    assert {(r.airing_id, r.value) for r in survivors.consensus(df, src).collect()} == {(1, "O Farol do Norte"), (2, "O Farol")}


def test_exact_at_every_length():
    """Halving long texts and plain loops give the cost of the full table, also beyond its size."""
    random.seed(9)

    def cost(a, b):
        row = [float(j) for j in range(len(b) + 1)]
        for i, x in enumerate(a, 1):
            last, row = row, [float(i)]
            for j, y in enumerate(b, 1):
                row.append(min(last[j - 1] + (0 if x == y else 0.5 if (len(x) > 2 and y.startswith(x)) or (len(y) > 2 and x.startswith(y)) else 1), last[j] + 1, row[j - 1] + 1))
        return row[-1]

    def paid(a, b, path):
        assert [i for i, _ in path if i >= 0] == list(range(len(a))) and [j for _, j in path if j >= 0] == list(range(len(b)))
        return sum(1 if i < 0 or j < 0 else cost([a[i]], [b[j]]) for i, j in path)

    words = ["farol", "faro", "far", "norte", "nor", "n", "mar", "maré", "x"]
    for size, table in ((4, 10), (30, 10**6), (60, 50), (60, 10**6), (80, 500)):
        for _ in range(5):
            a, b = (random.choices(words, k=random.randrange(1, size)) for _ in "ab")
            survivors.TABLE, kept = table, survivors.TABLE
            try:
                assert paid(a, b, survivors._path(a, b)) == cost(a, b)
            finally:
                survivors.TABLE = kept
            assert survivors.distance(a, b) >= cost(a, b)
    long = [str(i * 7919 % 4001) for i in range(6000)]
    assert survivors.distance(long, long[:3000] + ["novo"] + long[3001:]) == 1


def test_alignment():
    assert survivors.align("a x b".split(), "a b".split()) == [(1, "a"), (2, "x"), (3, "b")]
    assert survivors.align("b".split(), "a b".split()) == [(3, "b")]
    long = [str(i) for i in range(3000)]
    assert survivors.align(long, long) == [(2 * i + 1, x) for i, x in enumerate(long)] and survivors.distance(long, long[1:]) == 1
