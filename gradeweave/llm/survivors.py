"""The best representative of each group of rows known to be the same airing (problem 7).

``best_rows`` takes every field from the first row with a value, in the order of higher vote weight, smaller priority,
later fetch, smaller id. No other row has a say in that, so nothing is aligned for it: it is one aggregation with
partial results, no ordered group.

``consensus`` aligns the values of a group and field progressively: each value's tokens are aligned with the profile of
those before it, which grows by a column wherever a token fits none. Tokens then vote in each column by the summed weight
of the sources, and the existing value closest to the outcome is taken. Votes by seniority, where a row outweighs all
rows after it together, can only give the row of ``best_rows`` at distance 0: they check that columns are followed
rightly through all chunks.

Groups of up to ``CHUNK`` rows are aligned in one step. Larger ones are cut into chunks whose profiles are
aligned with each other, ``FAN`` at a time; votes stay in rows and only follow the columns, so no task ever holds a
whole group. Alignments and distances are exact at every length (linear memory for long texts).

Defined results: NULL, blanks and stand-ins are no values; rows of unknown or NULL sources have weight 0 and come last
by priority; a NULL fetch time is the earliest; rows without a group or an id and groups of one row are left out; a
field in which no row of the group has a value gives no row; a value that stands alone is its own consensus; ties go to
the higher row of the order above, so to the smaller id; repeated rows count as rows; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import HOT_ROWS, HOT_SHARE, join_groups, materialise, small

FIELDS = ("title", "sub_title", "description", "season", "episode", "rating_badge")
#: What stands for a missing value, in small letters without accents and marks at its end.
STAND_INS = (
    "n/a", "n/d", "n/i", "na", "nd", "ni", "null", "none", "nil", "nan", "undefined", "tba", "sem titulo", "titulo indisponivel", "titulo nao disponivel", "no title", "untitled",
    "sem descricao", "descricao indisponivel", "descricao nao disponivel", "sem sinopse", "sinopse indisponivel", "sinopse nao disponivel", "no description", "no synopsis",
    "sem informacao", "sem informacoes", "nao informado", "indisponivel", "not available", "a definir", "a confirmar", "sin titulo", "sin descripcion",
)
#: Different values aligned in one step, and profiles aligned with each other in one step.
CHUNK, FAN = 64, 16
#: Pairs of tokens that a table of costs may have; longer texts are halved first, with the same outcome.
TABLE = 1_000_000
#: Up to so many pairs plain loops are faster than arrays.
SHORT = 600
ACCENTS, PLAIN = "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn"


def valued(value: Column) -> Column:
    """Whether a text is a value."""
    t = F.translate(F.lower(F.regexp_replace(value, r"(?U)^[\s\p{Z}​﻿]+|[\s\p{Z}​﻿.!]+$", "")), ACCENTS, PLAIN)
    marked = value.rlike(r"(?U)^\s*(?:\$?\{\{?[^{}]*\}\}?|<[^<>]*>|%[^%\s]*%|\[\[?[^\[\]]*\]\]?)\s*$")
    return value.isNotNull() & t.rlike(r"[\p{L}\p{N}]") & ~t.isin(*STAND_INS) & ~marked


def _ranked(rows: DataFrame, sources: DataFrame) -> DataFrame:
    dim = sources.filter("key IS NOT NULL").groupBy(F.col("key").alias("source")).agg(F.max("vote_weight").alias("w"), F.min("priority").alias("p"))
    return rows.filter("airing_id IS NOT NULL AND row_id IS NOT NULL").join(small(dim), "source", "left").withColumn(
        "order", F.struct(F.coalesce("w", F.lit(0.0)).alias("w"), (-F.coalesce("p", F.lit(2**31 - 1))).alias("p"),
                          F.coalesce(F.unix_micros("fetched_at"), F.lit(-(2**62))).alias("t"), (-F.col("row_id")).alias("i")))


def best_rows(rows: DataFrame, sources: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """airing_id, field, row_id of the row each field is taken from, for groups of two or more rows."""
    ranked = _ranked(rows.select("airing_id", "row_id", "source", "fetched_at", *fields), sources)
    flags = ranked.select("airing_id", "order", *(valued(F.col(f).cast("string")).alias(f) for f in fields))  # texts end here, before rows are sorted
    tops = [F.max(F.when(F.col(f), F.col("order"))).alias(f) for f in fields]
    groups = flags.groupBy("airing_id").agg(F.count("*").alias("n"), *tops).filter("n >= 2")
    pairs = F.filter(F.array(*(F.struct(F.lit(f).alias("field"), (-F.col(f"{f}.i")).alias("row_id")) for f in fields)), lambda x: x["row_id"].isNotNull())
    return groups.select("airing_id", F.inline(pairs))


def merged(rows: DataFrame, sources: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """airing_id, n_rows and the surviving value of each field, for every group."""
    ranked = _ranked(rows.select("airing_id", "row_id", "source", "fetched_at", *fields), sources)
    tops = [F.max_by(f, F.when(valued(F.col(f).cast("string")), F.col("order"))).alias(f) for f in fields]
    return ranked.groupBy("airing_id").agg(F.count("*").alias("n_rows"), *tops)


def _fold(token: str) -> str:
    return "".join(c for c in token.casefold() if c.isalnum()) or token


class _Costs:
    """Cost of each token against all tokens of another text: 0 if equal, a half where one is the cut-off other, else 1."""

    def __init__(self, b: list[str]):
        self.at: dict[str, list[int]] = {}
        for j, y in enumerate(b):
            self.at.setdefault(y, []).append(j)
        self.words, self.n, self.known = sorted(self.at), len(b), {}

    def row(self, x: str) -> np.ndarray:
        if x not in self.known:
            out = np.ones(self.n)
            if len(x) > 2:
                i = bisect_left(self.words, x)
                while i < len(self.words) and self.words[i].startswith(x):
                    out[self.at[self.words[i]]] = 0.5
                    i += 1
                for k in range(3, len(x)):
                    if x[:k] in self.at:
                        out[self.at[x[:k]]] = 0.5
            if x in self.at:
                out[self.at[x]] = 0.0
            if len(self.known) * self.n > 4 * TABLE:
                self.known.clear()
            self.known[x] = out
        return self.known[x]


def _next_row(last: np.ndarray, sub: np.ndarray, steps: np.ndarray) -> np.ndarray:
    new = np.empty_like(last)
    new[0] = last[0] + 1
    new[1:] = np.minimum(last[:-1] + sub, last[1:] + 1)
    return np.minimum.accumulate(new - steps) + steps


def _path(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """(i, j) of an alignment of least cost, in order; -1 for a gap."""
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    q = 0
    while q < min(len(a), len(b)) - p and a[-1 - q] == b[-1 - q]:
        q += 1
    n, m = len(a), len(b)
    return [(k, k) for k in range(p)] + [(i + p if i >= 0 else -1, j + p if j >= 0 else -1) for i, j in _inner(a[p:n - q], b[p:m - q])] + [(n - q + k, m - q + k) for k in range(q)]


def _inner(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    if not a or not b:
        return [(i, -1) for i in range(len(a))] + [(-1, j) for j in range(len(b))]
    if len(a) * len(b) > TABLE and len(a) > 1:
        half = len(a) // 2
        above, below = _last_row(a[:half], b), _last_row(a[half:][::-1], b[::-1])[::-1]
        cut = int(np.argmin(above + below))
        return _path(a[:half], b[:cut]) + [(i + half if i >= 0 else -1, j + cut if j >= 0 else -1) for i, j in _path(a[half:], b[cut:])]
    if len(a) * len(b) <= SHORT:
        sub = [[0.0 if x == y else 0.5 if (len(x) > 2 and y.startswith(x)) or (len(y) > 2 and x.startswith(y)) else 1.0 for y in b] for x in a]
        cost = [[float(j) for j in range(len(b) + 1)]]
        for i, costs in enumerate(sub):
            row, last = [i + 1.0], cost[-1]
            for j, c in enumerate(costs):
                row.append(min(last[j] + c, last[j + 1] + 1, row[j] + 1))
            cost.append(row)
    else:
        table, steps = _Costs(b), np.arange(len(b) + 1.0)
        sub = [table.row(x) for x in a]
        cost = np.empty((len(a) + 1, len(b) + 1))
        cost[0] = steps
        for i, costs in enumerate(sub):
            cost[i + 1] = _next_row(cost[i], costs, steps)
    i, j, out = len(a), len(b), []
    while i or j:
        if i and j and cost[i][j] == cost[i - 1][j - 1] + sub[i - 1][j - 1]:  # before gaps: no new column without need
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and cost[i][j] == cost[i - 1][j] + 1:
            i -= 1
            out.append((i, -1))
        else:
            j -= 1
            out.append((-1, j))
    return out[::-1]


def align(value: list[str], pivot: list[str]) -> list[tuple[int, str]]:
    """(column, token) of each token of the value: column 2j + 1 is the pivot's token j, column 2j stands before it."""
    out, at = [], 0
    for i, j in _path([_fold(t) for t in value], [_fold(t) for t in pivot]):
        if i >= 0:
            out.append((2 * j + 1 if j >= 0 else 2 * at, value[i]))
        at = j + 1 if j >= 0 else at
    return out


def _last_row(a: list[str], b: list[str]) -> np.ndarray:
    costs, steps = _Costs(b), np.arange(len(b) + 1.0)
    row = steps.copy()
    for x in a:
        row = _next_row(row, costs.row(x), steps)
    return row


def distance(value: list[str], other: list[str]) -> int:
    """Tokens to insert, delete or replace."""
    if value == other:
        return 0
    ids = {t: k for k, t in enumerate(dict.fromkeys(other))}
    b, steps = np.array([ids[t] for t in other], np.int64), np.arange(len(other) + 1.0)
    row = steps.copy()
    for x in value:
        row = _next_row(row, (b != ids.get(x, -1)).astype(float), steps)
    return int(row[-1])


def merge_columns(profile: list[tuple[str, float]], more: list[tuple[str, float]]) -> tuple[list[tuple[str, float]], list[int], list[int]]:
    """The joint profile (token and weight per column) and the new column of each column of the two.

    A column is known by its weightiest token; of two columns that meet, the weightier token stands for both.
    """
    path = _path([_fold(t) for t, _ in more], [_fold(t) for t, _ in profile])
    out, old, new = [], [0] * len(profile), [0] * len(more)
    for i, j in path:
        k = len(out)
        if i >= 0:
            new[i] = k
        if j >= 0:
            old[j] = k
        if i >= 0 and j >= 0:
            (t, w), (u, v) = profile[j], more[i]
            out.append((t if w >= v else u, w + v if _fold(t) == _fold(u) else max(w, v)))
        else:
            out.append(more[i] if j < 0 else profile[j])
    return out, old, new


def progressive(profiles: list[list[tuple[str, float]]]) -> tuple[list[tuple[str, float]], list[list[int]]]:
    """All profiles aligned one after the other; the column of each profile's columns in the joint one."""
    joint, maps = profiles[0], [list(range(len(profiles[0])))]
    for p in profiles[1:]:
        joint, old, new = merge_columns(joint, p)
        maps = [[old[c] for c in m] for m in maps] + [new]
    return joint, maps


def outcome(votes: dict[tuple[int, str], tuple[float, int]], total: float, seniority: bool) -> list[str]:
    """The tokens that win their columns. votes: (column, token) -> (weight, rank of its highest row, 0 the highest of all).

    By weight, a column counts if tokens in it have more than half of the weight; by seniority, if the highest row has a
    token there.
    """
    columns: dict[int, list] = {}
    for (c, t), (w, r) in votes.items():
        columns.setdefault(c, []).append((w, r, t))
    out = []
    for c in sorted(columns):
        v = columns[c]
        if seniority:
            w, r, t = min(v, key=lambda x: x[1])
            if r == 0:
                out.append(t)
        elif 2 * sum(x[0] for x in v) > total:
            out.append(max(v, key=lambda x: (x[0], x[2]))[2])
    return out


def _vote(values: list[str], weights: list[float], seniority: bool) -> tuple[int, int]:
    """Position and token distance of the chosen value; values come in the order of their highest rows."""
    tokens = [v.split() for v in values]
    _, maps = progressive([[(t, w) for t in x] for x, w in zip(tokens, weights)])
    votes: dict[tuple[int, str], tuple[float, int]] = {}
    for r, (x, m, w) in enumerate(zip(tokens, maps, weights)):
        for t, c in zip(x, m):
            old = votes.get((c, t), (0.0, r))
            votes[c, t] = (old[0] + w, old[1])
    agreed = outcome(votes, sum(weights), seniority)
    far = [distance(x, agreed) for x in tokens]
    best = min(range(len(values)), key=lambda i: (far[i], i if seniority else -weights[i], i))
    return best, far[best]


def _large(values: DataFrame, key: list[str], airing: str, seniority: bool, chunk: int) -> DataFrame:
    """Groups cut into chunks: ``values`` (airing_id, field, value, weight, order, top, total, n_values) with token_distance."""
    ranks = "order struct<w:double,p:int,t:bigint,i:bigint>"
    cut = values.withColumn("node", F.pmod(F.xxhash64("value"), F.ceil(F.col("n_values") * F.lit(2 / chunk)).cast("bigint")))
    node = [*key, "node"]
    pack = F.sort_array(F.collect_list(F.struct("order", "value", "weight")), asc=False).alias("v")

    def leaf(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for a, f, k, v in zip(p["airing_id"], p["field"], p["node"], p["v"]):
                tokens = [x["value"].split() for x in v]
                profile, maps = progressive([[(t, x["weight"]) for t in w] for w, x in zip(tokens, v)])
                items = [{"weight": x["weight"], "order": x["order"], "token": t, "own": c} for x, w, m in zip(v, tokens, maps) for t, c in zip(w, m)]
                out.append((a, f, k, [t for t, _ in profile], [w for _, w in profile], items))
            yield pd.DataFrame(out, columns=["airing_id", "field", "node", "tokens", "weights", "items"])

    shape = f"airing_id {airing}, field string, node bigint, tokens array<string>, weights array<double>, items array<struct<weight:double,{ranks.replace(' ', ':', 1)},token:string,own:int>>"
    leaves = materialise(cut.groupBy(*node).agg(pack).mapInPandas(leaf, shape))
    level = leaves.select(*key, "node", F.col("node").alias("now"), "tokens", "weights", F.transform("tokens", lambda _, i: i).alias("map"))

    def branch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for a, f, up, v in zip(p["airing_id"], p["field"], p["up"], p["v"]):
                joint, maps = progressive([list(zip(x["tokens"], x["weights"])) for x in v])
                out += [(a, f, up, x["now"], [t for t, _ in joint], [w for _, w in joint], m) for x, m in zip(v, maps)]
            yield pd.DataFrame(out, columns=["airing_id", "field", "up", "now", "tokens", "weights", "step"])

    up_shape = f"airing_id {airing}, field string, up bigint, now bigint, tokens array<string>, weights array<double>, step array<int>"
    while (level.agg(F.max("now")).first()[0] or 0) > 0:  # a row per chunk; FAN chunks become one
        heads = level.groupBy(*key, "now").agg(F.first("tokens").alias("tokens"), F.first("weights").alias("weights"))
        joint = heads.withColumn("up", F.expr(f"now div {FAN}")).groupBy(*key, "up").agg(F.sort_array(F.collect_list(F.struct("now", "tokens", "weights"))).alias("v")).mapInPandas(branch, up_shape)
        level = materialise(level.drop("tokens", "weights").join(joint, [*key, "now"]).select(
            *key, "node", F.col("up").alias("now"), "tokens", "weights", F.expr("transform(map, c -> step[c])").alias("map")))
    votes = leaves.select(*node, "items").join(level.select(*node, "map"), node).select(*key, "map", F.inline("items")).groupBy(
        *key, F.expr("map[own]").alias("col"), "token").agg(F.sum("weight").alias("w"), F.max("order").alias("order"))
    facts = values.select(*key, "n_values", "top", "total").distinct()
    votes = votes.join(facts, key)
    if seniority:
        won = votes.filter(F.col("order") == F.col("top")).groupBy(*key, "col").agg(F.min("token").alias("token"))
    else:
        won = votes.groupBy(*key, "col").agg(F.max(F.struct("w", "token")).alias("m"), F.sum("w").alias("present"), F.max("total").alias("total")).filter("2 * present > total").select(*key, "col", F.col("m.token").alias("token"))
    agreed = won.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("col", "token"))), lambda x: x["token"]).alias("agreed"))

    @F.pandas_udf("int")
    def far(value: pd.Series, tokens: pd.Series) -> pd.Series:
        return pd.Series([distance(v.split(), list(t) if t is not None else []) for v, t in zip(value, tokens)])

    sized = facts.select(*key, "n_values").join(agreed, key, "left")
    return join_groups(values.drop("n_values"), sized, key, "n_values", values.count()).withColumn("token_distance", far("value", "agreed"))


def _of_rows(values: list, weights: list, seniority: bool) -> tuple[int, float, int] | None:
    """Position of the chosen value's highest row, share of its weight, token distance; rows come in their order."""
    first: dict[str, int] = {}
    weight: dict[str, float] = {}
    for i, (v, w) in enumerate(zip(values, weights)):
        if v is not None:
            first.setdefault(v, i)
            weight[v] = weight.get(v, 0.0) + w
    if not first:
        return None
    texts = list(first)
    best, far = _vote(texts, list(weight.values()), seniority) if len(texts) > 1 else (0, 0)
    return first[texts[best]], weight[texts[best]] / sum(weight.values()), far


def _small(rows: DataFrame, fields: Sequence[str], airing: str, seniority: bool) -> DataFrame:
    """``consensus`` of groups whose rows fit into one step; rows: airing_id, order and the valued fields as texts."""
    packed = rows.groupBy("airing_id").agg(F.sort_array(F.collect_list(F.struct("order", *fields)), asc=False).alias("v"))

    def choose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for airing_id, v in zip(p["airing_id"], p["v"]):
                weights = [max(x["order"]["w"], 0.01) for x in v]
                for f in fields:
                    got = _of_rows([x[f] for x in v], weights, seniority)
                    if got:
                        out.append((airing_id, f, -v[got[0]]["order"]["i"], v[got[0]][f], got[1], got[2]))
            yield pd.DataFrame(out, columns=["airing_id", "field", "row_id", "value", "support", "token_distance"])

    return packed.mapInPandas(choose, f"airing_id {airing}, field string, row_id bigint, value string, support double, token_distance int")


def consensus(rows: DataFrame, sources: DataFrame, fields: Sequence[str] = FIELDS, seniority: bool = False, chunk: int = CHUNK) -> DataFrame:
    """airing_id, field, row_id, value, support, token_distance: the value closest to the group's voted tokens.

    support is the share of the weight whose value is the chosen one. Rows are shuffled once, by their group.
    ``seniority`` is for tests only: the outcome is known then, whatever the alignment.
    """
    airing = dict(rows.dtypes)["airing_id"]
    key = ["airing_id", "field"]
    ranked = _ranked(rows.select("airing_id", "row_id", "source", "fetched_at", *fields), sources).select(
        "airing_id", "order", *(F.when(valued(F.col(f).cast("string")), F.col(f).cast("string")).alias(f) for f in fields))
    sizes = ranked.groupBy("airing_id").agg(F.count("*").alias("n"))
    big = materialise(sizes.filter(F.col("n") > chunk))
    total = big.agg(F.sum("n")).first()[0] or 0
    hot = max(HOT_ROWS, int(total * HOT_SHARE))  # fewer than 1 / HOT_SHARE groups: their rows are not shuffled just to be left out
    light = ranked.join(F.broadcast(big.filter(F.col("n") > hot).select("airing_id")), "airing_id", "left_anti") if total > hot else ranked
    out = _small(light.join(sizes.filter(F.col("n").between(2, chunk)), "airing_id", "left_semi"), fields, airing, seniority)
    if total:
        held = join_groups(ranked, big, ["airing_id"], "n", total)
        long = held.select("airing_id", "order", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))).alias("v"))
        long = long.select("airing_id", "v.*", "order").filter("value IS NOT NULL")
        values = materialise(long.groupBy(*key, "value").agg(F.sum(F.greatest(F.col("order.w"), F.lit(0.01))).alias("weight"), F.max("order").alias("order")))
        groups = values.groupBy(*key).agg(F.sum("weight").alias("total"), F.max("order").alias("top"), F.count("*").alias("n_values"))
        many = materialise(join_groups(values, groups, key, "n_values", values.count()))
        prefer = [F.lit(0.0)] if seniority else [F.col("weight")]
        best = _large(many, key, airing, seniority, chunk).groupBy(*key).agg(
            F.max_by(F.struct("order", "value", "weight", "total", "token_distance"), F.struct((-F.col("token_distance")).alias("d"), *prefer, "order")).alias("b")).select(*key, "b.*")
        out = out.unionByName(best.select(*key, (-F.col("order.i")).alias("row_id"), "value", (F.col("weight") / F.col("total")).alias("support"), "token_distance"))
    return out.withColumn("support", F.round("support", 4))
