"""Mixing sources to target shares of all tokens (problem 9).

Every different text is one unit. A classifier of hashed words, fitted on a bounded number of labelled texts per source
and calibrated on held-out ones, gives each unit a posterior over the sources; its label is one more observation, wrong
with a probability of ``LABEL_NOISE``, so words that are sure enough outweigh it. Projected gradient
steps fit a rate between 0 and its cap to each unit by least squares: they bring the expected tokens of every domain as
near to its share as they can, and the projection keeps the tokens of every label at their share of the largest total
that the caps allow, since shares are due by label. Units of one label, cap and posterior take the same steps, so one
distributed sum over all units is all that the steps need. Rates become whole copies by systematic rounding in hash
buckets; a few single copies then close what tokens are left to each label's share.

Defined results: NULL and empty texts and sources without a target are not used; a text that occurs several times, or in
several sources, is one unit of the source of its smallest id; caps of NULL or less than 1 mean once; targets are scaled
to add up to 1; an empty table gives an empty mix and a report without tokens; texts of any length are counted whole.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialise, small

#: Where the vocabulary is; the setting of this name on the session counts before it.
TOKENIZER, TOKENIZER_SETTING = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken", "spark.gradeweave.tokenizer"
#: The splitting pattern published with byte-level BPE vocabularies of this kind.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Labelled texts per source that the classifier is fitted on, and held out. Only their word counts reach the driver.
TRAIN_TEXTS, HELD_OUT = 2_000, 500
FEATURES = 1 << 14
#: Words of common text that each source's counts are smoothed with.
SMOOTHING = 300
HEATS = (0.0, 0.003, 0.01, 0.03, 0.1, 0.3, 1.0)
#: How often a text is taken to be labelled with another source than its own.
LABEL_NOISE = 0.05
#: Posteriors are kept as the two likeliest sources in steps of 1 / LEVELS; the others share the rest.
LEVELS = 32
#: Steps end when one lowers the squared miss by less than this share of it, or the miss is this share of the total.
STEPS, GAIN, TOLERANCE = 5_000, 1e-6, 1e-6
#: Units that are rounded in one run.
BUCKET_UNITS = 50_000
#: Texts per source that are looked at to close what rounding leaves open, rounds of doing so, and the share of a source's tokens that may stay open.
CLOSERS, FIXES, OPEN = 300, 12, 2e-4
MICRO = 1_000_000
#: Texts whose measures a task remembers, so that repeated ones are tokenised once a task.
REMEMBERED = 50_000

_ENCODERS: dict[int, object] = {}


def _encoder(ranks: bytes):
    """The tokenizer of a vocabulary file's content, built once per Python process."""
    key = hash(ranks)
    if key not in _ENCODERS:
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        _ENCODERS[key] = tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _ENCODERS[key]


def hashed_words(text: str) -> np.ndarray:
    return np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % FEATURES for w in re.findall(r"\w+", text.lower())], np.int64)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of the whole text and how often each occurs: at most FEATURES numbers, however long it is."""
    ids, n = np.unique(hashed_words(text), return_counts=True)
    return ids, n


class Classifier:
    """Multinomial naive Bayes on hashed words with a temperature calibrated on held-out texts.

    rows: (source, text or its ``features``).
    """

    def __init__(self, rows: list[tuple[str, object]], labels: list[str]):
        self.labels = labels
        at = {s: i for i, s in enumerate(labels)}
        rows = [(at[s], features(x) if isinstance(x, str) else x) for s, x in rows]
        counts = np.zeros((len(labels), FEATURES))
        for k, (ids, n) in (x for i, x in enumerate(rows) if i % 5):
            counts[k, ids] += n
        # sources lean on what all have in common, the more the fewer words they have: rare sources are not at a loss
        common = (counts.sum(axis=0) + 0.01) / (counts.sum() + 0.01 * FEATURES)
        self.log = np.log((counts + SMOOTHING * common) / (counts.sum(axis=1, keepdims=True) + SMOOTHING))
        held = [(k, self._scores(x)) for i, (k, x) in enumerate(rows) if i % 5 == 0][: HELD_OUT * len(labels)]
        # the temperature under which the held-out labels are likeliest; 0 leaves the words without a say
        loss = lambda h: sum(np.logaddexp.reduce(h * x) - h * x[k] for k, x in held)
        self.heat = min(HEATS, key=loss) if held else 0.0

    def _scores(self, x: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        ids, n = x
        return self.log[:, ids] @ n if len(ids) else np.zeros(len(self.labels))

    def posterior(self, text: str, label: str | None = None) -> np.ndarray:
        s = self.heat * self._scores(features(text))
        if label in self.labels and len(self.labels) > 1:
            s[self.labels.index(label)] += np.log((1 - LABEL_NOISE) / LABEL_NOISE * (len(self.labels) - 1))
        p = np.exp(s - s.max())
        return p / p.sum()

    def code(self, text: str, label: str | None = None) -> tuple[int, int, int, int]:
        """The two likeliest sources with their levels."""
        p = self.posterior(text, label)
        if len(p) == 1:
            return 0, LEVELS, 0, 0
        a, b = np.argsort(-p, kind="stable")[:2]
        q = int(round(LEVELS * p[a]))
        return int(a), q, int(b), min(int(round(LEVELS * p[b])), LEVELS - q)


def spread(codes: np.ndarray, k: int) -> np.ndarray:
    """Posteriors of rows of codes."""
    out = np.zeros((len(codes), k))
    if k > 2:
        out += ((LEVELS - codes[:, 1] - codes[:, 3]) / LEVELS / (k - 2))[:, None]
    at = np.arange(len(codes))
    if k > 1:
        out[at, codes[:, 2]] = codes[:, 3] / LEVELS
    out[at, codes[:, 0]] = codes[:, 1] / LEVELS if k != 2 else 1 - out[at, codes[:, 2]]
    return out


def _training(rows: DataFrame, counts: dict[str, int]) -> list[tuple[str, tuple[np.ndarray, np.ndarray]]]:
    """Word counts of at most TRAIN_TEXTS + HELD_OUT different texts per source, those of the smallest hashes, in one pass."""
    if not counts:
        return []
    most = TRAIN_TEXTS + HELD_OUT
    part = rows.withColumn("x", F.xxhash64("text"))
    few = part.filter(_hash_share("x", counts, most)).groupBy("source", "x").agg(F.min("text").alias("text"))
    top = few.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("x"))).filter(F.col("r") <= most)  # some 2 * most per source

    def words(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            f = [features(t) for t in p["text"]]
            yield pd.DataFrame({"source": p["source"], "x": p["x"], "ids": [a for a, _ in f], "n": [b for _, b in f]})

    got = top.select("source", "x", "text").mapInPandas(words, "source string, x bigint, ids array<bigint>, n array<bigint>").collect()
    return [(r.source, (np.array(r.ids, np.int64), np.array(r.n, np.int64))) for r in sorted(got, key=lambda r: r.x)]


def units(docs: DataFrame, targets: DataFrame, tokenizer: str | None = None) -> tuple[DataFrame, list[tuple[str, float, int]]]:
    """One row per different text: h, doc_id, source, cap, tokens, code of the posterior; and (source, share, cap) of the targets."""
    goal = [(r.source, float(r.target_share or 0), max(int(r.max_repeats or 1), 1)) for r in targets.filter("source IS NOT NULL").orderBy("source").collect()]
    whole = sum(s for _, s, _ in goal) or 1.0
    goal = [(n, s / whole, c) for n, s, c in goal]
    labels = [n for n, _, _ in goal]
    rows = docs.filter("text IS NOT NULL AND text != '' AND doc_id IS NOT NULL").select("doc_id", "source", "text").filter(F.col("source").isin(labels))
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    shape = f"h string, doc_id {kind}, source string, tokens bigint, k1 int, q1 int, k2 int, q2 int"
    if not labels:
        return spark.createDataFrame([], shape + ", cap int"), goal
    counts = {r.source: r.n for r in rows.groupBy("source").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")).collect()}
    model = spark.sparkContext.broadcast(Classifier(_training(rows, counts), labels))
    path = tokenizer or spark.conf.get(TOKENIZER_SETTING, TOKENIZER)
    with open(path, "rb") as f:
        ranks = spark.sparkContext.broadcast(f.read())

    def measure(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, known = _encoder(ranks.value), {}
        for p in parts:
            out = []
            for h, t, s in zip(p["h"], p["text"], p["source"]):
                if (h, s) not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[h, s] = (len(enc.encode_ordinary(t)), *model.value.code(t, s))
                out.append(known[h, s])
            yield pd.concat([p[["h", "doc_id", "source"]], pd.DataFrame(out, columns=["tokens", "k1", "q1", "k2", "q2"], index=p.index)], axis=1)

    seen = rows.withColumn("h", F.sha2("text", 256)).mapInPandas(measure, shape)
    first = seen.groupBy("h").agg(F.min(F.struct("doc_id", "source", "tokens", "k1", "q1", "k2", "q2")).alias("u")).select("h", "u.*")
    caps = spark.createDataFrame([(n, c) for n, _, c in goal], "source string, cap int")
    return materialise(first.join(F.broadcast(caps), "source")), goal  # a row per target


def _onto(r: np.ndarray, share: np.ndarray, cap: np.ndarray, label: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """The nearest rates between 0 and the caps that use ``goal`` of each label's tokens (in the metric of tokens): one
    shift per label, by Newton's steps within shrinking bounds, as the tokens used grow in straight pieces with it."""
    k = len(goal)
    lo, hi = np.full(k, -cap.max() - r.max() - 1), np.full(k, cap.max() - r.min() + 1)
    shift = np.zeros(k)
    for _ in range(80):
        x = r + shift[label]
        inside = (x > 0) & (x < cap)
        gap = goal - np.bincount(label, np.clip(x, 0, cap) * share, k)
        if np.abs(gap).max() <= 1e-13:
            break
        lo, hi = np.where(gap > 0, shift, lo), np.where(gap < 0, shift, hi)
        slope = np.bincount(label, share * inside, k)
        newton = shift + gap / np.maximum(slope, 1e-300)
        shift = np.where((slope > 0) & (newton > lo) & (newton < hi), newton, np.where(gap == 0, shift, (lo + hi) / 2))
    return np.clip(r + shift[label], 0, cap)


def fit(label: np.ndarray, cap: np.ndarray, tokens: np.ndarray, posterior: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, int, bool]:
    """Rates of cells, steps taken, and whether they converged: least squares of the expected totals per domain against
    ``want``, by accelerated gradient steps projected onto the caps and the totals per label."""
    share = tokens / max(tokens.sum(), 1)
    goal = want / max(tokens.sum(), 1)

    project = lambda r: _onto(r, share, cap, label, goal)
    rate = project(np.zeros(len(tokens)))
    miss = lambda r: (r * share) @ posterior - goal
    # in the metric of tokens the gradient of a rate is posterior @ miss; its curvature is at most the largest eigenvalue
    curve = max(float(np.linalg.eigvalsh((posterior * share[:, None]).T @ posterior).max()), 1e-12) if len(tokens) else 1.0
    ahead, last, pace, step = rate, float((miss(rate) ** 2).sum()), 1.0, 0
    for step in range(1, STEPS + 1):
        new = project(ahead - posterior @ miss(ahead) / curve)
        now = float((miss(new) ** 2).sum())
        if now > last:  # start the momentum anew
            if ahead is rate:
                return rate, step, True
            ahead, pace = rate, 1.0
            continue
        if now <= (TOLERANCE * goal.sum()) ** 2 or last - now <= GAIN * last:
            return new, step, True
        nxt = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, rate, last, pace = new + (pace - 1) / nxt * (new - rate), new, now, nxt
    return rate, step, False


CELL = ["source", "cap", "k1", "q1", "k2", "q2"]


def fitted(docs: DataFrame, targets: DataFrame, tokenizer: str | None = None) -> tuple[DataFrame, list[tuple[str, float, int]], dict]:
    """Units with ``rate``; targets; facts of the fit."""
    u, goal = units(docs, targets, tokenizer)
    k, names = len(goal), [n for n, _, _ in goal]
    cells = u.groupBy(*CELL).agg(F.sum("tokens").alias("t")).orderBy(*CELL).collect()  # at most k * k * k * LEVELS * LEVELS / 2 rows
    room = {n: sum(r.t * r.cap for r in cells if r.source == n) for n in names}
    total = min((room[n] / s for n, s, _ in goal if s > 0), default=0.0)
    facts = {"total": total, "steps": 0, "converged": True, "soft": dict.fromkeys(names, 0.0)}
    if total <= 0 or not cells:
        return u.withColumn("rate", F.lit(0.0)), goal, facts
    want = np.array([s * total for _, s, _ in goal])
    label, cap, tokens = np.array([names.index(r.source) for r in cells]), np.array([float(r.cap) for r in cells]), np.array([float(r.t) for r in cells])
    posterior = spread(np.array([[r.k1, r.q1, r.k2, r.q2] for r in cells]), k)
    rate, facts["steps"], facts["converged"] = fit(label, cap, tokens, posterior, want)
    facts["soft"] = dict(zip(names, ((rate * tokens) @ posterior).tolist()))
    table = docs.sparkSession.createDataFrame([(*r[:6], float(x)) for r, x in zip(cells, rate)], "source string, cap int, k1 int, q1 int, k2 int, q2 int, rate double")
    return u.join(small(table), CELL), goal, facts


def rounded(units_with_rate: DataFrame) -> DataFrame:
    """Adds ``copies``: within each source the running sum of copies follows that of the rates to less than one copy.

    Units are cut into hash buckets of about BUCKET_UNITS, each rounded by itself from where the one before it ends.
    """
    n = {r.source: r.n for r in units_with_rate.groupBy("source").agg(F.count("*").alias("n")).collect()}
    buckets = F.create_map(*(F.lit(v) for s, c in n.items() for v in (s, -(-c // BUCKET_UNITS)))) if n else F.lit(None).cast("map<string,int>")
    r = units_with_rate.withColumn("m", F.round(F.col("rate") * MICRO).cast("bigint")).withColumn("b", F.pmod(F.xxhash64("h"), buckets[F.col("source")].cast("bigint")))
    sums = r.groupBy("source", "b").agg(F.sum("m").alias("s"))
    before = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    offsets = sums.select("source", "b", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "b").orderBy("tokens", "h").rowsBetween(Window.unboundedPreceding, 0)
    run = r.withColumn("run", F.sum("m").over(inside)).join(small(offsets), ["source", "b"])
    return run.withColumn("copies", F.expr(f"(offset + run) div {MICRO} - (offset + run - m) div {MICRO}")).drop("m", "b", "run", "offset")


def _hash_share(column: str, rows: dict[str, int], most: int):
    """Whether a hash is among about 2 * ``most`` of its source, by the source's number of rows."""
    edges = (v for s, n in rows.items() for v in (s, int(min(2**63 - 1, -(2**63) + 2 * most / max(n, 1) * 2**64))))
    return F.col(column) <= F.create_map(*(F.lit(v) for v in edges))[F.col("source")]


def closing_moves(tokens: np.ndarray, copies: np.ndarray, cap: np.ndarray, left: float, good: float) -> np.ndarray:
    """Changes of copies that bring ``left`` tokens next to 0: single copies and pairs of them, each the best there is."""
    move = np.zeros(len(tokens), np.int64)
    for _ in range(FIXES):
        if abs(left) <= good or not len(tokens):
            break
        can_add, can_drop = np.flatnonzero(copies + move < cap), np.flatnonzero(copies + move > 0)
        at = np.concatenate([can_add, can_drop])
        gain = np.concatenate([tokens[can_add], -tokens[can_drop]]).astype(float)
        sign = np.concatenate([np.ones(len(can_add), int), -np.ones(len(can_drop), int)])
        if not len(at):
            break
        both = np.abs(left - gain[:, None] - gain[None, :])
        both[at[:, None] == at[None, :]] = np.inf
        one, two = np.abs(left - gain), np.unravel_index(int(np.argmin(both)), both.shape)
        k = int(np.argmin(one))
        chosen = [k] if one[k] <= both[two] else list(two)
        after = left - gain[chosen].sum()
        if abs(after) >= abs(left):
            break
        for i in chosen:
            move[at[i]] += sign[i]
        left = after
    return move


def closed(units_with_copies: DataFrame, want: dict[str, float]) -> DataFrame:
    """``copies`` with a few added or left out among CLOSERS texts per source, so that its tokens meet ``want``."""
    u = materialise(units_with_copies)
    by = {r.source: r for r in u.groupBy("source").agg(F.count("*").alias("n"), F.sum(F.col("tokens") * F.col("copies")).alias("t")).collect()}
    if not by:
        return u
    few = u.withColumn("x", F.xxhash64("h")).filter(_hash_share("x", {s: r.n for s, r in by.items()}, CLOSERS)).withColumn(
        "r", F.row_number().over(Window.partitionBy("source").orderBy("x", "h"))).filter(F.col("r") <= CLOSERS).select("source", "h", "tokens", "copies", "cap").toPandas()
    moves = []
    for s, p in few.groupby("source"):
        m = closing_moves(p["tokens"].to_numpy(), p["copies"].to_numpy(), p["cap"].to_numpy(), want.get(s, 0.0) - float(by[s].t), OPEN * want.get(s, 0.0))
        moves += [(h, int(x)) for h, x in zip(p["h"], m) if x]
    if not moves:
        return u
    table = u.sparkSession.createDataFrame(moves, "h string, move int")  # at most 2 * FIXES rows per source
    return u.join(F.broadcast(table), "h", "left").withColumn("copies", F.col("copies") + F.coalesce("move", F.lit(0))).drop("move")


def _copies(docs: DataFrame, targets: DataFrame, tokenizer: str | None) -> tuple[DataFrame, list[tuple[str, float, int]], dict]:
    rates, goal, facts = fitted(docs, targets, tokenizer)
    return closed(rounded(rates), {n: s * facts["total"] for n, s, _ in goal}), goal, facts


def mix(docs: DataFrame, targets: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, source, tokens, copies of each text that is used."""
    return _copies(docs, targets, tokenizer)[0].filter("copies > 0").select("doc_id", "source", "tokens", "copies")


def report(docs: DataFrame, targets: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Per source: target and actual share, expected share of the soft fit, tokens and texts there are and are used, most
    copies, how far the actual share misses its target; and the fit's steps and whether they converged."""
    copies, goal, facts = _copies(docs, targets, tokenizer)
    used = copies.groupBy("source").agg(
        F.count("*").alias("n_texts"), F.sum("tokens").alias("tokens"), F.count_if(F.col("copies") > 0).alias("texts_used"),
        F.sum(F.col("tokens") * F.col("copies")).alias("tokens_used"), F.max("copies").alias("most_copies"))
    spark = docs.sparkSession
    total = sum(facts["soft"].values()) or 1.0
    wanted = spark.createDataFrame([(n, s, c, facts["soft"][n] / total) for n, s, c in goal], "source string, target_share double, max_repeats int, soft_share double")
    all_used = F.sum(F.coalesce("tokens_used", F.lit(0))).over(Window.partitionBy(F.lit(1)))  # one row per source
    actual = F.coalesce("tokens_used", F.lit(0)) / F.greatest(all_used, F.lit(1))
    return wanted.join(F.broadcast(used), "source", "left").select(
        "source", F.round("target_share", 6).alias("target_share"), "max_repeats", F.round("soft_share", 6).alias("soft_share"), F.round(actual, 6).alias("actual_share"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_texts", "tokens", "texts_used", "tokens_used", "most_copies")),
        F.round(F.abs(actual - F.col("target_share")), 6).alias("missed"), F.lit(facts["steps"]).alias("steps"), F.lit(facts["converged"]).alias("converged"))
