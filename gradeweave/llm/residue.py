"""Template residue, filler, error messages and script notices in titles (problem 4).

Character n-gram models of three kinds of residue and of natural titles give each position of a title a log-likelihood
ratio; windows of positions with a high mean mark the stretches of residue. Template residue is excluded wherever a
marked stretch holds a marker; filler and messages only if they begin as such texts do and cover the title but for its
ornaments, since real titles may allude to them. The residue side is made of phrases spelled out by rule
(``residue_seeds``). The natural side is learned from the table: n-grams of all different titles are counted where they
lie and summed in blocks of a fixed size, first without titles that consist of seed n-grams, then without those that
the first model takes for residue. Every row is then scored where it lies, without a shuffle.

Defined results: NULL, empty and blank titles are no residue; rows without an id are left out; texts of any length are counted and scored whole; repeated rows are
judged each for itself; other columns are passed by unread, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialise
from . import residue_seeds as seeds

ORDERS = (3, 5, 7)
BUCKETS = 1 << 18
FLOOR = 5e-6
CLIP = 3.0
BIAS = 0.25
WINDOW = 7
COVERAGE = 0.85
#: A template stretch needs a window of this mean.
TEMPLATE_SCORE = 1.0
SCORE = 0.6
#: Titles are counted and scored in chunks of about so many characters.
CHUNK_CHARS = 1_000_000
#: What an n-gram of a mistyped word counts.
SLIP_WEIGHT = 0.3
#: The first natural model leaves out titles of which this share of n-grams stands in seeds.
SEEDED = 0.7
#: N-grams of natural titles are taken to be at least so many, so that a small table leaves the seeds their say.
NATURAL_MASS = 20_000
#: Titles of at most so many words must also end as a seed does; longer ones may be cut off.
WHOLE_WORDS = 2
VIEWS = ("marked", "shape", "plain")
#: Counts travel in blocks of so many buckets; partial sums of tasks are merged in two steps, SPREAD tasks' worth at a time.
BLOCK, SPREAD = 1 << 14, 64

_TAGS = re.compile(r"</?(?:b|i|u|p|h[1-6]|br|em|strong|span|div|font)\b[^<>]{0,40}>", re.I)
#: Ornaments that stand after real titles and after messages alike.
_ORNAMENT = re.compile(r"\s*(?:\((?:r|hd|l|ref\. ?\d+)\)|\[auto\]|\bhd|- ao vivo|\bs\d{1,2} ?e\d{1,4}|\bt\d{1,2} ?ep ?\d{1,4}|[\s.…!?-]+)$")
_LETTER, _DIGIT = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")
_MARKER = re.compile(r"[{}\[\]<>%$@#_]")
_MARKS = np.array([ord(c) for c in "{}[]<>%$@#_"], np.uint64)


def fold(text: str) -> str:
    """Entities resolved, simple tags dropped, accents and case folded, runs of blanks joined."""
    t = _TAGS.sub(" ", html.unescape(text)) if "<" in text or "&" in text else text
    t = unicodedata.normalize("NFKD", t)
    t = "".join(c for c in t if not unicodedata.combining(c)).lower()
    return " ".join(t.split())


def plain(folded: str) -> str:
    """Without the ornaments at the end; underscores read as blanks."""
    t = " ".join(folded.replace("_", " ").split())
    while (s := _ORNAMENT.sub("", t)) != t and s:
        t = s
    return t


def damaged(text: str) -> list[str]:
    """The text with each two neighbours swapped, and with each character left out or doubled."""
    n = len(text)
    return ([text[:i] + text[i + 1] + text[i] + text[i + 2:] for i in range(n - 1)] + [text[:i] + text[i + 1:] for i in range(n)] + [text[:i] + text[i] + text[i:] for i in range(n)])


def shape(folded: str) -> str:
    """Runs of letters as a, of digits as 0: the markers without the names between them."""
    return _DIGIT.sub("0", _LETTER.sub("a", folded))


def _codes(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array of code points, each between boundary marks (1), and the start of each."""
    parts = ["\x01" + t + "\x01" for t in texts]
    starts = np.cumsum([0] + [len(p) for p in parts])
    return np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64), starts


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each position; the last positions take fewer characters."""
    h = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(order):
            shifted = np.zeros(len(codes), np.uint64)
            shifted[: max(len(codes) - k, 0)] = codes[k:]
            h = (h * np.uint64(0x100000001B3)) ^ (shifted * np.uint64(0x9E3779B97F4A7C15))
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def _views(folded: list[str]) -> dict[str, list[str]]:
    return {"marked": folded, "shape": [shape(t) for t in folded], "plain": [plain(t) or t for t in folded]}


def _vector(texts: Iterable[str], order: int) -> np.ndarray:
    return np.bincount(_grams(_codes(texts)[0], order), minlength=BUCKETS).astype(np.float64)


def _chunks(titles: list[str]) -> Iterator[np.ndarray]:
    """Positions of about CHUNK_CHARS characters at a time, which bounds the arrays where texts are very long."""
    ends = np.cumsum([len(t) for t in titles]) // CHUNK_CHARS
    for k in np.unique(ends):
        yield np.flatnonzero(ends == k)


class Counts:
    """Sums of n-grams of natural titles, per view and order."""

    def __init__(self) -> None:
        self.sums = {(v, n): np.zeros(BUCKETS) for v in VIEWS for n in ORDERS}

    @classmethod
    def usual(cls) -> "Counts":
        """The say of usual combinations of words, which counts where a table is very small."""
        return cls().add(seeds.phrases(seeds.NATURAL))

    def add(self, titles: list[str]) -> "Counts":
        for at in _chunks(titles):
            for v, texts in _views([fold(titles[i]) for i in at]).items():
                codes = _codes(texts)[0]
                for n in ORDERS:
                    self.sums[v, n] += np.bincount(_grams(codes, n), minlength=BUCKETS)
        return self


class Ratio:
    """Log-likelihood ratio per n-gram of one kind of residue against natural titles.

    ``low`` bounds how much one n-gram may speak for a natural title; ``typos`` adds the n-grams of mistyped words.
    """

    def __init__(self, residue: list[str], natural: dict[int, np.ndarray], low: float = -CLIP, typos: bool = True):
        self.tables = []
        seen = {n: _vector(residue, n) for n in ORDERS}
        slips = [f" {d} " for w in sorted({w for t in residue for w in t.split() if len(w) > 3}) for d in damaged(w)] if typos else []
        for n in ORDERS:
            r = np.sqrt(seen[n])  # damped: seeds are examples, not counts
            size = max(r.sum(), 1)
            if typos:
                r += SLIP_WEIGHT * (_vector(slips, n) > 0)
            m = natural[n]
            s = np.log(r / size + FLOOR) - np.log(m / max(m.sum(), NATURAL_MASS) + FLOOR)
            self.tables.append((np.clip(s, low, CLIP) - BIAS).astype(np.float32))
        # how such texts begin and end, mistyped or not
        begins = [d + " " for w in sorted({t.split()[0] for t in residue}) for d in damaged(w)] if typos else []
        ends = [" " + d for w in sorted({t.split()[-1] for t in residue}) for d in damaged(w)] if typos else []
        self.begins, self.ends = ((seen[5] > 0) | (_vector(x, 5) > 0) for x in (begins, ends))

    def windows(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Per position, the best mean ratio among the windows over it."""
        score = np.zeros(len(codes), np.float32)
        hits = np.zeros(len(codes), np.float32)
        sizes = np.diff(starts)
        size = np.repeat(sizes, sizes)
        left = size - (np.arange(len(codes)) - np.repeat(starts[:-1], sizes))  # characters to the text's end
        for n, table in zip(ORDERS, self.tables):
            got = table[_grams(codes, n)]
            got[left < n] = 0  # n-grams that run over the end of the text
            for k in range(n):  # each n-gram speaks for all its characters
                score[k:] += got[: len(got) - k] * (1.0 / n)
            hits += size >= n
        score /= np.maximum(hits, 1)
        total = np.concatenate([[0.0], np.cumsum(score, dtype=np.float64)])
        first, last = np.repeat(starts[:-1], sizes), np.repeat(starts[1:], sizes)
        here = np.arange(len(codes))
        best = np.full(len(codes), -np.inf)
        for k in range(WINDOW):  # the window that starts k before here
            lo = np.maximum(here - k, first)
            hi = np.minimum(lo + WINDOW, last)
            best = np.maximum(best, (total[hi] - total[lo]) / (hi - lo))
        return best

    def bounded(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether a text begins, and if it has few words also ends, as a seed does."""
        grams = _grams(codes, 5)
        blanks = np.add.reduceat(codes == 32, starts[:-1])
        ends = self.ends[grams[np.maximum(starts[1:] - 5, starts[:-1])]] | (blanks >= WHOLE_WORDS)
        return (self.begins[grams[starts[:-1]]] & ends) | (np.diff(starts) < 5)


class ResidueModel:
    """kind per title: 'template', 'filler', 'error', 'script' or None, with the share of the title it covers."""

    def __init__(self, natural: Counts, phrases: dict[str, list[str]] | None = None):
        of = lambda v: {n: natural.sums[v, n] for n in ORDERS}
        markers = seeds.templates()
        self.template = Ratio(markers, of("marked"), low=-1.0, typos=False)
        self.shape = Ratio([shape(t) for t in markers], of("shape"), low=-1.0, typos=False)
        self.kinds = {k: Ratio(t, of("plain")) for k, t in (phrases or seeds.all_phrases()).items()}

    def judge(self, titles: list[str]) -> tuple[list[str | None], np.ndarray]:
        folded = [fold(t) for t in titles]
        n = len(folded)
        kinds: list[str | None] = [None] * n
        share = np.zeros(n)
        if not n:
            return kinds, share
        marked = [i for i, t in enumerate(folded) if _MARKER.search(t)]
        if marked:
            for ratio, view in ((self.template, [folded[i] for i in marked]), (self.shape, [shape(folded[i]) for i in marked])):
                codes, starts = _codes(view)
                high = ratio.windows(codes, starts) >= TEMPLATE_SCORE
                high &= (codes != 1)
                holds = np.logical_or.reduceat(high & np.isin(codes, _MARKS), starts[:-1]) & (np.add.reduceat(high, starts[:-1]) >= 3)
                part = np.add.reduceat(high, starts[:-1]) / np.maximum(np.diff(starts) - 2, 1)
                for j in np.flatnonzero(holds):
                    kinds[marked[j]], share[marked[j]] = "template", max(share[marked[j]], part[j])
        rest = [i for i in range(n) if kinds[i] is None and folded[i]]
        if rest:
            codes, starts = _codes(plain(folded[i]) or folded[i] for i in rest)
            solid = (codes != 32) & (codes != 1)
            size = np.maximum(np.add.reduceat(solid, starts[:-1]), 1)
            best_share, best_kind = np.zeros(len(rest)), np.zeros(len(rest), int)
            for k, ratio in enumerate(self.kinds.values()):
                high = ratio.windows(codes, starts) >= SCORE
                cover = np.add.reduceat(solid & high, starts[:-1]) / size
                cover[~(high[starts[:-1] + 1] & ratio.bounded(codes, starts))] = 0  # a message may be cut off at its end, not at its start
                better = cover > best_share
                best_share[better], best_kind[better] = cover[better], k
            names = list(self.kinds)
            for j, i in enumerate(rest):
                if best_share[j] >= COVERAGE:
                    kinds[i] = names[best_kind[j]]
                share[i] = best_share[j]
        return kinds, share


class Seeded:
    """Which titles consist of seed n-grams, whatever the table holds."""

    def __init__(self, phrases: dict[str, list[str]] | None = None):
        self.grams = sum(_vector(t, 5) for t in [*(phrases or seeds.all_phrases()).values(), seeds.templates()]) > 0

    def judge(self, titles: list[str]) -> tuple[list[str | None], None]:
        if not titles:
            return [], None
        codes, starts = _codes(plain(t) or t for t in map(fold, titles))
        inside = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(codes)) >= 5
        n = np.add.reduceat(inside.astype(np.int64), starts[:-1])
        hits = np.add.reduceat((inside & self.grams[_grams(codes, 5)]).astype(np.int64), starts[:-1])
        return ["seed" if h >= SEEDED * c else None for h, c in zip(hits, n)], None


def fitted(titles: list[str], phrases: dict[str, list[str]] | None = None) -> ResidueModel:
    """The model of a list of different titles: what ``residue`` fits on a table."""
    first = ResidueModel(Counts.usual().add([t for t, k in zip(titles, Seeded(phrases).judge(titles)[0]) if k is None]), phrases)
    return ResidueModel(Counts.usual().add([t for t, k in zip(titles, first.judge(titles)[0]) if k is None]), phrases)


def _merge(p: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK)
    for c in p["counts"]:
        total += np.frombuffer(zlib.decompress(c))
    return pd.DataFrame({c: [p[c].iloc[0]] for c in ("part", "view", "n", "block")} | {"counts": [zlib.compress(total.tobytes(), 1)]})


def natural_counts(titles: DataFrame, judge: Seeded | ResidueModel) -> Counts:
    """Counts over all titles (a column t, each once) that ``judge`` takes for natural; the result has a fixed size."""
    model = titles.sparkSession.sparkContext.broadcast(judge)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = Counts()
        for p in parts:
            t = p["t"].tolist()
            for at in _chunks(t):
                some = [t[i] for i in at]
                sums.add([x for x, k in zip(some, model.value.judge(some)[0]) if k is None])
        part = TaskContext.get().partitionId() % SPREAD
        rows = [(part, v, n, b // BLOCK, zlib.compress(x[b:b + BLOCK].tobytes(), 1)) for (v, n), x in sums.sums.items() for b in range(0, BUCKETS, BLOCK) if x[b:b + BLOCK].any()]
        yield pd.DataFrame(rows, columns=["part", "view", "n", "block", "counts"])

    shape_ = "part int, view string, n int, block int, counts binary"
    partial = titles.mapInPandas(count, shape_).groupBy("part", "view", "n", "block").applyInPandas(_merge, shape_)
    out = Counts.usual()
    for r in partial.groupBy("view", "n", "block").applyInPandas(_merge, shape_).collect():
        out.sums[r.view, r.n][r.block * BLOCK:(r.block + 1) * BLOCK] += np.frombuffer(zlib.decompress(r.counts))
    return out


def residue(df: DataFrame, row_id: str = "row_id", text: str = "title") -> DataFrame:
    """row_id, kind, coverage of each row whose text is residue or holds some."""
    kind = dict(df.select(F.col(row_id).alias("i")).dtypes)["i"]
    rows = df.select(F.col(row_id).alias("i"), F.col(text).alias("t")).filter("i IS NOT NULL AND t IS NOT NULL AND trim(t) != ''")
    titles = materialise(rows.select("t").distinct())  # read twice below
    first = ResidueModel(natural_counts(titles, Seeded()))
    model = df.sparkSession.sparkContext.broadcast(ResidueModel(natural_counts(titles, first)))

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            back, unique = pd.factorize(p["t"])
            kinds, share = np.empty(len(unique), object), np.zeros(len(unique))
            for at in _chunks(list(unique)):
                kinds[at], share[at] = model.value.judge([unique[i] for i in at])
            got = pd.DataFrame({"i": p["i"].to_numpy(), "kind": kinds[back], "coverage": share[back]})
            yield got[got["kind"].notna()]

    return rows.mapInPandas(score, f"i {kind}, kind string, coverage double").withColumnRenamed("i", row_id)
