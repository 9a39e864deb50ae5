"""Languages of documents and of stretches within them (problem 10).

A bit-sliced Bloom filter holds one word per slot with one bit per language; the AND of an n-gram's slots gives all
languages that hold it. Each sentence counts, per language, its n-grams with that bit; the count is corrected by the
language's share of false positives, and the best corrected count decides. Sentences of one language in a row form a
segment. The filters are fitted on at most ``SAMPLE_DOCS`` different labelled documents, read whole: their n-grams are
counted where they lie, and only frequent ones reach the driver. The label only admits a document; its sentences get
their language from function words, as labels may be wrong and documents mixed. Every document is then read where it
lies, without a shuffle.

Defined results: every line with letters belongs to a segment; titles, names, rests of sentences and sentences whose
languages lie too close take the segment's language beside them and count as no sentence (a segment of nothing else has
the language of its best count and n_sentences 0, and names no language in ``unnamed_languages``). NULL, empty and blank
texts, texts without letters and documents without an id have no segment; texts of any length are read whole; repeated
documents are each judged; an empty table, and a sample in which a language does not occur, give no row of it; labels
that name none of the languages name nothing.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialise
from . import language_seeds as seeds

ORDERS = (3, 4, 5)
SLOTS = 1 << 21
PROBES = 2
SAMPLE_DOCS = 6_000
#: An n-gram belongs to a language if it occurs at least so often in its sentences, and at least at this share of its highest rate.
MIN_COUNT = 3
MIN_RATE = 0.05
#: A sentence has at least so many words besides names.
MIN_WORDS = 4
#: The best language must lead the next by this share of the n-grams.
MIN_LEAD = 0.03

_LINE = re.compile(r"[^\n\r]+")
_END = re.compile(r"[.!?…]+[\"'»”’)\]]*(?=\s|$)")
_UPPER = r"(?:[^\W\d_a-zà-öø-ÿ][\w'’-]*|\d+)"
#: Runs of capitalised words after the first word of a sentence, with the small words that join titles.
_NAMES = re.compile(rf"(?<=[\w,;:»”\"'’)(«“]\s)(?!I\b){_UPPER}(?:[ :,–—-]+(?:(?:da|de|do|das|dos|em|à|ao|sem|na|no|e|a|o)\s+)*{_UPPER})*")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Small letters without accents; everything else is one blank."""
    t = unicodedata.normalize("NFKD", text)
    t = "".join(c for c in t if not unicodedata.combining(c)).lower()
    return " " + " ".join(_WORD.findall(t)) + " "


def sentences(text: str) -> list[tuple[int, int, bool]]:
    """(start, stop, whole) of the sentences and other lines of a text, in order.

    A line break ends a sentence unless the line has no stop and the next goes on with a small letter. Whole sentences
    with a stop and do not start in the middle.
    """
    parts: list[list[int]] = []
    for m in _LINE.finditer(text):
        a, b = m.span()
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a == b:
            continue
        if parts and not text[parts[-1][1] - 1] in ".!?…»”\"" and text[a].islower() and text.count("\n", parts[-1][1], a) < 2:
            parts[-1][1] = b
        else:
            parts.append([a, b])
    out = []
    cased = any(c.isupper() for c in text) and any(c.islower() for c in text)
    for a, b in parts:
        at = a
        for m in _END.finditer(text, a, b):
            out.append((at, m.end(), _opens(text[at:m.end()], cased)))
            at = m.end()
            while at < b and text[at].isspace():
                at += 1
        if at < b:
            out.append((at, b, False))
    return out


def _opens(sentence: str, cased: bool) -> bool:
    """A capital at its start or, as in careless typing, none at all; otherwise it is the rest of a sentence."""
    first = next((c for c in sentence if c.isalnum()), "")
    return bool(first) and (not cased or not first.islower() or not any(c.isupper() for c in sentence))


def without_names(sentence: str) -> str:
    """Titles and names count for no language: capitals inside a sentence and the small words between them go."""
    return _NAMES.sub(" ", sentence) if any(c.islower() for c in sentence) else sentence


def _hash(folded: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """64-bit hashes of the n-grams of each order at each position, whether they lie inside a text, and text starts."""
    starts = np.cumsum([0] + [len(t) for t in folded])
    codes = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(codes))
    out = []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            h = np.full(len(codes), n, np.uint64)
            for k in range(n):
                shifted = np.zeros(len(codes), np.uint64)
                shifted[: max(len(codes) - k, 0)] = codes[k:]
                h = (h ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
            out.append(h)
    return out, left, starts


#: Weights of the words that speak for each language.
_KNOWN = {k: set(v.split()) for k, v in seeds.FUNCTION_WORDS.items()}
_SAY = {x: 1 / sum(x in v for v in _KNOWN.values()) for v in _KNOWN.values() for x in v}


def by_function_words(text: str) -> Iterator[tuple[str, str]]:
    """(language, folded sentence) of the whole sentences whose function words tell their language."""
    row: list[tuple[str, str | None]] = []
    for a, b, whole in sentences(text):
        f = fold(without_names(text[a:b]))
        w = f.split()
        if not whole or len(w) < MIN_WORDS:
            continue
        # a word speaks for a language the more, the fewer languages have it
        hits = sorted(((sum(_SAY[x] for x in w if x in _KNOWN[k]), k) for k in seeds.LANGUAGES), reverse=True)
        row.append((f, hits[0][1] if hits[0][0] >= 1 and hits[0][0] >= 1.5 * hits[1][0] else None))
    for i, (f, k) in enumerate(row):
        if k is None:  # between sentences of one language it is taken for one of them
            around = {next((x for _, x in part if x), None) for part in (row[i + 1:], row[:i][::-1])} - {None}
            k = around.pop() if len(around) == 1 else None
        if k is not None:
            yield k, f


def counted(texts: Iterable[str], weights: Iterable[int]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Hashes of n-grams and how often they stand in the sentences of each language."""
    per: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for t, n in zip(texts, weights):
        found: dict[str, list[str]] = {}
        for k, f in by_function_words(html.unescape(t)):
            found.setdefault(k, []).append(f)
        for k, fs in found.items():
            hs, left, _ = _hash(fs)
            h, c = np.unique(np.concatenate([h[left >= m] for m, h in zip(ORDERS, hs)]), return_counts=True)
            per.setdefault(k, []).append((h, c * n))
    out = {}
    for k, parts in per.items():
        h, back = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
        out[k] = (h, np.bincount(back, np.concatenate([c for _, c in parts])).astype(np.int64))
    return out


class LanguageFilters:
    """counts: hashes and counts of n-grams per language, to which the function words themselves are added; sizes: all n-grams of
    each language, where ``counts`` holds only the frequent ones."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], sizes: dict[str, int] | None = None):
        langs = seeds.LANGUAGES
        self.bits = np.zeros(SLOTS, np.min_scalar_type((1 << len(langs)) - 1))
        every, count, size = [], [], []
        for k in langs:
            hs, left, _ = _hash([f" {w} " for w in sorted(_KNOWN[k])])  # the words themselves, where the sample is small
            h, c = np.unique(np.concatenate([h[left >= n] for n, h in zip(ORDERS, hs)]), return_counts=True)
            more, many = counts.get(k, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            total = (sizes or {}).get(k, int(many.sum()))
            h, back = np.unique(np.concatenate([h, more]), return_inverse=True)
            every.append(h)
            count.append(np.bincount(back, np.concatenate([c * MIN_COUNT, many])))
            size.append(max(total + int(c.sum()) * MIN_COUNT, 1))
        all_, back = np.unique(np.concatenate(every), return_inverse=True)
        top, at, places = np.zeros(len(all_)), 0, []
        for h, c, n in zip(every, count, size):
            places.append(back[at:at + len(h)])
            np.maximum.at(top, places[-1], c / n)
            at += len(h)
        for i, (h, c, n) in enumerate(zip(every, count, size)):
            kept = h[(c >= MIN_COUNT) & (c / n >= MIN_RATE * top[places[i]])]
            for slot in self._slots(kept):
                np.bitwise_or.at(self.bits, slot, self.bits.dtype.type(1 << i))
        fill = np.array([((self.bits >> i) & 1).mean() for i in range(len(langs))])
        self.false = fill**PROBES
        self.fitted = fill > 0

    @classmethod
    def of(cls, texts: Iterable[str]) -> "LanguageFilters":
        texts = list(texts)
        return cls(counted(texts, [1] * len(texts)))

    @staticmethod
    def _slots(h: np.ndarray) -> list[np.ndarray]:
        with np.errstate(over="ignore"):
            second = (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20)
        return [((h + np.uint64(k) * second) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(PROBES)]

    def score(self, folded: list[str]) -> np.ndarray:
        """Corrected share of n-grams held by each language, a row per text."""
        hs, left, starts = _hash(folded)
        n_lang = len(seeds.LANGUAGES)
        counts, total = np.zeros((len(folded), n_lang)), np.zeros(len(folded))
        for n, h in zip(ORDERS, hs):
            mask = np.full(len(h), np.iinfo(self.bits.dtype).max, self.bits.dtype)
            for slot in self._slots(h):
                mask &= self.bits[slot]
            inside = left >= n
            mask[~inside] = 0
            total += np.add.reduceat(inside.astype(np.int64), starts[:-1])
            for i in range(n_lang):
                counts[:, i] += np.add.reduceat(((mask >> i) & 1).astype(np.int64), starts[:-1])
        total = np.maximum(total, 1)[:, None]
        corrected = np.clip((counts / total - self.false) / (1 - self.false), 0, 1)
        corrected[:, ~self.fitted] = 0
        return corrected

    def segments(self, texts: list[str]) -> list[list[tuple[int, int, str, float, int]]]:
        """Per text: (start, stop, language, confidence, whole sentences), in offsets of the resolved text."""
        spans, folded, owner, whole_ = [], [], [], []
        for i, t in enumerate(texts):
            for a, b, whole in sentences(t):
                f = fold(without_names(t[a:b]))
                whole = whole and f.count(" ") - 1 >= MIN_WORDS
                f = f if whole else fold(t[a:b])
                if f.strip():
                    spans.append((a, b))
                    folded.append(f)
                    owner.append(i)
                    whole_.append(whole)
        out: list[list[tuple[int, int, str, float, int]]] = [[] for _ in texts]
        if not folded:
            return out
        s = self.score(folded)
        order = np.sort(s, axis=1)
        best = s.argmax(axis=1)
        lead = order[:, -1] - order[:, -2]
        sure = np.where(order[:, -1] > 0, lead / np.maximum(order[:, -1], 1e-9), 0)
        says = np.array(whole_) & (lead >= MIN_LEAD)
        owner = np.array(owner)
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
        for i in range(len(texts)):
            lo, hi = edges[i], edges[i + 1]
            if lo == hi:
                continue
            told = np.flatnonzero(says[lo:hi]) + lo
            if not len(told):  # nothing but lines that are no sentences, or none that is clear
                total = s[lo:hi].sum(axis=0)
                k = int(total.argmax())
                rest = np.sort(total)[-2] if len(total) > 1 else 0.0
                out[i].append((spans[lo][0], spans[hi - 1][1], seeds.LANGUAGES[k], float((total[k] - rest) / max(total[k], 1e-9)) if total[k] > 0 else 0.0, 0))
                continue
            segs = out[i]
            for j in range(lo, hi):
                near = told[max(np.searchsorted(told, j, side="right") - 1, 0)]  # itself, or the last one told, or the first
                lang, own = seeds.LANGUAGES[best[near]], int(says[j])
                a, b = spans[j]
                if segs and segs[-1][2] == lang:
                    p = segs[-1]
                    c = (p[3] * p[4] + sure[j] * own) / max(p[4] + own, 1)
                    segs[-1] = (p[0], b, lang, c, p[4] + own)
                else:
                    segs.append((a, b, lang, float(sure[j]) if own else 0.0, own))
            out[i] = [(a, b, lang, float(c), n) for a, b, lang, c, n in segs]
        return out


def named_language(label: Column) -> Column:
    """The language that a code of two or three letters names, with or without a region; NULL for any other label."""
    code = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.create_map(*(F.lit(x) for kv in seeds.CODES.items() for x in kv))[code]


def doc_sample(docs: DataFrame, text: str, label: str | None = None, rows: int = SAMPLE_DOCS) -> DataFrame:
    """t, w: at most ``rows`` different labelled texts, whole, the same for the same data: those of the smallest hashes.

    Copies count once, in the sample and in the size of its hash range, but for a weight w of MIN_COUNT - 1 where there
    are some: never enough for the n-grams of one text alone.
    """
    part = docs.filter(named_language(F.col(label).cast("string")).isNotNull()) if label else docs
    part = part.select(F.col(text).alias("t")).filter("t IS NOT NULL").withColumn("h", F.xxhash64("t"))
    distinct = part.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    share = min(1.0, 2.0 * rows / max(distinct, 1))
    if share < 1:
        part = part.filter(F.col("h") < int(-(2**63) + share * 2**64))
    # some 2 * rows texts are left: the hash at the bound is found first, so no task takes them all
    hashes = materialise(part.groupBy("h").agg(F.count("*").alias("n")))
    bound = hashes.orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if bound is None:
        return part.select("t", F.lit(1).alias("w")).limit(0)
    return part.filter(F.col("h") <= bound).groupBy("h").agg(F.min("t").alias("t"), F.least(F.count("*"), F.lit(MIN_COUNT - 1)).cast("int").alias("w")).select("t", "w")


def fit(sample: DataFrame) -> LanguageFilters:
    """Filters of a sample (t, w): n-grams are counted in the tasks, frequent ones are collected."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for k, (h, c) in counted(p["t"], p["w"]).items():
                yield pd.DataFrame({"lang": k, "h": h.view(np.int64), "n": c})

    grams = sample.mapInPandas(count, "lang string, h bigint, n bigint").groupBy("lang", "h").agg(F.sum("n").alias("n"))
    grams = materialise(grams)
    sizes = {r.lang: int(r.n) for r in grams.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    got = grams.filter(F.col("n") >= MIN_COUNT).toPandas()
    return LanguageFilters({k: (p["h"].to_numpy().view(np.uint64), p["n"].to_numpy()) for k, p in got.groupby("lang")}, sizes)


def segments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "lang", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, named (by the label), char_start, char_stop, lang, confidence, n_sentences of each stretch in one language."""
    model = docs.sparkSession.sparkContext.broadcast(fit(doc_sample(docs, text, label, sample_docs)))
    kind = dict(docs.dtypes)[doc_id]

    def judge(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            ids, named, texts = p["d"].to_numpy(), p["named"].to_numpy(), [html.unescape(t) for t in p["t"]]
            ends = np.cumsum([len(t) for t in texts]) // 1_000_000
            for k in np.unique(ends):  # bounds the arrays where texts are very long
                at = np.flatnonzero(ends == k)
                got = model.value.segments([texts[i] for i in at])
                rows = [(ids[i], named[i], *s) for i, segs in zip(at, got) for s in segs]
                if rows:
                    yield pd.DataFrame(rows, columns=[doc_id, "named", "char_start", "char_stop", "lang", "confidence", "n_sentences"])

    rows = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t"), named_language(F.col(label).cast("string")).alias("named")).filter("d IS NOT NULL AND t IS NOT NULL AND trim(t) != ''")
    return rows.mapInPandas(judge, f"{doc_id} {kind}, named string, char_start int, char_stop int, lang string, confidence double, n_sentences int")


def unnamed_languages(segs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang of each language with a whole sentence that the document's label does not name."""
    return segs.filter("n_sentences > 0 AND (named IS NULL OR named != lang)").select(doc_id, "lang").distinct()
