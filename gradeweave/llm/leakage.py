"""Evaluation passages inside a training corpus (problem 8).

Each task indexes its documents in shards of bounded size: a suffix array over word ids, its Burrows-Wheeler transform
in a wavelet matrix with ranks, and sampled suffix positions. All passages of ``min_words`` words are searched backward
at once; occurrences are located by walking to sampled positions and merged into spans per document and item. Words
that no item holds stand in no passage, so runs of fewer than ``min_words`` known words are left out of the index
without loss. The corpus is neither shuffled nor collected. Items are searched in blocks: the driver and every task hold
one block at a time, and up to ``PASS_BLOCKS`` blocks are searched in one pass over the corpus.

Defined results: NULL and empty texts and items shorter than ``min_words`` hold no passage; documents without an id are left out; documents of any length are
indexed whole; repeated documents and items are each reported; an empty table gives an empty result; extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import resolved, word_spans, words

MIN_WORDS = 10
#: A shard is closed when it holds so many words to index.
SHARD_WORDS = 400_000
#: Every so many positions of the text the suffix array keeps one.
SAMPLE_EVERY = 8
#: Items searched at a time, and blocks of them in one pass over the corpus.
BLOCK_ITEMS, PASS_BLOCKS = 5_000, 64


class FMIndex:
    """Over runs of word ids (1..n_words), each closed by a 0; runs are told apart, so no match crosses them."""

    def __init__(self, runs: list[np.ndarray]):
        lengths = np.array([len(r) for r in runs], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        n = int((lengths + 1).sum())
        text = np.zeros(n, np.int64)
        body = np.ones(n, bool)
        body[self.starts + lengths] = False
        text[body] = np.concatenate(runs)
        self.n = n
        sa = self._suffixes(text, body)
        bwt = text[sa - 1]  # the first suffix is preceded by the last separator
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self._wavelet(bwt, max(1, int(text.max()).bit_length()))
        first = np.zeros(n, bool)
        first[self.starts] = True  # a walk never has to pass the start of a run
        kept = (sa % SAMPLE_EVERY == 0) | first[sa]
        self.kept, self.kept_rank = kept, np.concatenate([[0], np.cumsum(kept)])
        self.sample = sa[kept]

    @staticmethod
    def _suffixes(text: np.ndarray, body: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling; separators rank below all words, in the order of the runs."""
        n = len(text)
        ends = np.flatnonzero(~body)
        rank = text + len(ends)
        rank[ends] = np.arange(len(ends))
        step = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - step] = rank[step:] + 1 if step < n else 0
            key = rank * (int(after.max()) + 1) + after
            sa = np.argsort(key, kind="stable")
            ordered = key[sa]
            new = np.empty(n, np.int64)
            new[sa] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank = new
            if rank[sa[-1]] == n - 1:
                return sa
            step *= 2

    def _wavelet(self, symbols: np.ndarray, bits: int) -> None:
        self.levels = []
        s = symbols
        for b in range(bits - 1, -1, -1):
            one = (s >> b) & 1
            ranks = np.concatenate([[0], np.cumsum(one)]).astype(np.int32)
            self.levels.append((b, ranks, len(s) - int(ranks[-1])))
            s = np.concatenate([s[one == 0], s[one == 1]])

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each position."""
        lo, hi = np.zeros(len(symbol), np.int64), upto.astype(np.int64)
        for b, ranks, zeros in self.levels:
            one = (symbol >> b) & 1 == 1
            lo1, hi1 = ranks[lo], ranks[hi]
            lo = np.where(one, zeros + lo1, lo - lo1)
            hi = np.where(one, zeros + hi1, hi - hi1)
        return hi - lo

    def symbol_at(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transform's symbol at each row, and how often it stands before."""
        pos, lo = row.astype(np.int64), np.zeros(len(row), np.int64)
        symbol = np.zeros(len(row), np.int64)
        for b, ranks, zeros in self.levels:
            one = ranks[pos + 1] > ranks[pos]
            symbol |= one.astype(np.int64) << b
            p1, l1 = ranks[pos], ranks[lo]
            pos = np.where(one, zeros + p1, pos - p1)
            lo = np.where(one, zeros + l1, lo - l1)
        return symbol, pos - lo

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows [lo, hi) of each phrase (a row of word ids) that occurs, with the phrase's number."""
        alive = np.flatnonzero((phrases < len(self.counts) - 1).all(axis=1))
        lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), self.n, np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, j]
            both = self.rank(np.concatenate([c, c]), np.concatenate([lo, hi]))
            lo, hi = self.counts[c] + both[: len(c)], self.counts[c] + both[len(c):]
            found = hi > lo
            alive, lo, hi = alive[found], lo[found], hi[found]
            if not len(alive):
                break
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each suffix-array row."""
        rows, steps = rows.astype(np.int64).copy(), np.zeros(len(rows), np.int64)
        out = np.full(len(rows), -1, np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            here = self.kept[rows[todo]]
            done = todo[here]
            out[done] = self.sample[self.kept_rank[rows[done]]] + steps[done]
            todo = todo[~here]
            if len(todo):
                symbol, before = self.symbol_at(rows[todo])
                rows[todo] = self.counts[symbol] + before
                steps[todo] += 1
        return out


class Phrases:
    """All passages of ``size`` words of a block of items, as word ids; equal passages are searched once."""

    def __init__(self, items: list[tuple[int, str]], size: int):
        self.size = size
        self.ids: dict[str, int] = {}
        rows, owners = [], []
        for item, text in items:
            w = [self.ids.setdefault(x, len(self.ids) + 1) for x in words(text)]
            for k in range(len(w) - size + 1):
                rows.append(w[k:k + size])
                owners.append(item)
        if rows:
            self.phrases, back = np.unique(np.array(rows, np.int64), axis=0, return_inverse=True)
            order = np.argsort(back.ravel(), kind="stable")
            self.owners = np.array(owners, np.int64)[order]
            self.first = np.searchsorted(back.ravel()[order], np.arange(len(self.phrases) + 1))
        else:
            self.phrases = np.zeros((0, size), np.int64)

    def runs(self, text: str | None) -> list[tuple[int, np.ndarray]]:
        """(first word, ids) of each run of at least ``size`` known words."""
        got = self.ids.get
        w = np.array([got(x, 0) for x in words(text)], np.int64)
        if len(w) < self.size:
            return []
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (w > 0).view(np.int8), [0]])))
        return [(int(a), w[a:b]) for a, b in zip(edge[::2], edge[1::2]) if b - a >= self.size]

    def shard(self, runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(run, word in the run, item) of every occurrence."""
        none = np.zeros(0, np.int64)
        if not runs or not len(self.phrases):
            return none, none, none
        index = FMIndex(runs)
        which, lo, hi = index.search(self.phrases)
        if not len(which):
            return none, none, none
        n = hi - lo
        rows = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = index.locate(rows)
        which = np.repeat(which, n)
        run = np.searchsorted(index.starts, at, side="right") - 1
        many = self.first[which + 1] - self.first[which]
        take = np.repeat(self.first[which], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        return np.repeat(run, many), np.repeat(at - index.starts[run], many), self.owners[take]


def _merged(found: pd.DataFrame, size: int) -> pd.DataFrame:
    """Overlapping or touching passages of one document and item as one span."""
    f = found.sort_values(["row", "item_id", "word"], kind="stable").drop_duplicates(["row", "item_id", "word"])
    new = (f["row"].diff() != 0) | (f["item_id"].diff() != 0) | (f["word"].diff() > size)
    g = f.assign(span=new.cumsum()).groupby("span", sort=False).agg(row=("row", "first"), item_id=("item_id", "first"), first=("word", "min"), last=("word", "max"))
    return g.assign(last=g["last"] + size - 1)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", min_words: int = MIN_WORDS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, first_word, last_word, char_start, char_stop of each merged span that document and item share.

    Character offsets count in the text with its entities resolved. Spans of one document may overlap between items.
    """
    spark = docs.sparkSession
    corpus = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).filter("d IS NOT NULL AND t IS NOT NULL AND t != ''")
    kind = dict(corpus.dtypes)["d"]
    schema = f"{doc_id} {kind}, {item_id} bigint, first_word int, last_word int, char_start int, char_stop int"
    held = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).filter("i IS NOT NULL AND t IS NOT NULL")
    out = None
    for queries in _passes(spark, held, min_words, block_items):
        part = corpus.mapInPandas(_searcher(queries, doc_id, item_id), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _passes(spark, held: DataFrame, min_words: int, block_items: int) -> Iterator[list]:
    """Broadcast blocks of items, as many at a time as one pass takes; the driver never holds more than one block."""
    queries, block = [], []
    for r in held.toLocalIterator():
        block.append((r.i, r.t))
        if len(block) == block_items:
            queries.append(spark.sparkContext.broadcast(Phrases(block, min_words)))
            block = []
            if len(queries) == PASS_BLOCKS:
                yield queries
                queries = []
    if block or not queries:
        queries.append(spark.sparkContext.broadcast(Phrases(block, min_words)))
    yield queries


def _searcher(queries: list, doc_id: str, item_id: str):
    def flush(q: Phrases, held_runs: list, texts: list) -> pd.DataFrame:
        run, word, item = q.shard([ids for _, _, ids in held_runs])
        if not len(run):
            return pd.DataFrame()
        at = np.array([r for r, _, _ in held_runs], np.int64)
        offset = np.array([o for _, o, _ in held_runs], np.int64)
        g = _merged(pd.DataFrame({"row": at[run], "word": word + offset[run], "item_id": item}), q.size)
        spans = {r: word_spans(texts[r][1]) for r in g["row"].unique()}
        return pd.DataFrame({
            doc_id: [texts[r][0] for r in g["row"]], item_id: g["item_id"].to_numpy(),
            "first_word": g["first"].to_numpy(), "last_word": g["last"].to_numpy(),
            "char_start": [spans[r][a][0] for r, a in zip(g["row"], g["first"])], "char_stop": [spans[r][b][1] for r, b in zip(g["row"], g["last"])],
        })

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            texts = list(zip(p["d"], p["t"]))
            for query in queries:
                q, held_runs, size = query.value, [], 0
                for row, (_, t) in enumerate(texts):
                    for first, ids in q.runs(t):
                        held_runs.append((row, first, ids))
                        size += len(ids)
                    if size >= SHARD_WORDS:
                        yield flush(q, held_runs, texts)
                        held_runs, size = [], 0
                if held_runs:
                    yield flush(q, held_runs, texts)
                if len(queries) > 1:  # read again from the executor's disk for the next batch
                    query.__dict__.pop("_value", None)

    return search


def without_leaks(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, clean_text, removed_chars of each document with leaks: the resolved text without any leaked span."""
    marked = spans.groupBy(doc_id).agg(F.sort_array(F.collect_set(F.struct("char_start", "char_stop"))).alias("spans"))
    rows = docs.select(doc_id, text).join(marked, doc_id)
    kind = dict(docs.dtypes)[doc_id]

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = []
            for t, sp in zip(p[text], p["spans"]):
                t, keep, last = resolved(t), [], 0
                for s in sp:
                    if s["char_start"] > last:
                        keep.append(t[last:s["char_start"]])
                    last = max(last, s["char_stop"])
                keep.append(t[last:])
                out.append("".join(keep))
            whole = [len(resolved(t)) for t in p[text]]
            yield pd.DataFrame({doc_id: p[doc_id], "clean_text": out, "removed_chars": [w - len(o) for w, o in zip(whole, out)]})

    return rows.mapInPandas(cut, f"{doc_id} {kind}, clean_text string, removed_chars int")
