"""Records that differ only in spacing, case, punctuation or the order of their lists (problem 1).

A record's canonical text keeps letters and digits in small letters, its list sorted. Each partition marks the hashes
of these texts in two Bloom filters, of hashes seen and of hashes seen again; partitions are merged by OR, where a
bit set in both "seen" filters is set in "seen again" as well. Only records whose hash may have been seen again are
shuffled and grouped exactly; all others are single and stay where they are. A filter has at most ``MAX_BITS`` bits for
as many hashes as fill it well: more records are cut into ranges of hashes with a filter each, so that filters neither
saturate nor outgrow an executor however many records there are. All filters are built in one pass; each range then
reads the records once more.

Defined results: NULL equals NULL and differs from ''; a NULL list equals an empty one; a NULL in a list counts as an
element; lists are compared as they are, so a repeated element counts twice; a repeated id is the same record; an empty
table gives an empty result; texts of any length are compared whole; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import join_groups, materialise

HASHES = 4
BITS_PER_RECORD = 16
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
CHUNK = 1 << 13  # bytes
#: Partitions whose filters are merged in the first step.
MERGED = 64


def letters_and_digits(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


def canonical(name: str, aliases: str) -> Column:
    nothing = F.lit("\u0001")
    each = F.transform(F.coalesce(F.col(aliases), F.array().cast("array<string>")), lambda a: F.coalesce(letters_and_digits(a), nothing))
    return F.concat_ws("\u0002", F.coalesce(letters_and_digits(F.col(name)), nothing), F.array_join(F.array_sort(each), "\u0002"))


def _slots(h: np.ndarray, bits: int) -> list[np.ndarray]:
    u = h.astype(np.uint64)
    with np.errstate(over="ignore"):
        step = ((u * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(17)) | np.uint64(1)
        return [((u + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(HASHES)]


def _holds(words: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
    out = np.ones(len(slots[0]), bool)
    for s in slots:
        out &= (words[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1
    return out


def _mark(words: np.ndarray, slots: list[np.ndarray]) -> None:
    for s in slots:
        np.bitwise_or.at(words, s >> 3, np.left_shift(np.uint8(1), (s & 7).astype(np.uint8)))


def _partition_filters(parts: Iterator[pd.DataFrame], bits: int) -> Iterator[pd.DataFrame]:
    """Both filters of each range of hashes that the partition holds, one range after the other."""
    mine: dict[int, list[np.ndarray]] = {}
    for p in parts:
        part, h = p["part"].to_numpy(), p["h"].to_numpy()
        for r in np.unique(part):
            mine.setdefault(int(r), []).append(h[part == r])
    for r, hashes in sorted(mine.items()):
        once, again = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        values, counts = np.unique(np.concatenate(hashes), return_counts=True)
        slots = _slots(values, bits)
        _mark(again, [s[counts > 1] for s in slots])
        _mark(once, slots)
        rows = [(r, c // CHUNK, zlib.compress(once[c:c + CHUNK].tobytes(), 1), zlib.compress(again[c:c + CHUNK].tobytes(), 1)) for c in range(0, len(once), CHUNK) if once[c:c + CHUNK].any()]
        yield pd.DataFrame(rows, columns=["part", "chunk", "once", "again"])


def _merge(p: pd.DataFrame) -> pd.DataFrame:
    once = again = None
    for a, b in zip(p["once"], p["again"]):
        a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
        once, again = (a, b) if once is None else (once | a, again | b | (once & a))
    return pd.DataFrame({c: [p[c].iloc[0]] for c in p.columns if c not in ("once", "again")} | {"once": [zlib.compress(once.tobytes(), 1)], "again": [zlib.compress(again.tobytes(), 1)]})


def _layout(records: int) -> tuple[int, int]:
    """Bits of a filter and number of ranges for so many records."""
    need = max(records, 1) * BITS_PER_RECORD
    return min(max(MIN_BITS, 1 << (need - 1).bit_length()), MAX_BITS), -(-need // MAX_BITS)


def repeat_filters(hashes: DataFrame, bits: int) -> DataFrame:
    """part, chunk, again: the merged filters of hashes (columns part and h) that may occur twice."""
    shape = "part int, chunk int, once binary, again binary"
    made = hashes.mapInPandas(lambda it: _partition_filters(it, bits), shape)
    # in two steps, so that no task merges the chunks of all partitions at once
    half = made.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(MERGED))).groupBy("part", "chunk", "g").applyInPandas(_merge, "part int, chunk int, g int, once binary, again binary")
    return half.drop("g").groupBy("part", "chunk").applyInPandas(_merge, shape).drop("once")


def _tester(held):
    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        w = held.value
        return pd.Series(_holds(w, _slots(h.to_numpy(), len(w) * 8)))

    return maybe


def split(records: DataFrame, rec_id: str = "rec_id", name: str = "name", aliases: str = "aliases") -> tuple[DataFrame, int]:
    """(id, name, aliases, canon, maybe) with ``maybe`` true wherever the canonical text may occur again; number of records."""
    rows = records.select(F.col(rec_id).alias("id"), F.col(name).alias("name"), F.col(aliases).alias("aliases"), canonical(name, aliases).alias("canon")).filter("id IS NOT NULL")
    total = rows.count()
    spark = records.sparkSession
    bits, ranges = _layout(total)
    hashed = rows.withColumn("h", F.xxhash64("canon")).withColumn("part", F.pmod(F.xxhash64("h"), F.lit(ranges)).cast("int"))
    filters = repeat_filters(hashed.select("part", "h"), bits)
    filters = materialise(filters) if ranges > 1 else filters
    out = None
    for r in range(ranges):
        words = np.zeros(bits // 8, np.uint8)
        for x in filters.filter(F.col("part") == r).toLocalIterator():  # at most MAX_BITS / 8 bytes
            got = np.frombuffer(zlib.decompress(x.again), np.uint8)
            words[x.chunk * CHUNK:x.chunk * CHUNK + len(got)] = got
        one = hashed.filter(F.col("part") == r).withColumn("maybe", _tester(spark.sparkContext.broadcast(words))(F.col("h"))).drop("h", "part")
        out = one if out is None else out.unionByName(one)
    return out, total


def copies(records: DataFrame, rec_id: str = "rec_id", name: str = "name", aliases: str = "aliases") -> DataFrame:
    """first_id, id of each record that is not the smallest id of its copies."""
    rows, total = split(records, rec_id, name, aliases)
    again = rows.filter("maybe").select("id", "canon")
    groups = again.groupBy("canon").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).filter("n > 1")
    return join_groups(again, groups, ["canon"], "n", total).filter("id != first_id").select("first_id", F.col("id").alias(rec_id)).distinct()


def collapsed(records: DataFrame, rec_id: str = "rec_id", name: str = "name", aliases: str = "aliases") -> DataFrame:
    """One row per record: its smallest id, that record's name and aliases, and n_copies (distinct ids)."""
    rows, _ = split(records, rec_id, name, aliases)
    single = rows.filter("NOT maybe").select(F.col("id").alias("first_id"), "name", "aliases", F.lit(1).cast("bigint").alias("n_copies"))
    again = (
        rows.filter("maybe").groupBy("canon", "id").agg(F.min(F.struct("name", F.array_join("aliases", "\u0002"), "aliases")).alias("s"))
        .groupBy("canon").agg(F.min(F.struct("id", "s")).alias("f"), F.count("*").alias("n_copies"))
        .select(F.col("f.id").alias("first_id"), F.col("f.s.name").alias("name"), F.col("f.s.aliases").alias("aliases"), "n_copies")
    )
    return single.unionByName(again)
