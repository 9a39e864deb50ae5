"""Sequence similarity for the pairs that cheap conditions leave."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@lru_cache(1 << 16)  # a worker meets the same two texts in many batches
def _one(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching blocks ratio; the order of the arguments matters, as does the default treatment of popular characters."""
    return pd.Series([_one(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


def ratio(a: Column, b: Column) -> Column:
    return F.pandas_udf(_ratio, DoubleType())(a, b)


def length_bound(a: Column, b: Column) -> Column:
    """What the ratio can reach at most by the lengths alone."""
    return F.lit(2.0) * F.least(F.length(a), F.length(b)) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def letters_mask(c: Column, alphabet: str = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") -> Column:
    """A bit for each letter of the alphabet that the text holds; other characters set none."""
    out = F.lit(0).cast("bigint")
    for i, x in enumerate(alphabet):
        out = out.bitwiseOR(F.when(F.contains(c, F.lit(x)), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def mask_bound(n: Column, m: Column, mask_n: Column, mask_m: Column) -> Column:
    """What the ratio can reach at most, by lengths and the letters that only one text holds: each is one loss at least."""
    only = lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))
    return F.lit(2.0) * F.least(n - only(mask_n, mask_m), m - only(mask_m, mask_n)) / F.greatest(n + m, F.lit(1))


def letter_bound(a: Column, b: Column, alphabet: str = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") -> Column:
    """What the ratio can reach at most by the letters both have, counted; other characters count as common."""
    count = lambda c, x: F.length(c) - F.length(F.replace(c, F.lit(x)))
    common = sum((F.least(count(a, x), count(b, x)) for x in alphabet), F.lit(0))
    rest = F.least(*(F.length(F.translate(c, alphabet, "")) for c in (a, b)))
    return F.lit(2.0) * (common + rest) / F.greatest(F.length(a) + F.length(b), F.lit(1))


def name_similarity(a: Column, b: Column) -> Column:
    """0 where digits or states of two normalised names differ, 1 where they are equal, else the ratio, lifted to the ratio
    of lengths where one of five or more letters holds the other."""
    from .names import digits, states

    x, y = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    region = (F.size(states(a)) > 0) & (F.size(states(b)) > 0) & (states(a) != states(b))
    lifted = F.when((x >= 5) & (F.contains(a, b) | F.contains(b, a)), F.greatest(ratio(a, b), x / y)).otherwise(ratio(a, b))
    return F.when((a == "") | (b == "") | (digits(a) != digits(b)) | region, 0.0).when(a == b, 1.0).otherwise(lifted)
