"""Ordered text rewriting as data: a list of steps becomes one chain of built-in column functions.

A step is ``(pattern, replacement)`` with groups as ``\\1``, or one of the words below. Patterns keep to what Java and
RE2 read alike: no lookaround, no back references inside patterns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER, UNACCENT, SQUEEZE, UNESCAPE = "upper", "lower", "unaccent", "squeeze", "unescape"
Step = str | tuple[str, str]

#: The letters with marks of the languages at hand and what they become.
MARKED = "ÁÀÂÃÄÅáàâãäåÉÈÊËéèêëÍÌÎÏíìîïÓÒÔÕÖóòôõöÚÙÛÜúùûüÇçÑñÝýÿ"
BARE = "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuCcNnYyy"
#: The entities that feeds use, in the order in which they are resolved.
ENTITIES = (("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def apply(value: Column, steps: Sequence[Step]) -> Column:
    """NULL stays NULL; every step works on the whole text."""
    for s in steps:
        if s == UPPER:
            value = F.upper(value)
        elif s == LOWER:
            value = F.lower(value)
        elif s == UNACCENT:
            value = F.translate(value, MARKED, BARE)
        elif s == SQUEEZE:
            value = F.trim(F.regexp_replace(value, r"[\s\p{Z}]+", " "))
        elif s == UNESCAPE:
            for a, b in ENTITIES:
                value = F.replace(value, F.lit(a), F.lit(b))
        else:
            pattern, replacement = s
            value = F.regexp_replace(value, pattern, re.sub(r"\\(\d)", r"$\1", replacement.replace("$", r"\$")))
    return value


def strip(value: Column) -> Column:
    """Without blanks of any kind at both ends."""
    return F.regexp_replace(value, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
