"""Rewriting rules as DuckDB SQL, for the oracle."""

from __future__ import annotations

from collections.abc import Sequence

from ..functions.rules import ENTITIES, LOWER, SQUEEZE, UNACCENT, UNESCAPE, UPPER, Step


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rewrite(expr: str, steps: Sequence[Step]) -> str:
    for s in steps:
        if s == UPPER:
            expr = f"upper({expr})"
        elif s == LOWER:
            expr = f"lower({expr})"
        elif s == UNACCENT:
            expr = f"strip_accents({expr})"
        elif s == SQUEEZE:
            expr = f"trim(regexp_replace({expr}, '[\\s\\p{{Z}}]+', ' ', 'g'))"
        elif s == UNESCAPE:
            for a, b in ENTITIES:
                expr = f"replace({expr}, {lit(a)}, {lit(b)})"
        else:
            expr = f"regexp_replace({expr}, {lit(s[0])}, {lit(s[1])}, 'g')"
    return expr
