"""Words of a text as evaluation passages are compared: without case, accents, punctuation, spacing and line breaks."""

from __future__ import annotations

import html
import re
import unicodedata

_TOKEN = re.compile(r"[^\W_]+")
_UNSEEN = re.compile("[­​-‏⁠﻿]")


def resolved(text: str) -> str:
    """Entities resolved and characters without width dropped."""
    t = html.unescape(text) if "&" in text else text
    return _UNSEEN.sub("", t)


def _fold(text: str) -> str:
    t = unicodedata.normalize("NFKD", text)
    return "".join(c for c in t if not unicodedata.combining(c)).casefold() if not t.isascii() else t.lower()


def words(text: str | None) -> list[str]:
    return _TOKEN.findall(_fold(resolved(text))) if text else []


def word_spans(text: str | None) -> list[tuple[int, int]]:
    """Start and end of each of ``words(text)`` in the resolved text; the parts of one token share its span."""
    out: list[tuple[int, int]] = []
    if not text:
        return out
    for m in re.finditer(r"(?:[^\W_]|[̀-ͯ])+", resolved(text)):
        out.extend([m.span()] * len(_TOKEN.findall(_fold(m.group()))))
    return out
