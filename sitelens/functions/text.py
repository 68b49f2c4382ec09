"""Text normalisation and block functions (all JVM-side)."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def accent_pairs() -> tuple[str, str]:
    """Characters whose canonical decomposition is one base character plus marks.

    Generated from the Unicode tables: characters without a decomposition
    (o-slash, l-stroke, eszett) are kept as they are.
    """
    source, target = [], []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        parts = unicodedata.normalize("NFD", char)
        base = "".join(c for c in parts if not unicodedata.category(c).startswith("M"))
        if len(parts) > 1 and len(base) == 1 and base != char:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def strip_accents(col: Column) -> Column:
    source, target = accent_pairs()
    return F.regexp_replace(F.translate(col, source, target), r"\p{M}+", "")


def normalized_name(col: Column) -> Column:
    return strip_accents(F.lower(F.trim(col)))


def contains_folded(text: Column, phrase: Column) -> Column:
    """Case-insensitive substring test."""
    return F.contains(F.lower(text), F.lower(phrase))


def mentions(text: Column, word: Column) -> Column:
    """Non-overlapping occurrences of ``word`` in the whole text."""
    removed = F.length(text) - F.length(F.replace(text, word, F.lit("")))
    return F.floor(removed / F.length(word)).cast("long")


def text_blocks(text: Column, boundary: str) -> Column:
    """Split on a regular expression; a look-ahead boundary keeps headings."""
    return F.split(text, boundary)
