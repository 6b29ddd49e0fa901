"""Text functions on columns: folding, slugs and normalised names."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@lru_cache(1)
def _fold_table() -> tuple[str, str]:
    """Characters of the Latin blocks with their single-letter NFKD base, made by rule."""
    src, dst = [], []
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii():
            src.append(chr(cp))
            dst.append(base)
    return "".join(src), "".join(dst)


def fold_ascii(c: Column) -> Column:
    """Accented Latin letters become their base letter, other non-ASCII characters go.

    Combining marks go too, so composed and decomposed spellings agree. Null stays null.
    """
    src, dst = _fold_table()
    return F.regexp_replace(F.translate(c, src, dst), r"[^\x00-\x7F]", "")


def trim_all(c: Column) -> Column:
    """Outer white space of any kind removed."""
    return F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")


def normalize_heading(c: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """A regex group, null where the pattern does not match (Spark gives '')."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def slugify(name: Column, prefixes: tuple[str, ...] = ()) -> Column:
    """ASCII-folded kebab slug; the first (longest) matching maker prefix is removed.

    A name that equals a prefix gives ''. Null gives null, '' gives ''.
    """
    low = F.lower(F.trim(fold_ascii(name)))
    body = low
    if prefixes:
        chain = None
        for p in sorted(prefixes, key=len, reverse=True):
            hit = low.startswith(p + " ") | (low == p)
            value = F.trim(F.substr(low, F.lit(len(p) + 1)))
            chain = F.when(hit, value) if chain is None else chain.when(hit, value)
        body = chain.otherwise(low)
    return F.regexp_replace(F.regexp_replace(body, "[^a-z0-9]+", "-"), "^-+|-+$", "")
