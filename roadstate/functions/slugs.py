"""Text slugs as Column expressions.

Spark has no Unicode normaliser, so the single-character foldings are derived
once from ``unicodedata`` and applied with ``translate``; the few characters
that expand to several ASCII letters (ligatures, fractions, enclosed numbers)
are looked up only in rows that contain one.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, functions as F

# Letters that do not decompose but have a plain form.
STROKE_LETTERS = {"đ": "d", "Đ": "D"}


@cache
def _foldings(form: str) -> tuple[dict[str, str], dict[str, str]]:
    """Non-ASCII characters with an ASCII expansion: one letter, several letters."""
    single, multiple = dict(STROKE_LETTERS), {}
    for code in range(128, sys.maxunicode + 1):
        char = chr(code)
        parts = unicodedata.normalize(form, char)
        if parts == char:
            continue
        folded = "".join(c for c in parts if ord(c) < 128)
        if len(folded) == 1:
            single[char] = folded
        elif folded:
            multiple[char] = folded
    return single, multiple


def slug(col: Column | str, sep: str = "_", empty: str | None = "unknown", form: str = "NFKD") -> Column:
    """Lower-case ASCII slug: runs of other characters become ``sep``.

    ``form="NFKD"`` drops what has no ASCII form; ``form="NFD"`` drops only
    combining marks, so other letters act as separators. ``empty`` replaces a
    null or empty result; with ``empty=None`` it stays ``''``.
    """
    text = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    if empty is not None:
        text = F.when(text == "", F.lit("unknown")).otherwise(text)
    single, multiple = _foldings(form)
    folded = F.translate(text, "".join(single), "".join(single.values()))
    if multiple:
        pairs = "\x01".join(f"{char}\x02{parts}" for char, parts in multiple.items())
        table = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
        spelled = F.array_join(
            F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), ""
        )
        # One hash lookup per character; a regular expression would try every member.
        rare = F.translate(text, "".join(multiple), "") != text
        folded = F.when(rare, spelled).otherwise(folded)
    folded = F.regexp_replace(folded, r"[^\x00-\x7F]" if form == "NFKD" else r"\p{Mn}", "")
    # As many bytes as characters: plain ASCII, nothing to fold.
    folded = F.when(F.octet_length(text) == F.char_length(text), text).otherwise(folded)
    # ASCII case mapping only; other letters are separators anyway.
    body = F.regexp_replace(F.lower(folded), "[^a-z0-9]+", sep)
    body = F.btrim(body, F.lit(sep))
    return body if empty is None else F.regexp_replace(body, "^$", empty)


def dash_slug(col: Column | str) -> Column:
    """The ``-`` form used in replay paths: no default for empty text."""
    return slug(col, sep="-", empty=None, form="NFD")


def safe_name(col: Column | str) -> Column:
    """Run identifiers: keep letters, digits, dot, underscore, dash."""
    text = F.col(col) if isinstance(col, str) else col
    body = F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")
    return F.when(body == "", F.lit("run")).otherwise(body)
