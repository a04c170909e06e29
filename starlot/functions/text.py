"""Accent-folding normalisation of texts and of column headers."""

from __future__ import annotations

import string
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separators of the fold table's text; no character of a fold.
_IS, _NEXT = "=", ";"

_KEPT = frozenset(string.ascii_lowercase + string.digits + " ")
_DROPPED = "".join(chr(code) for code in range(0x80) if chr(code) not in _KEPT)


@lru_cache(maxsize=1)
def fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Compatibility folds of all non-ASCII characters that leave some kept character.

    Returned as (folds to one character, folds to several).  Spark has no
    compatibility decomposition, so the rule is evaluated once on the driver and
    shipped as literals.
    """
    one: dict[str, str] = {}
    several: dict[str, str] = {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char):
            continue
        kept = "".join(c for c in unicodedata.normalize("NFKD", char) if c in _KEPT)
        if len(kept) == 1:
            one[char] = kept
        elif kept:
            several[char] = kept
    return one, several


@lru_cache(maxsize=1)
def _fold_texts() -> tuple[str, str, str, str]:
    """The tables as few long texts, which keep plans small."""
    one, several = fold_tables()
    pairs = _NEXT.join(char + _IS + fold for char, fold in several.items())
    return "".join(one), "".join(one.values()), "".join(several), pairs


def _widen(text: Column) -> Column:
    _, _, marks, pairs = _fold_texts()
    lookup = F.str_to_map(F.lit(pairs), F.lit(_NEXT), F.lit(_IS))
    # Characters such as ligatures and fractions become more than one letter; they
    # are rare, so the per-character walk runs only on texts that hold one.
    return F.when(
        F.translate(text, marks, "") != text,
        F.array_join(
            F.transform(F.split(text, ""), lambda ch: F.coalesce(F.try_element_at(lookup, ch), ch)),
            "",
        ),
    ).otherwise(text)


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def normalise_text(text: Column) -> Column:
    """Lower case, accents folded, only ``a-z 0-9`` and single inner blanks kept.

    Null becomes the empty string.  Tabs and line breaks are deleted, not turned
    into blanks, so ``"a\\tb"`` gives ``"ab"`` while ``"a - b"`` gives ``"a b"``.
    """
    chars, folds, _, _ = _fold_texts()
    base = F.lower(F.trim(F.coalesce(text.cast("string"), F.lit(""))))
    widened = F.when(_is_ascii(base), base).otherwise(_widen(base))
    # One table walk folds accents and deletes the other ASCII characters: a negated
    # character class would do the latter, but does not scale over a task's threads.
    folded = F.translate(widened, chars + _DROPPED, folds)
    letters = F.when(_is_ascii(folded), folded).otherwise(F.regexp_replace(folded, "[^ -~]", ""))
    return F.trim(F.regexp_replace(letters, " {2,}", " "))


def normalise_header(name: str) -> str:
    """``" Código Venda "`` -> ``"codigo_venda"``; punctuation stays (``dt._venda``)."""
    flat = name.strip().lower().replace(" ", "_")
    decomposed = unicodedata.normalize("NFKD", flat)
    return "".join(ch for ch in decomposed if ord(ch) < 128)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Rename all columns on the driver; a metadata-only projection."""
    names = [normalise_header(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"headers fall together after normalising: {clashes}")
    return df.toDF(*names)
