"""Normal forms of text as Column expressions; each has its own rules and they are not interchangeable."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGES = ((0xC0, 0x250), (0x370, 0x530), (0x1E00, 0x2000))


@functools.cache
def _accented() -> tuple[str, str]:
    """Letters that decompose into one letter and marks, and those letters."""
    whole, base = [], []
    for lo, hi in _RANGES:
        for k in range(lo, hi):
            d = unicodedata.normalize("NFD", chr(k))
            letters = [c for c in d if not unicodedata.combining(c)]
            if len(d) > 1 and len(letters) == 1:
                whole.append(chr(k))
                base.append(letters[0])
    return "".join(whole), "".join(base)


def unaccent(c: Column) -> Column:
    """Letters without their diacritics, whether these stand apart or not."""
    whole, base = _accented()
    return F.regexp_replace(F.translate(c, whole, base), r"\p{Mn}+", "")


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def key_fr(c: Column) -> Column:
    """Lower case, no diacritics, no full stops, single spaces."""
    return _squeeze(F.regexp_replace(unaccent(F.lower(c)), r"\.", ""))


def key_en(c: Column) -> Column:
    """As ``key_fr``, diacritics kept."""
    return _squeeze(F.regexp_replace(F.lower(c), r"\.", ""))


def token_id(c: Column, most: int = 60) -> Column:
    """``a-z0-9`` joined by underscores, at most ``most`` characters, ``x`` where nothing is left."""
    t = F.substring(F.regexp_replace(F.regexp_replace(unaccent(F.lower(c)), "[^a-z0-9]+", "_"), "^_+|_+$", ""), 1, most)
    return F.when(F.length(t) > 0, t).otherwise("x")


def ref_id(c: Column, most: int = 60) -> Column:
    """As ``token_id``, dashes read as "to" and commas as "and", so that ranges and lists stay apart."""
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[–—]", "-"), "-", "to"), ",", "and")
    return token_id(t, most)


def words(c: Column) -> Column:
    """Array of the runs of ``a-z0-9``."""
    bare = F.trim(F.regexp_replace(unaccent(F.lower(c)), "[^a-z0-9]+", " "))
    return F.when(F.length(bare) > 0, F.split(bare, " ")).when(bare.isNotNull(), F.array().cast("array<string>"))


@functools.cache
def _plain() -> tuple[str, str]:
    """Signs that lower case and ``unaccent`` turn into another one of ``a-z0-9``, and what they become."""
    base = dict(zip(*_accented()))
    folded = ((chr(k), "".join(base.get(x, x) for x in chr(k).lower() if not unicodedata.combining(x))) for k in range(_RANGES[-1][1] + 0x200))
    kept = [(c, f) for c, f in folded if f != c and len(f) == 1 and f.isascii() and f.isalnum()]
    return "".join(c for c, _ in kept), "".join(f for _, f in kept)


def words_once(c: Column, least: int = 1) -> Column:
    """As ``words``, those of ``least`` letters or more; says its text once and in fewer passes, for work on whole texts."""
    return F.regexp_extract_all(F.regexp_replace(F.translate(c, *_plain()), r"\p{Mn}+", ""), F.lit(f"[a-z0-9]{{{least},}}+"), F.lit(0))


def words_accented(c: Column, least: int = 4) -> Column:
    """Array of the words of at least ``least`` letters, accents kept."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), "[^a-zà-ÿ ]+", " "), " +"), lambda w: F.length(w) >= least)


def phrase(c: Column) -> Column:
    """Lower case, straight apostrophes, single spaces, no link targets."""
    bare = F.regexp_replace(c, r"\]\([^)]*\)", "]")
    return _squeeze(F.lower(F.regexp_replace(bare, "[’‘]", "'")))


def title(c: Column) -> Column:
    """Words of ``a-z0-9`` with single spaces."""
    return F.trim(F.regexp_replace(unaccent(F.lower(c)), "[^a-z0-9]+", " "))


def spelling_key(c: Column) -> Column:
    """A person's name without diacritics, case and leading title."""
    t = _squeeze(F.lower(F.regexp_replace(unaccent(c), "’", "'")))
    return F.regexp_replace(t, r"^(?:fr|frere|soeur|pasteur|past|rev|dr|evangeliste)\.? ", "")


def slug(c: Column) -> Column:
    """Lower-case words joined by hyphens, ligatures spelled out."""
    t = F.regexp_replace(F.regexp_replace(unaccent(F.lower(c)), "œ", "oe"), "æ", "ae")
    return F.regexp_replace(F.regexp_replace(t, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def fold_print(c: Column) -> Column:
    """Without diacritics and case, runs of blanks and tabs as one space; line feeds stay."""
    return F.trim(F.regexp_replace(unaccent(F.lower(c)), "[ \t]+", " "))


def unmark(c: Column) -> Column:
    """Markdown as plain text: links as their text, without headings, quotes, list numbers, emphasis and escapes."""
    t = F.regexp_replace(c, r"!?\[([^\]]*)\]\([^)]*\)", "$1")
    t = F.regexp_replace(t, r"(?m)^\s*(?:>\s?|#{1,6}\s+|\d+\.\s+|[-*]\s+)+", "")
    t = F.regexp_replace(t, r"(?<!\\)[*_]{1,3}", "")
    return F.regexp_replace(t, r"\\([*_\[\]()#.!-])", "$1")
