"""Tokens, shingles and similarities as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import norm

# fixed values: elided French words, and words too common to open or close a phrase
ELIDED = "^(?:l|d|j|m|t|s|n|c|qu|jusqu|lorsqu|puisqu)'"
STOP = "le la les un une des de du et ou mais dans sur avec pour par que qui quoi dont est sont ce cette ces son sa ses leur nous vous ils elles elle lui pas plus sans comme tout tous the and of to in is are was that this with for not".split()


def fingerprint(text: Column, n: int = 200) -> Column:
    """The first ``n`` words of four letters or more, then distinct."""
    return F.array_distinct(F.slice(norm.words_accented(text), 1, n))


def fingerprint_distinct(text: Column, n: int = 200) -> Column:
    """The first ``n`` distinct words of four letters or more."""
    return F.slice(F.array_distinct(norm.words_accented(text)), 1, n)


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` made once: inside a lambda, Spark makes whatever is no variable again for each element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _run(words: Column, k: Column, width: int) -> Column:
    """The ``width`` words from the ``k``-th on, counted from 0."""
    return F.concat_ws(" ", *[F.get(words, k + j) for j in range(width)])


def _runs(words: Column, width: int, edges: Column | None = None) -> Column:
    """All runs of ``width`` words, or those whose first and last words are ``edges``; all of them variables."""
    n = F.size(words) - width
    first = F.sequence(F.lit(0), n)
    if edges is not None:
        first = F.filter(first, lambda k: F.get(edges, k) & F.get(edges, k + (width - 1)))
    return F.when(n >= 0, F.transform(first, lambda k: _run(words, k, width))).otherwise(F.array().cast("array<string>"))


def shingles(words: Column, width: int = 5) -> Column:
    """Distinct runs of ``width`` words; none of shorter texts."""
    return F.array_distinct(_once(words, lambda w: _runs(w, width)))


def _bare(words: Column) -> Column:
    """Words of two letters or more, elisions cut off."""
    return F.filter(F.transform(words, lambda w: F.when(F.contains(w, F.lit("'")), F.regexp_replace(w, ELIDED, "")).otherwise(w)), lambda w: F.length(w) > 1)


def _edge(word: Column) -> Column:
    return (F.length(word) >= 4) & ~word.isin(STOP)


def ngrams(words: Column, *widths: int) -> Column:
    """Phrases of ``widths`` words without elisions, whose first and last words have four letters and are no stop words."""
    return _once(_bare(words), lambda b: _once(F.transform(b, _edge), lambda e: F.concat(*[_runs(b, n, e) for n in widths])))


def bigrams(words: Column, mark: str) -> Column:
    """``ngrams`` of two words, joined by ``mark``; ``words`` have two letters or more.

    Each word is looked at as seldom as can be: two neighbours that are no phrase are null, which no join shows.
    """
    edges = lambda w: F.transform(w, lambda x: F.when(_edge(x), x))
    pairs = lambda e: F.array_join(F.zip_with(e, F.slice(e, 2, F.size(e)), lambda a, b: F.concat(a, F.lit(" "), b)), mark)
    bare = lambda w: F.when(F.exists(w, lambda x: F.contains(x, F.lit("'"))), _bare(w)).otherwise(w)
    return _once(words, lambda w: _once(edges(bare(w)), pairs))


def stems(words: Column) -> Column:
    """Distinct short stems: no stop words, endings cut, six letters."""
    kept = F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(STOP))
    return F.array_distinct(F.transform(kept, lambda w: F.substring(F.regexp_replace(w, "(?:ing|ed|es|s)$", ""), 1, 6)))


def ocr_noise(text: Column) -> Column:
    """How many words look misread: a capital inside, replacement signs, or a hyphen at the end."""
    return F.size(F.filter(F.split(text, r"\s+"), lambda w: w.rlike(r"\p{Ll}\p{Lu}|[�ﬁﬂ]|\p{L}-$")))


def jaccard(a: Column, b: Column) -> Column:
    """Shared by all; 0 where both are empty."""
    n = F.size(F.array_union(a, b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(F.lit(0.0))


def dice_title(a: Column, b: Column) -> Column:
    """Shared words of more than three letters of two titles, twice, by the words of both."""
    x, y = (F.array_distinct(F.filter(norm.words(t), lambda w: F.length(w) > 3)) for t in (a, b))
    n = F.size(x) + F.size(y)
    return F.when(n > 0, 2 * F.size(F.array_intersect(x, y)) / n).otherwise(F.lit(0.0))


def containment(shared: Column, size: Column) -> Column:
    """Shared part of one side, to three decimals."""
    return F.round(shared / size, 3)


def band(share_ab: Column, share_ba: Column, title: Column | None = None) -> Column:
    """same_text, same_sermon, uncertain or none, by the shares of both sides and the likeness of the titles."""
    low, high = F.least(share_ab, share_ba), F.greatest(share_ab, share_ba)
    weak = high >= 0.20
    if title is not None:
        weak = weak | ((title >= 0.75) & (high >= 0.10))
    return F.when(low >= 0.90, "same_text").when(high >= 0.70, "same_sermon").when(weak, "uncertain").otherwise("none")


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common beginning, whatever the case and the shape of apostrophes."""
    x, y = (F.regexp_replace(F.lower(c), "’", "'") for c in (a, b))
    n = F.least(F.length(x), F.length(y))
    same = F.filter(F.sequence(F.lit(1), n), lambda k: F.substring(x, F.lit(1), k) == F.substring(y, F.lit(1), k))
    return F.when(n > 0, F.size(same)).otherwise(0)


def shares_stem(a: Column, b: Column) -> Column:
    """Whether two titles begin with the same two words or more, of eight letters together, part numbers apart."""
    bare = lambda c: norm.title(F.regexp_replace(F.lower(c), r"\(?\b(?:partie|part|chapitre)?\s*\d+\)?\s*$", ""))
    x, y = bare(a), bare(b)
    two = lambda t: F.array_join(F.slice(F.split(t, " "), 1, 2), " ")
    return (F.size(F.split(x, " ")) >= 2) & (two(x) == two(y)) & (F.length(two(x)) >= 8)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, in doubles; null where one is null or zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm2 = dot(a, a) * dot(b, b)
    return F.when(norm2 > 0, dot(a, b) / F.sqrt(norm2))
