"""Keyword-stuffed pages, link lists and tag lists (problem 10), by a word-class n-gram model of prose.

Method.  Nothing about any language is listed.  A first pass finds the function words of each language by their
distribution: words that stand in a fair share of the sentences of its documents.  A second pass counts, over all texts,
which of them follow which at a distance of one and of two words; words that keep the same company form a word class
(k-means over their neighbours).  All other words are classed by shape: by length, figures, codes, parts of links, tags
or mark-up, and ends of sentences; a word that comes again within ``NEAR`` words more often than its frequency in prose
explains is classed as repeated.  Two models score every word: the classes of function words with interpolated bigrams
at both distances, and trigrams of shapes alone, which know prose of a language that the corpus does not have.  A word
is junk if its surroundings are abnormally improbable, or abnormally probable, under both; what is abnormal is measured
on the prose of all texts.  A text is junk when more than half of its white-space separated words are.  A sentence that
says again what an earlier one of the same text said (a refrain) counts as the earlier one did.

Scale.  Word frequencies are one aggregate over all texts; what is kept of it is bounded, as at most a few words can
stand in ``FAIR`` of a language's sentences.  Counts of neighbours, shapes and scores are of fixed size.  The second
pass writes the texts as coded words, three bytes each before compression, which later passes read instead.  All
passes are plain scans without a shuffle of texts.  Words are runs of ``a-z0-9`` after folding, so texts of other scripts
have no words here and are never junk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import drop_table, spread, write_table
from . import shingles

#: A function word stands in this share of the sentences of a language's documents at least.
FAIR = 0.02
#: Documents of a language, as a share of all, that make it one whose words are learned.
SPOKEN = 0.001
#: Words of a sentence that may teach something.
LEAST_WORDS = 6
#: Classes that function words fall into.
KINDS = 24
#: Reach of a repetition, and of the surroundings of a word on either side, in words.
NEAR, REACH = 24, 10
#: Spreads (median deviations) from the median of prose beyond which surroundings are abnormal.
ODD, PLAIN = 5.0, 12.0
#: The worst that a word may say of its surroundings, so that one odd word is no more than that; and of a figure.
WORST, FIGURE = -5.0, -2.5

TINY, SHORT, MIDDLE, LONG, AGAIN, OFTEN, NUMBER, CODE, LINK, TAG, MARKUP, END = range(12)
SHAPES = 12
BINS, LOWEST = 2400, -12.0
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, np.int64)
_STOP[[10, 33, 46, 63]] = 1
_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1


class Sentences:
    """The words of some texts with their sentences and white-space separated chunks."""

    def __init__(self, texts: list[str]):
        w = self.words = shingles.Words(texts)
        data, start, stop = w.data, w.start, w.stop
        self.owner = np.repeat(np.arange(len(texts)), w.counts)
        space = np.cumsum(_SPACE[data])
        self.chunk = space[start]
        colon = np.flatnonzero((data[:-2] == 58) & (data[1:-1] == 47) & (data[2:] == 47))
        linked = np.zeros(int(space[-1]) + 1, bool)
        linked[space[colon]] = True
        self.linked = linked[self.chunk]
        # a sentence ends between two words with a line feed or . ! ? in what separates them, and with a text
        marks = np.cumsum(np.r_[0, _STOP[data]])
        ends = np.zeros(len(start), bool)
        if len(start):
            ends[:-1] = marks[start[1:]] > marks[stop[:-1]]
            ends[:-1] &= ~(self.linked[:-1] & (self.chunk[1:] == self.chunk[:-1]))
            ends[np.cumsum(w.counts)[w.counts > 0] - 1] = True
        self.ends = ends
        self.sentence = np.cumsum(ends) - ends
        self.length = np.bincount(self.sentence) if len(start) else np.zeros(0, np.int64)

    def shapes(self) -> np.ndarray:
        """Shape of each word, repetitions apart."""
        w = self.words
        data, start, stop = w.data, w.start, w.stop
        size = stop - start
        c = np.select([size <= 2, size == 3, size <= 6], [TINY, SHORT, MIDDLE], LONG)
        digits = np.cumsum(np.r_[0, _DIGIT[data]])
        digits = digits[stop] - digits[start]
        c[digits > 0] = CODE
        c[digits == size] = NUMBER
        c[self.linked] = LINK
        before = data[np.maximum(start, 1) - 1]
        c[(before == 60) | ((before == 47) & (data[np.maximum(start, 2) - 2] == 60))] = MARKUP
        c[before == 35] = TAG
        return c

    def told_before(self, fair: np.ndarray, again: np.ndarray) -> np.ndarray:
        """For each word its own place, or that of the same word in an earlier sentence of the text that says the same.

        That is an equal sentence anywhere before (a refrain), or one of the two before that begins and ends alike in
        half of its words or more (a litany).  Sentences of fewer than four words, with hardly a function word
        (``fair`` tells them) or with a word ``again`` in themselves are neither.
        """
        n, h = len(self.sentence), self.words.hash
        place = np.arange(n)
        if not n:
            return place
        first, size = np.flatnonzero(np.r_[True, self.ends[:-1]]), self.length
        step = place - first[self.sentence]
        own = self.owner[first]
        may = (size >= 4) & (4 * np.bincount(self.sentence, fair) >= size) & (np.bincount(self.sentence, again) == 0)
        some = np.flatnonzero(may)
        total = np.r_[np.uint64(0), np.cumsum(shingles.mix(h + step.astype(np.uint64)), dtype=np.uint64)]
        said = shingles.mix(total[first + size] - total[first] + own.astype(np.uint64)) ^ size.astype(np.uint64)
        _, lead, back = np.unique(said[some], return_index=True, return_inverse=True)
        to = np.arange(len(first))
        to[some] = np.where(size[some[lead[back]]] == size[some], some[lead[back]], some)
        out = first[to][self.sentence] + step
        for lag in (1, 2):
            b, a = some[lag:], some[:-lag]
            ok = (own[a] == own[b]) & (to[b] == b)
            a, b = a[ok], b[ok]
            most = np.minimum(size[a], size[b])
            head, tail = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
            for alike, from_a, from_b, sign in ((head, first[a], first[b], 1), (tail, first[a] + size[a] - 1, first[b] + size[b] - 1, -1)):
                on, k = np.arange(len(a)), 0
                while len(on := on[(k < most[on])]) and len(on := on[h[from_a[on] + sign * k] == h[from_b[on] + sign * k]]):
                    k += 1
                    alike[on] = k
            tail = np.minimum(tail, most - head)
            ok = 2 * (head + tail) >= size[b]
            a, b, head, tail = a[ok], b[ok], head[ok], tail[ok]
            for length, from_a, from_b in ((head, first[a], first[b]), (tail, first[a] + size[a] - tail, first[b] + size[b] - tail)):
                k = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
                x = np.repeat(from_b, length) + k
                free = out[x] == x
                out[x[free]] = (np.repeat(from_a, length) + k)[free]
        while (new := out[out]) is not None and (new != out).any():
            out = new
        return out


def _grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal hashes together, in order, and a number that tells the groups apart."""
    if len(h) >= 1 << 24:
        order = np.argsort(h, kind="stable")
        return h[order], order
    # hash and place in one integer: one plain sort
    both = (shingles.mix(h) & ~np.uint64((1 << 24) - 1)) | np.arange(len(h), dtype=np.uint64)
    both.sort()
    return both >> np.uint64(24), (both & np.uint64((1 << 24) - 1)).astype(np.int64)


class Lexicon:
    """Function words: hashes in order, their frequency in prose, and their lengths."""

    def __init__(self, hashes: np.ndarray, often: np.ndarray, length: np.ndarray):
        self.hashes, self.often = hashes, often
        self.shape = np.r_[np.arange(SHAPES), np.select([length <= 2, length == 3, length <= 6], [TINY, SHORT, MIDDLE], LONG)].astype(np.int64)

    def shapes(self, symbols: np.ndarray) -> np.ndarray:
        """Shapes alone."""
        return self.shape[symbols]

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """Number of each function word, -1 for other words."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, word, share, length)``: of each word the sum over documents of its share of their sentences.

    Word 0 has the number of documents, word 1 the sum over them of the mean length of a sentence.
    """
    for b in batches:
        lang, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
        codes = {x: k for k, x in enumerate(dict.fromkeys(lang))}
        of = np.array([codes[x] for x in lang])
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo, hi in shingles.chunks(texts):
            s = Sentences(texts[lo:hi])
            good = s.length >= LEAST_WORDS
            at = np.flatnonzero(good[s.sentence]) if len(good) else np.zeros(0, np.int64)
            if not len(at):
                continue
            head = s.owner[np.flatnonzero(np.r_[True, s.ends[:-1]])]  # the text of each sentence
            n = np.bincount(head[good], minlength=hi - lo)
            group, order = _grouped(s.words.hash[at] + s.sentence[at].astype(np.uint64))
            once = at[order[np.r_[True, group[1:] != group[:-1]]]]
            h, doc = s.words.hash[once], head[s.sentence[once]]
            mean = np.bincount(head[good], s.length[good], minlength=hi - lo) / np.maximum(n, 1)
            docs = np.flatnonzero(n)
            found.append((np.r_[h, np.zeros(len(docs), np.uint64)], of[lo + np.r_[doc, docs]], np.r_[1 / n[doc], np.ones(len(docs))], np.r_[(s.words.stop - s.words.start)[once], np.zeros(len(docs), np.int64)]))
            found.append((np.ones(len(docs), np.uint64), of[lo + docs], mean[docs], np.zeros(len(docs), np.int64)))
        if not found:
            continue
        h, k, x, length = (np.concatenate(c) for c in zip(*found))
        order = np.argsort(h)
        if len(codes) > 1:
            order = order[np.argsort(k[order].astype(np.uint16), kind="stable")]
        h, k, x, length = h[order], k[order], x[order], length[order]
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (k[1:] != k[:-1])])
        names = list(codes)
        yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in k[first]], pa.string()), pa.array(h[first].view(np.int64)), pa.array(np.add.reduceat(x, first)), pa.array(length[first])], names=["lang", "word", "share", "length"])


def function_words(texts: DataFrame) -> Lexicon:
    """Function words of all languages of ``texts(lang, t)``; a null language is one of its own."""
    sums = spread(texts.select("lang", "t")).mapInArrow(_shares, "lang string, word long, share double, length long").groupBy("lang", "word").agg(F.sum("share").alias("share"), F.max("length").alias("length"))
    sums = write_table(sums, "shares")  # read several times
    docs = sums.where("word = 0").select(F.col("lang").alias("l"), F.col("share").alias("docs"))
    many = sums.where("word = 0").agg(F.sum("share").alias("all"))
    size = sums.where("word = 1").select(F.col("lang").alias("m"), F.col("share").alias("words"))
    rows = sums.where("word not in (0, 1)").join(F.broadcast(docs.join(size, F.col("l").eqNullSafe(F.col("m")))), F.col("lang").eqNullSafe(F.col("l"))).crossJoin(F.broadcast(many))  # one row on the right
    # at most (words of a sentence) / FAIR words of a language, at most 1 / SPOKEN languages
    rows = rows.where((F.col("docs") >= SPOKEN * F.col("all")) & (F.col("share") >= FAIR * F.col("docs")))
    kept = rows.groupBy("word").agg(F.max(F.col("share") / F.col("words")).alias("often"), F.max("length").alias("length")).collect()
    h, often, length = np.array([r.word for r in kept], np.int64).view(np.uint64), np.array([r.often for r in kept], float), np.array([r.length for r in kept], int)
    drop_table(sums)
    order = np.argsort(h)
    return Lexicon(h[order], often[order], length[order])


class Classed:
    """Shapes and function words of the words of some texts, in order, with ends of sentences put in."""

    def __init__(self, texts: list[str], lexicon: Lexicon):
        s = self.s = Sentences(texts)
        number = lexicon.look_up(s.words.hash)
        c = s.shapes()
        number = np.where(c > LONG, -1, number)
        # how often the same word stands among the NEAR words before, up to eight times
        n = len(c)
        group, order = _grouped(s.words.hash + s.owner.astype(np.uint64))
        held, inside = np.zeros(n, np.int64), np.zeros(n, bool)
        for lag in range(1, min(9, n)):
            hit = (group[lag:] == group[:-lag]) & (order[lag:] - order[:-lag] <= NEAR)
            if not hit.any():
                break
            held[order[lag:]] += hit
            if lag == 1:
                inside[order[1:]] = hit & (s.sentence[order[1:]] == s.sentence[order[:-1]])
        rate = np.where(c <= SHORT, 1.5, 0.05)  # any language has short words that come again and again
        if len(lexicon.often):
            rate = np.where(number >= 0, np.maximum(NEAR * lexicon.often[number], 0.05), rate)
        usual = rate + 2 * np.sqrt(rate) + 0.5
        place = s.told_before(number >= 0, inside & (c >= MIDDLE) & (number < 0))
        more = held > usual
        c = np.where(more & (c <= LONG), np.where(held > usual + 1, OFTEN, AGAIN), c)
        self.shape = c[place]
        self.number = np.where(more, -1, number)[place]


#: Marks of a coded word: the last of its sentence, the first of a white-space separated chunk, in a prose sentence.
ENDS, CHUNK, PROSE = 1, 2, 4
_CODED = "id long, symbols binary, marks binary, kind int, cell long, n long"


class Coded:
    """Texts as coded words: ``symbols`` are shapes, or function words by number, and ``marks``."""

    def __init__(self, symbols: np.ndarray, marks: np.ndarray, counts: np.ndarray, lexicon: Lexicon):
        self.symbols, self.marks, self.counts, self.lexicon = symbols, marks, counts, lexicon

    def sequence(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes with two ends before every sentence and after the last, and the place of each word in them."""
        ends = (self.marks & ENDS) > 0
        first = np.r_[True, ends[:-1]] if len(ends) else ends
        place = np.arange(len(classes)) + 2 * np.cumsum(first)
        seq = np.full(len(classes) + 2 * int(first.sum()) + 1, END, np.int64)
        seq[place] = classes
        return seq, place


def _coded(texts: list[str], lexicon: Lexicon) -> Coded:
    x = Classed(texts, lexicon)
    s = x.s
    if not len(x.shape):
        return Coded(np.zeros(0, np.uint16), np.zeros(0, np.uint8), s.words.counts, lexicon)
    # what may teach what prose is: long enough, without links and the like, with function words, hardly a repetition
    plain = np.bincount(s.sentence, (x.shape >= CODE) & (x.shape <= MARKUP)) == 0
    plain &= 4 * np.bincount(s.sentence, (x.shape == AGAIN) | (x.shape == OFTEN)) <= s.length
    prose = (s.length >= LEAST_WORDS) & plain & (5 * np.bincount(s.sentence, x.number >= 0) >= s.length)
    first = np.r_[True, s.chunk[1:] != s.chunk[:-1]]
    marks = s.ends * ENDS + first * CHUNK + prose[s.sentence] * PROSE
    return Coded(np.where(x.number >= 0, SHAPES + x.number, x.shape).astype(np.uint16), marks.astype(np.uint8), s.words.counts, lexicon)


def _count(lexicon: Lexicon, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Coded texts, and at the end what was counted over them."""
    m = len(lexicon.hashes) + SHAPES
    near, far, tri = np.zeros(m * m), np.zeros(m * m), np.zeros(SHAPES**3)
    names = [x.split(" ")[0] for x in _CODED.split(", ")]
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64())
    for b in batches:
        ids, texts = b.column(0), [t or "" for t in b.column(1).to_pylist()]
        symbols, marks = [], []
        for lo, hi in shingles.chunks(texts):
            x = _coded(texts[lo:hi], lexicon)
            cut = np.r_[0, np.cumsum(x.counts)]
            symbols += [x.symbols[i:j].tobytes() for i, j in zip(cut, cut[1:])]
            marks += [x.marks[i:j].tobytes() for i, j in zip(cut, cut[1:])]
            of = (x.marks & PROSE) > 0
            seq, place = x.sequence(x.symbols)
            p = place[of]
            p = np.r_[p, place[((x.marks & ENDS) > 0) & of] + 1]  # the end of the sentence as well
            near += np.bincount(seq[p - 1] * m + seq[p], minlength=m * m)
            far += np.bincount(seq[p - 2] * m + seq[p], minlength=m * m)
            seq = lexicon.shapes(seq)
            tri += np.bincount((seq[p - 2] * SHAPES + seq[p - 1]) * SHAPES + seq[p], minlength=len(tri))
        none = pa.nulls(len(texts), pa.int64())
        yield pa.RecordBatch.from_arrays([ids, pa.array(symbols, pa.binary()), pa.array(marks, pa.binary()), none.cast(pa.int32()), none, none], names=names)
    for kind, n in enumerate((near, far, tri)):
        k = np.flatnonzero(n)
        none = [None] * len(k)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((none, none, none, np.full(len(k), kind, np.int32), k, n[k].astype(np.int64)), kinds)], names=names)


def _kinds(near: np.ndarray, m: int) -> np.ndarray:
    """Class of each of the first ``m`` symbols' function words by the company they keep: k-means on root shares."""
    x = np.concatenate([near, near.T], 1)[SHAPES:]
    x = np.sqrt(x / np.maximum(x.sum(1, keepdims=True), 1))
    if len(x) <= KINDS:
        return np.arange(len(x))
    # the commonest word first, then always the one farthest from all chosen
    seeds = [int(near[SHAPES:].sum(1).argmax())]
    gap = ((x - x[seeds[0]]) ** 2).sum(1)
    while len(seeds) < KINDS:
        seeds.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[seeds[-1]]) ** 2).sum(1))
    centre = x[seeds]
    own = np.zeros(len(x), np.int64)
    for _ in range(30):
        new = ((x**2).sum(1)[:, None] - 2 * x @ centre.T + (centre**2).sum(1)).argmin(1)
        if (new == own).all():
            break
        own = new
        centre = np.stack([x[own == k].mean(0) if (own == k).any() else centre[k] for k in range(KINDS)])
    return own


class Model:
    """Log probabilities of classes after the class before and the one before that, and of shapes after two shapes."""

    def __init__(self, lexicon: Lexicon, near: np.ndarray, far: np.ndarray, tri: np.ndarray):
        self.lexicon = lexicon
        to = self.to = np.r_[np.arange(SHAPES), SHAPES + _kinds(near, len(near))].astype(np.int64)
        c = self.classes = SHAPES + KINDS
        one = np.zeros((len(to), c))
        one[np.arange(len(to)), to] = 1
        near, far = one.T @ near @ one, one.T @ far @ one
        p0 = (near.sum(0) + 1) / (near.sum() + c)
        p1, p2 = ((n + 5 * p0) / (n.sum(1, keepdims=True) + 5) for n in (near, far))
        self.logs = np.log(0.5 * p1[None, :, :] + 0.35 * p2[:, None, :] + 0.15 * p0).astype(np.float32).ravel()  # [before that, before, now]
        bi = tri.sum(0)
        b0 = (bi.sum(0) + 1) / (bi.sum() + SHAPES)
        b1 = (bi + 5 * b0) / (bi.sum(1, keepdims=True) + 5)
        self.shape_logs = np.log((tri + 5 * b1) / (tri.sum(2, keepdims=True) + 5)).astype(np.float32).ravel()
        self.normal = ((LOWEST, 0.0), (LOWEST, 0.0))  # nothing is abnormal before it is measured

    def surroundings(self, x: Coded) -> tuple[np.ndarray, np.ndarray]:
        """Mean log probability of the surroundings of each word under both models."""
        out = []
        n = x.counts
        low, high = np.repeat(np.cumsum(n) - n, n), np.repeat(np.cumsum(n), n)
        at = np.arange(len(x.symbols))
        a, b = np.maximum(at - REACH, low), np.minimum(at + REACH + 1, high)
        number = x.symbols == NUMBER
        for classes, logs, c in ((self.to[x.symbols], self.logs, self.classes), (self.lexicon.shapes(x.symbols), self.shape_logs, SHAPES)):
            seq, place = x.sequence(classes)
            score = logs[(seq[place - 2] * c + seq[place - 1]) * c + seq[place]].astype(np.float64)
            score = np.maximum(score, np.where(number, FIGURE, WORST))
            total = np.r_[0, np.cumsum(score)]
            out.append((total[b] - total[a]) / (b - a))
        return out[0], out[1]


def _read(model: Model, b: pa.RecordBatch) -> Coded:
    symbols = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(x, np.uint16) for x in b.column(1).to_pylist())])
    marks = b.column(2).to_pylist()
    return Coded(symbols, np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(x, np.uint8) for x in marks)]), np.array([len(x) for x in marks], np.int64), model.lexicon)


def _measure(model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros((2, BINS), np.int64)
    for b in batches:
        x = _read(model.value, b)
        of = (x.marks & PROSE) > 0
        for k, mean in enumerate(model.value.surroundings(x)):
            cell = np.clip((mean[of] / LOWEST * BINS).astype(np.int64), 0, BINS - 1)
            n[k] += np.bincount(cell, minlength=BINS)
    k, cell = n.nonzero()
    yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(cell), pa.array(n[k, cell])], names=["kind", "cell", "n"])


def _normal(n: np.ndarray) -> tuple[float, float]:
    """The range of mean log probabilities that prose has, from their histogram: median and median deviation."""
    if not n.sum():
        return LOWEST, 0.0
    middle = (np.arange(BINS) + 0.5) / BINS * LOWEST

    def median(x: np.ndarray, w: np.ndarray) -> float:
        order = np.argsort(x, kind="stable")
        return float(x[order][np.searchsorted(np.cumsum(w[order]), w.sum() / 2)])

    at = median(middle, n)
    spread_ = max(median(np.abs(middle - at), n), 0.05)
    return at - ODD * spread_, min(at + PLAIN * spread_, -0.05)


def prose_model(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of prose of ``docs(id, lang, text)``, and its coded texts ``(id, symbols, marks)``.

    All texts are counted, and what is normal is measured on all of them.
    """
    spark = docs.sparkSession
    lexicon = function_words(docs.select("lang", F.col("text").alias("t")))
    m = len(lexicon.hashes) + SHAPES
    coded = write_table(spread(docs.select("id", "text")).mapInArrow(lambda it: _count(lexicon, it), _CODED), "coded", "zstd")
    near, far, tri = np.zeros(m * m), np.zeros(m * m), np.zeros(SHAPES**3)
    got = coded.where("kind is not null").groupBy("kind", "cell").agg(F.sum("n").alias("n")).toPandas()  # at most 2 * m ** 2 + SHAPES ** 3 cells
    for kind, n in enumerate((near, far, tri)):
        own = got[got.kind == kind]
        n[own.cell.to_numpy()] = own.n.to_numpy()
    model = Model(lexicon, near.reshape(m, m), far.reshape(m, m), tri.reshape(SHAPES, SHAPES, SHAPES))
    sent = spark.sparkContext.broadcast(model)
    n = np.zeros((2, BINS), np.int64)
    words = coded.where("kind is null").select("id", "symbols", "marks")
    words.shared_path = coded.shared_path
    for r in words.mapInArrow(lambda it: _measure(sent, it), "kind int, cell long, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")).collect():
        n[r.kind, r.cell] = r.n
    model.normal = _normal(n[0]), _normal(n[1])
    return model, words


def _scores(x: Coded, model: Model) -> np.ndarray:
    """Share of junk words of each text."""
    n = len(x.counts)
    if not len(x.symbols):
        return np.zeros(n)
    odd, plain = np.ones(len(x.symbols), bool), np.ones(len(x.symbols), bool)
    for mean, (low, high) in zip(model.surroundings(x), model.normal):
        odd &= mean < low
        plain &= mean > high
    # every white-space separated chunk counts once
    owner = np.repeat(np.arange(n), x.counts)
    start = (x.marks & CHUNK) > 0
    start[np.r_[True, owner[1:] != owner[:-1]]] = True
    k = np.cumsum(start) - 1
    share = np.bincount(k, odd | plain) / np.bincount(k)
    owner = owner[start]
    return np.bincount(owner, share, minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)


def junk_shares(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None = None) -> DataFrame:
    """``(id, share)``: the share of junk words of each text, 0 for null, empty and wordless ones; ids are integers.

    Equal texts have equal shares; repeated rows are repeated; an empty table gives an empty result; other columns
    are ignored.  ``lang_col``, if given, may be null; without it all texts count as one language.  Where no text has
    any prose to measure what is normal by, nothing is abnormal and all shares are 0.
    """
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), lang.alias("lang"), F.col(text_col).cast("string").alias("text"))
    fitted, words = prose_model(rows)
    model = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_scores(_read(model.value, b), model.value))], names=["id", "share"])

    return words.mapInArrow(run, "id long, share double")
