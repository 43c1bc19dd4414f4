"""Sets of word-sequence fingerprints, computed for whole Arrow batches at once with NumPy.

A text is decomposed canonically, U+0300-U+036F are dropped, the rest is lower-cased and its words are the
maximal runs of ``a-z0-9``.  Every run of ``width`` words becomes one 48-bit fingerprint, the
high bits of an integer of 64.  No step works text by
text except the decomposition itself, which ``unicodedata`` does in C.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np

_MARKS = re.compile("[̀-ͯ]+")
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_CHUNK = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_cache: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * _STEP
    x ^= x >> np.uint64(32)
    x *= _STEP
    x ^= x >> np.uint64(29)
    return x


def fold(text: str) -> str:
    """Decomposed, without U+0300-U+036F, in lower case."""
    if text.isascii():
        return text.lower()
    return _MARKS.sub("", unicodedata.normalize("NFD", text)).lower()


class Words:
    """The words of some texts: hashes, first and last bytes in ``data``, and the number of words of each text."""

    def __init__(self, texts: list[str]):
        raw = [(t if t.isascii() else unicodedata.normalize("NFD", t)).lower().encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        edges = np.cumsum([len(r) + 1 for r in raw])
        # U+0300-U+036F are the bytes CC 80 to CD AF
        mark = data[:-1] == 0xCC
        mark |= (data[:-1] == 0xCD) & (data[1:] <= 0xAF)
        if mark.any():
            keep = np.ones(len(data), bool)
            keep[:-1] &= ~mark
            keep[1:] &= ~mark
            edges = np.cumsum(keep)[edges - 1]
            data = data[keep]
        self.data, self.edges = data, edges
        if len(self.data) > _CHUNK * 2:
            up, down = _powers(len(self.data) + 1)
        else:
            if "p" not in _cache:
                _cache["p"] = _powers(_CHUNK * 2 + 1)
            up, down = _cache["p"]
        inside = _INSIDE[self.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.r_[0, edge]
        self.start, self.stop = edge[::2], edge[1::2]
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data + np.uint64(1)) * up[: len(self.data)], out=total[1:])
        self.hash = mix((total[self.stop] - total[self.start]) * down[self.start])
        self.counts = np.diff(np.searchsorted(self.start, self.edges), prepend=0)


_INSIDE = np.zeros(256, bool)
_INSIDE[97:123] = _INSIDE[48:58] = True


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that are small enough to be looked at together; a very long text is one by itself."""
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and (end == at or size + len(texts[end]) < _CHUNK):
            size += len(texts[end]) + 1
            end += 1
        yield at, end
        at = end


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text."""
    parts = [Words(texts[a:b]) for a, b in chunks(texts)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate([p.hash for p in parts]), np.concatenate([p.counts for p in parts])


def shingle_sets(texts: list[str], width: int, least_words: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints of each text, one after another; how many each has; how many words each has.

    A text of fewer than ``max(width, least_words)`` words has none.
    """
    words, counts = word_hashes(texts)
    if len(words) < width:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), counts
    grams = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        grams = mix(grams + np.uint64(k)) ^ words[k : len(words) - width + 1 + k]
    grams = mix(grams)
    first = np.cumsum(counts) - counts
    n = np.where(counts >= max(width, least_words), counts - width + 1, 0)
    owner = np.repeat(np.arange(len(texts)), n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    tokens = grams[first[owner] + within] >> np.uint64(16)
    found, sizes = [], []
    for lo in range(0, len(texts), 1 << 16):  # text and fingerprint in one integer: one plain sort
        a, b = np.searchsorted(owner, (lo, lo + (1 << 16)))
        both = (owner[a:b] - lo).astype(np.uint64) << np.uint64(48) | tokens[a:b]
        both.sort()
        both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
        found.append(both << np.uint64(16))
        sizes.append(np.bincount((both >> np.uint64(48)).astype(np.int64), minlength=min(1 << 16, len(texts) - lo)))
    return np.concatenate(found), np.concatenate(sizes), counts
