"""Token ids of whole corpora with a public byte-level tokenizer (problem 8).

Method.  A text is a product in a monoid: halves are encoded recursively and joined by re-encoding a window around
the seam.  The window grows, doubling, until both of its ends are positions where the tokenizer's word pattern ends
a match whatever stands around: a character that is no white space, followed by white space.  Tokens before and after
such a position never depend on the other side, so those outside the window stand.  Decoding concatenates the bytes
up the same tree.  Texts of one leaf or less are encoded at once.

The vocabulary file is read on each worker from the folder given as a parameter; it is never shipped with the code.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..shared import spread

TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Word pattern of the byte-level vocabularies, a fixed value of theirs.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LEAF = 1 << 10
FIRST_WINDOW = 32


@functools.lru_cache(maxsize=4)
def coder(folder: str, name: str):
    import tiktoken

    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _widths(folder: str, name: str) -> np.ndarray:
    own = coder(folder, name)
    return np.array([len(own.decode_single_token_bytes(i)) for i in range(own.n_vocab)], np.int32)


def _sure(text: str, start: int, stop: int, step: int) -> int:
    """The first position from ``start`` to ``stop``, both exclusive, where a match surely ends; -1 if there is none."""
    for p in range(start, stop, step):
        if text[p].isspace() and not text[p - 1].isspace():
            return p
    return -1


def _edges(text: str, at: int, low: int, high: int) -> tuple[int, int]:
    """The window around the seam ``at`` inside ``low..high``."""
    w, a, b = FIRST_WINDOW, -1, -1
    tried_a, tried_b = at, at
    while a < 0 or b < 0:
        if a < 0:
            to = max(low, at - w)
            a = _sure(text, tried_a - 1, to, -1) if tried_a - 1 > to else -1
            if a < 0 and to == low:
                a = low
            tried_a = to + 1
        if b < 0:
            to = min(high, at + w)
            b = _sure(text, max(tried_b, at + 1), to, 1) if to > at else -1
            if b < 0 and to == high:
                b = high
            tried_b = to
        w *= 2
    return a, b


def _take(ids: list[int], widths: np.ndarray, n: int, last: bool) -> int:
    """How many tokens at the end (or start) of ``ids`` hold exactly ``n`` bytes."""
    got = k = 0
    while got < n:
        got += int(widths[ids[-1 - k] if last else ids[k]])
        k += 1
    assert got == n, "a window ends inside a token"
    return k


def encode(text: str, own, widths: np.ndarray, leaf: int = LEAF, low: int = 0, high: int | None = None) -> list[int]:
    """Ids of ``text[low:high]``, without special tokens."""
    high = len(text) if high is None else high
    if high - low <= leaf:
        return own.encode_ordinary(text[low:high])
    mid = (low + high) // 2
    left, right = encode(text, own, widths, leaf, low, mid), encode(text, own, widths, leaf, mid, high)
    a, b = _edges(text, mid, low, high)
    cut = _take(left, widths, len(text[a:mid].encode()), True)
    skip = _take(right, widths, len(text[mid:b].encode()), False)
    return left[: len(left) - cut] + own.encode_ordinary(text[a:b]) + right[skip:]


def decode(ids: list[int], own) -> str:
    """The text again: the bytes of both halves, one after the other."""

    def tree(lo: int, hi: int) -> bytes:
        if hi - lo <= LEAF:
            return own.decode_bytes(ids[lo:hi])
        mid = (lo + hi) // 2
        return tree(lo, mid) + tree(mid, hi)

    return tree(0, len(ids)).decode("utf-8", "replace")


def _clean(text: str) -> str:
    """Lone surrogates cannot be encoded as UTF-8; each becomes U+FFFD, as the tokenizer itself does it."""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def encode_texts(texts: list[str | None], folder: str, name: str, leaf: int = LEAF) -> tuple[list[list[int]], np.ndarray]:
    """Ids of each text (none for null) and their numbers."""
    own, widths = coder(folder, name), _widths(folder, name)
    out = [encode(_clean(t), own, widths, leaf) if t else [] for t in texts]
    return out, np.fromiter(map(len, out), np.int64, len(out))


def token_ids(df: DataFrame, id_col: str, text_col: str, name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``(id, ids)`` for each row, ``ids`` being the token ids of its whole text.

    Null and empty texts have the empty list.  Equal texts of different rows have equal ids; repeated rows are
    repeated; other columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, n = encode_texts(b.column(1).to_pylist(), folder, name)
            flat = np.fromiter((x for y in ids for x in y), np.int32, int(n.sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)], pa.int32()), pa.array(flat))], names=["id", "ids"])

    key = df.schema[id_col].dataType.simpleString()
    return spread(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))).mapInArrow(run, f"id {key}, ids array<int>")


def token_counts(df: DataFrame, text_col: str, out_col: str = "n_tokens", name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """``df`` with the number of tokens of a text; 0 for null and empty texts."""

    @F.arrow_udf(IntegerType())
    def count(b: pa.Array) -> pa.Array:
        return pa.array(encode_texts(b.to_pylist(), folder, name)[1].astype(np.int32))

    return df.withColumn(out_col, count(F.col(text_col)))
