"""Near-duplicate records (problem 1): an exact set-similarity join by distributed signature trees.

Method.  A text is its set of word-sequence fingerprints.  The forest of signature trees has one tree for each
fingerprint ``w``; it holds the texts that have ``w`` among the rarest of theirs (the prefix of the text).  Two texts
that reach the similarity share a prefix fingerprint, so no pair of different trees needs a visit.  Inside a tree,
leaves are runs of texts ordered by set size, and every node holds the OR of its texts' token bitmaps and the range
of their set sizes.  A dual traversal starts at (root, root) and drops a pair of nodes once its size ranges, or the
largest overlap that its bitmaps allow, rule the similarity out.  What survives is compared set by set.

Scale.  Equal sets are one class, collapsed in the map task and again in the tree, so a text held by a third of all
rows is one entry per map task.  The order "rarest first" comes from counts of all fingerprints of all texts, kept in
a sketch of fixed size (``2**SKETCH_BITS`` cells, broadcast as one byte each); any order gives the same result, a
good one makes small trees.  Trees are spread over partitions by hash of ``w``; a text travels at most once to a
partition, as class, size, bitmap and its prefix there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import drop_table, spread, write_table
from . import shingles

SKETCH_BITS = 21
FAN = 8
#: Pairs of nodes looked at together; bounds the memory of a traversal.
FRONT = 1 << 19
#: Entries of trees that are looked at together, but for a larger tree.
ENTRIES = 1 << 20
SLICES = 32

_SETS = "id long, cls long, n int, toks binary, sketch binary, slice int"


def _scan(width: int, least_words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(1 << SKETCH_BITS, np.uint32)
    seen: set[int] = set()
    for b in batches:
        ids, texts = b.column(0), b.column(1).to_pylist()
        toks, n, _ = shingles.shingle_sets([t or "" for t in texts], width, least_words)
        owner = np.repeat(np.arange(len(n)), n)
        t32 = (toks >> np.uint64(32)).astype(np.uint32)
        keep = np.ones(len(t32), bool)
        keep[1:] = (t32[1:] != t32[:-1]) | (owner[1:] != owner[:-1])
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(shingles.mix(toks), dtype=np.uint64)))
        ends = np.cumsum(n)
        cls = (total[ends] - total[ends - n]).view(np.int64)
        t32 = t32[keep]
        n32 = np.bincount(owner[keep], minlength=len(n))
        cells += np.bincount(t32 & np.uint32((1 << SKETCH_BITS) - 1), minlength=1 << SKETCH_BITS).astype(np.uint32)
        rows = np.flatnonzero(n)
        at = np.cumsum(n32) - n32
        blobs = []
        for r in rows.tolist():
            c = int(cls[r])
            blobs.append(None if c in seen else t32[at[r] : at[r] + n32[r]].tobytes())
            seen.add(c)
        none = [None] * len(rows)
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(rows)), pa.array(cls[rows]), pa.array(n32[rows], pa.int32()), pa.array(blobs, pa.binary()), pa.array(none, pa.binary()), pa.array(none, pa.int32())],
            names=["id", "cls", "n", "toks", "sketch", "slice"],
        )
    parts = [zlib.compress(x.tobytes(), 1) for x in np.split(cells, SLICES)]
    none = [None] * SLICES
    yield pa.RecordBatch.from_arrays(
        [pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.int32()), pa.array(none, pa.binary()), pa.array(parts, pa.binary()), pa.array(range(SLICES), pa.int32())],
        names=["id", "cls", "n", "toks", "sketch", "slice"],
    )


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            part = np.frombuffer(zlib.decompress(x), np.uint32).astype(np.uint64)
            sums[k] = sums[k] + part if k in sums else part
    for k, x in sums.items():
        rank = np.where(x == 0, 0, np.where(x == 1, 1, 2 + np.minimum(8 * np.log2(np.maximum(x, 1)), 253))).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([rank.tobytes()], pa.binary())], names=["slice", "rank"])


def _ranks(sets: DataFrame) -> np.ndarray:
    """Rarity ranks of all sketch cells: 0 none, 1 a single fingerprint, then by the logarithm of the count."""
    rows = sets.where("slice is not null").select("slice", "sketch").repartition(SLICES // 4, "slice").mapInArrow(_add_slices, "slice int, rank binary").collect()
    return np.concatenate([np.frombuffer(r.rank, np.uint8) for r in sorted(rows)])


def _levels(n: np.ndarray) -> np.ndarray:
    """Bitmap width of a set as a power of two, between 1.4 and 2.8 bits a member, 128 at least."""
    return np.maximum(7, np.ceil(np.log2(1.4 * np.maximum(n, 1)))).astype(np.int64)


def _bitmaps(t32: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bitmaps, one after another, and the width (as power of two) of each."""
    level = _levels(n)
    bits = np.left_shift(1, level)
    start = np.cumsum(bits) - bits
    where = np.repeat(start, n) + ((t32 >> np.uint32(7)).astype(np.int64) & np.repeat(bits - 1, n))
    flat = np.zeros(int(bits.sum()), np.uint8)
    flat[where] = 1
    return np.packbits(flat, bitorder="little"), level


def _route(threshold: float, parts: int, ranks, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rank = ranks.value
    mask = np.uint32((1 << SKETCH_BITS) - 1)
    for b in batches:
        if not b.num_rows:
            continue
        cls, n = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64)
        t32 = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in b.column(2)])
        owner = np.repeat(np.arange(len(n)), n)
        r = rank[t32 & mask]
        order = np.argsort((owner.astype(np.uint64) << np.uint64(40)) | (r.astype(np.uint64) << np.uint64(32)) | t32, kind="stable")
        pos = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        probe = n - np.ceil(threshold * n - 1e-9).astype(np.int64) + 1
        index = n - np.ceil(2 * threshold / (1 + threshold) * n - 1e-9).astype(np.int64) + 1
        key, rk = t32[order], r[order]
        keep = (pos < np.repeat(probe, n)) & (rk > 1)
        key, doc, first = key[keep], owner[keep], (pos < np.repeat(index, n))[keep]
        part = (shingles.mix(key.astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % parts
        bitmap, level = _bitmaps(t32, n)
        size = np.left_shift(1, level) >> 3
        at = np.cumsum(size) - size
        by = np.argsort(part, kind="stable")
        key, doc, first, part = key[by], doc[by], first[by], part[by]
        cut = np.searchsorted(part, np.arange(parts + 1))
        out = []
        for p in np.flatnonzero(np.diff(cut)):
            k, d, f = (x[cut[p] : cut[p + 1]] for x in (key, doc, first))
            own, local = np.unique(d, return_inverse=True)
            take = np.repeat(at[own] - (np.cumsum(size[own]) - size[own]), size[own]) + np.arange(size[own].sum())
            out.append((int(p), cls[own].tobytes(), n[own].astype(np.uint32).tobytes(), bitmap[take].tobytes(), k.tobytes(), (local.astype(np.uint32) * 2 + f).astype(np.uint32 if len(own) > 32767 else np.uint16).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32()] + [pa.binary()] * 5)], names=["part", "cls", "n", "bits", "key", "doc"])


class Bitmaps:
    """Bitmaps of texts, of several widths, one after another."""

    def __init__(self, flat: np.ndarray, level: np.ndarray):
        size = np.left_shift(1, level) >> 3
        self.flat, self.level, self.start = flat, level, np.cumsum(size) - size

    def of(self, at: np.ndarray) -> np.ndarray:
        """Rows of some bitmaps of one width."""
        if not len(at):
            return np.zeros((0, 1), np.uint64)
        return self.flat[self.start[at][:, None] + np.arange((1 << int(self.level[at[0]])) >> 3)].view(np.uint64)

    def take(self, at: np.ndarray) -> Bitmaps:
        size = np.left_shift(1, self.level[at]) >> 3
        where = np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return Bitmaps(self.flat[where], self.level[at])


class Forest:
    """The signature trees of one partition, level by level; level 0 are the entries, the last level the roots."""

    def __init__(self, key: np.ndarray, doc: np.ndarray, index: np.ndarray, cls: np.ndarray, n: np.ndarray, bits: Bitmaps, threshold: float):
        self.t = threshold / (1 + threshold)
        self.ratio = threshold
        order = np.lexsort((cls[doc], n[doc], key))
        key, doc, index = key[order], doc[order], index[order]
        same = np.zeros(len(key), bool)  # a class that several map tasks sent is one entry
        same[1:] = (key[1:] == key[:-1]) & (cls[doc][1:] == cls[doc][:-1])
        key, doc, index = key[~same], doc[~same], index[~same]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.r_[start, len(key)])
        alone = np.repeat(count == 1, count)
        key, doc, index, count = key[~alone], doc[~alone], index[~alone], count[count > 1]
        self.doc, self.index, self.n, self.cls = doc, index, n, cls
        level = bits.level
        self._pages(bits)
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        tree = np.repeat(np.arange(len(count)), count)
        narrow = self._narrow(bits)
        low = high = n[doc]
        half = n - np.bitwise_count(self._half(narrow)).sum(1, dtype=np.int64)
        # a repeated bitmap has as many members without a bit of their own as at its own width
        slack = np.where(level < 8, half, n - np.bitwise_count(narrow).sum(1, dtype=np.int64))
        self.low, self.high, self.slack, self.half, self.sig, self.child = [low], [high], [slack[doc]], [half[doc]], [narrow[doc]], []
        step = 1
        while len(tree) > len(count):
            node = np.flatnonzero(np.r_[True, (tree[1:] != tree[:-1]) | (rank[1:] // FAN != rank[:-1] // FAN)])
            self.child.append(np.r_[node, len(tree)])
            self.low.append(np.minimum.reduceat(self.low[-1], node))
            self.high.append(np.maximum.reduceat(self.high[-1], node))
            self.slack.append(np.maximum.reduceat(self.slack[-1], node))
            self.half.append(np.maximum.reduceat(self.half[-1], node))
            self.sig.append(np.bitwise_or.reduceat(self.sig[-1], node, axis=0))
            tree, rank, step = tree[node], rank[node] // FAN, step + 1

    @staticmethod
    def _narrow(bits: Bitmaps, to: int = 8) -> np.ndarray:
        """Every bitmap at one width: wider ones folded by OR, narrower ones repeated."""
        level = bits.level
        out = np.zeros((len(level), (1 << to) // 64), np.uint64)
        for lv in np.unique(level):
            at = np.flatnonzero(level == lv)
            x = bits.of(at)
            if lv > to:
                out[at] = np.bitwise_or.reduce(x.reshape(len(at), -1, out.shape[1]), axis=1)
            else:
                out[at] = np.tile(x, (1, out.shape[1] // x.shape[1]))
        return out

    @staticmethod
    def _half(sig: np.ndarray) -> np.ndarray:
        """Bitmaps folded to half their width, which undoes the repetition of narrow ones."""
        return sig[:, : sig.shape[1] // 2] | sig[:, sig.shape[1] // 2 :]

    def _pages(self, bits: Bitmaps) -> None:
        """For each width the bitmaps of that width and of the next wider one, folded; sizes in a pair never differ by more."""
        level = bits.level
        self.level, self.page, self.row = level, {}, {}
        for lv in np.unique(level):
            own, wider = np.flatnonzero(level == lv), np.flatnonzero(level == lv + 1)
            rows = [bits.of(own)]
            if len(wider):
                rows.append(np.bitwise_or.reduce(bits.of(wider).reshape(len(wider), 2, -1), axis=1))
            at = np.full(len(level), -1, np.int32)
            at[own] = np.arange(len(own))
            at[wider] = len(own) + np.arange(len(wider))
            self.page[lv], self.row[lv] = np.concatenate(rows), at

    def _possible(self, depth: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of pairs of nodes, those that may hold a pair of texts that is similar enough."""
        ok = (self.high[depth][a] >= self.ratio * self.low[depth][b] - 1e-9) & (self.high[depth][b] >= self.ratio * self.low[depth][a] - 1e-9)
        at = np.flatnonzero(ok)
        a, b = a[at], b[at]
        x, y = self.sig[depth][a], self.sig[depth][b]
        # two bounds, at full and at half width: members in shared bits, and those that share a bit with others
        full = np.bitwise_count(x & y).sum(1, dtype=np.int64) + np.minimum(self.slack[depth][a], self.slack[depth][b])
        half = np.bitwise_count(self._half(x) & self._half(y)).sum(1, dtype=np.int64) + np.minimum(self.half[depth][a], self.half[depth][b])
        return at[np.minimum(full, half) >= self.t * (self.low[depth][a] + self.low[depth][b]) - 1e-9]

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of entries that pass the bound of their own bitmaps, as pairs of documents."""
        a, b = self.doc[a], self.doc[b]
        need = self.t * (self.n[a] + self.n[b]) - 1e-9
        lv = np.minimum(self.level[a], self.level[b])
        out = []
        for v in np.unique(lv):
            m = np.flatnonzero(lv == v)
            x, y = self.page[v][self.row[v][a[m]]], self.page[v][self.row[v][b[m]]]
            only_x = np.bitwise_count(x & ~y).sum(1, dtype=np.int64)
            only_y = np.bitwise_count(y & ~x).sum(1, dtype=np.int64)
            good = m[np.minimum(self.n[a[m]] - only_x, self.n[b[m]] - only_y) >= need[m]]
            out.append(a[good].astype(np.uint64) << np.uint64(32) | b[good].astype(np.uint64))
        return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)

    def candidates(self) -> Iterator[np.ndarray]:
        """Dual traversal from all pairs (root, root), deepest fronts first."""
        top = len(self.child)
        roots = np.arange(len(self.low[top]))
        stack = [(top, roots[i : i + FRONT], roots[i : i + FRONT]) for i in range(0, len(roots), FRONT)]
        while stack:
            depth, a, b = stack.pop()
            if depth == 0:
                at = np.flatnonzero((a != b) & self.index[a])
                a, b = a[at], b[at]
                at = np.flatnonzero(self.n[self.doc[a]] >= self.ratio * self.n[self.doc[b]] - 1e-9)
                if len(at):
                    yield self._pairs(a[at], b[at])
                continue
            at = self._possible(depth, a, b)
            a, b = a[at], b[at]
            child = self.child[depth - 1]
            na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
            total = np.cumsum(na * nb)
            at = 0
            while at < len(a):
                end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + FRONT, "right")))
                m = (na * nb)[at:end]
                pair = np.repeat(np.arange(at, end), m)
                k = np.arange(len(pair)) - np.repeat(np.cumsum(m) - m, m)
                x, y = child[a[pair]] + k // nb[pair], child[b[pair]] + k % nb[pair]
                ok = x <= y
                stack.append((depth - 1, x[ok], y[ok]))
                at = end


def _traverse(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cls, n, bits, key, doc = [], [], [], [], []
    have = 0
    for b in batches:
        for c, m, x, k, d in zip(*(b.column(i).to_pylist() for i in range(1, 6))):
            c = np.frombuffer(c, np.int64)
            d = np.frombuffer(d, np.uint32 if len(c) > 32767 else np.uint16).astype(np.int64)
            cls.append(c)
            n.append(np.frombuffer(m, np.uint32))
            bits.append(np.frombuffer(x, np.uint8))
            key.append(np.frombuffer(k, np.uint32))
            doc.append(d + 2 * have)
            have += len(c)
    if not have:
        return
    c, m = np.concatenate(cls), np.concatenate(n).astype(np.int64)
    maps = Bitmaps(np.concatenate(bits), _levels(m))
    k, d = np.concatenate(key), np.concatenate(doc)
    del cls, n, bits, key, doc
    # trees, some at a time, so that the memory of a forest does not grow with the task
    order = np.argsort(k)
    k, d = k[order], d[order]
    at = 0
    while at < len(k):
        end = len(k) if len(k) - at <= ENTRIES else int(np.searchsorted(k, k[at + ENTRIES], "left"))
        if end <= at:  # one tree that is larger
            end = int(np.searchsorted(k, k[at], "right"))
        own, local = np.unique(d[at:end] >> 1, return_inverse=True)
        forest = Forest(k[at:end], local, (d[at:end] & 1).astype(bool), c[own], m[own], maps.take(own), threshold)
        found: list[np.ndarray] = []
        for x in forest.candidates():
            found.append(x)
            if sum(map(len, found)) > 4 * FRONT:
                found = [np.unique(np.concatenate(found))]
        if found:
            x = np.unique(np.concatenate(found))
            a, b = c[own[(x >> np.uint64(32)).astype(np.int64)]], c[own[(x & np.uint64(0xFFFFFFFF)).astype(np.int64)]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["cls_a", "cls_b"])
        at = end


def _verify(threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        shared, smaller = [], []
        for x, y in zip(b.column(2), b.column(3)):
            x, y = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
            both = np.concatenate((x, y))
            both.sort()
            shared.append(int((both[1:] == both[:-1]).sum()))
            smaller.append(len(both))
        s, total = np.array(shared), np.array(smaller)
        sim = s / np.maximum(total - s, 1)
        ok = np.flatnonzero(s >= threshold * (total - s) - 1e-9)
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ok)), b.column(1).take(pa.array(ok)), pa.array(sim[ok])], names=["cls_a", "cls_b", "similarity"])


def near_duplicates(texts: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, width: int = 5, least_words: int = 0) -> tuple[DataFrame, DataFrame]:
    """Classes of equal fingerprint sets and links between similar classes.

    Returns ``members(id, cls)``, one row for each text with at least ``max(width, least_words)`` words, and
    ``links(cls_a, cls_b, similarity)`` with ``cls_a < cls_b`` and similarity (shared fingerprints by all) of at
    least ``threshold``.  Null, empty and shorter texts are in neither; repeated rows share a class; an empty table
    gives empty results; other columns are ignored.
    """
    spark = texts.sparkSession
    rows = texts.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and length(text) > 0")
    sets = write_table(spread(rows).mapInArrow(lambda it: _scan(width, least_words, it), _SETS), "sets", "uncompressed")
    found = sets.where("slice is null")
    texts_ = found.where("toks is not null")
    ranks = spark.sparkContext.broadcast(_ranks(sets))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), texts_.count() // 50_000)
    routed = texts_.select("cls", "n", "toks").mapInArrow(lambda it: _route(threshold, parts, ranks, it), "part int, cls binary, n binary, bits binary, key binary, doc binary")
    pairs = routed.repartitionById(parts, F.col("part")).mapInArrow(lambda it: _traverse(threshold, it), "cls_a long, cls_b long").distinct()
    pairs = write_table(pairs, "pairs")
    wanted = write_table(pairs.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct(), "wanted")
    one = texts_.select("cls", "toks").join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("toks").alias("toks"))
    one = write_table(one, "one", "uncompressed")
    both = pairs.join(one.select(F.col("cls").alias("cls_a"), F.col("toks").alias("x")), "cls_a").join(one.select(F.col("cls").alias("cls_b"), F.col("toks").alias("y")), "cls_b")
    links = write_table(both.select("cls_a", "cls_b", "x", "y").mapInArrow(lambda it: _verify(threshold, it), "cls_a long, cls_b long, similarity double"), "links")
    members = write_table(found.select("id", "cls"), "members")
    drop_table(sets, pairs, wanted, one)
    return members, links


def expand(members: DataFrame, links: DataFrame) -> DataFrame:
    """All pairs ``(id_a, id_b)``, ``id_a < id_b``, of rows in one class or in linked classes."""
    a, b = members.select(F.col("id").alias("x"), F.col("cls").alias("cls_a")), members.select(F.col("id").alias("y"), F.col("cls").alias("cls_b"))
    across = links.select("cls_a", "cls_b").join(a, "cls_a").join(b, "cls_b").select("x", "y")
    several = members.groupBy("cls").count().where("count > 1").select("cls")
    inside = members.join(several, "cls", "left_semi")
    within = inside.select(F.col("id").alias("x"), "cls").join(inside.select(F.col("id").alias("y"), "cls"), "cls").where("x < y").select("x", "y")
    return across.unionByName(within).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
