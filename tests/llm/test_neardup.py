import random
import re
import unicodedata

import numpy as np
import pytest

from scriptorium.llm import neardup, shingles


def sets(texts, width, least):
    out = {}
    for k, t in texts:
        w = re.findall("[a-z0-9]+", re.sub("[̀-ͯ]", "", unicodedata.normalize("NFD", t or "")).lower())
        if len(w) >= max(width, least):
            out[k] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
    return out


def brute(texts, width, least, threshold):
    s = sets(texts, width, least)
    keys = sorted(s)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(s[a] & s[b]) >= threshold * len(s[a] | s[b])}


def corpus(n, seed):
    rng = random.Random(seed)
    vocab = [f"mot{k}" if k % 3 else f"été{k}" for k in range(60)]
    out = []
    for k in range(n):
        if k and rng.random() < 0.6:
            w = (rng.choice(out)[1] or "").split()
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(vocab)
            out.append((k, " ".join(w).upper() if rng.random() < 0.2 else " ".join(w)))
        else:
            out.append((k, " ".join(rng.choice(vocab) for _ in range(rng.choice([5, 35, 60, 400])))))
    return out + [(n, None), (n + 1, ""), (n + 2, "  \n "), (n + 3, "x" * 10_000), (n + 4, out[0][1])]


@pytest.mark.parametrize("threshold,width,least", [(0.6, 3, 30), (0.8, 5, 0), (0.5, 2, 0)])
def test_all_pairs(spark, threshold, width, least):
    texts = corpus(160, int(threshold * 10))
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in texts], "id long, text string, cls string, n int")
    members, links = neardup.near_duplicates(df, "id", "text", threshold, width, least)
    got = [tuple(r) for r in neardup.expand(members, links).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(texts, width, least, threshold)
    assert {r.id for r in members.collect()} == set(sets(texts, width, least))


def test_hot_class_and_repeated_rows(spark):
    texts = [(k, "un deux trois quatre cinq six sept huit") for k in range(60)] + [(k, f"a{k} b{k} c{k} d{k} e{k} f{k}") for k in range(60, 90)]
    df = spark.createDataFrame(texts, "id long, text string").repartition(5)
    members, links = neardup.near_duplicates(df, "id", "text")
    assert links.isEmpty() and members.select("cls").distinct().count() == 31
    assert neardup.expand(members, links).count() == 60 * 59 // 2


def test_empty_table(spark):
    members, links = neardup.near_duplicates(spark.createDataFrame([], "id long, text string"), "id", "text")
    assert members.isEmpty() and links.isEmpty() and neardup.expand(members, links).isEmpty()


def test_vectorised_words_are_the_words_of_the_rule():
    texts = ["Été  l’œuvre №12", "", "a", "\ud800x y", "ａ Ǆ ﬁ", "x" * 3000 + " y"]
    _, counts = shingles.word_hashes(texts)
    want = [re.findall("[a-z0-9]+", shingles.fold(t)) for t in texts]
    assert counts.tolist() == list(map(len, want))
    flat = [w for t in want for w in t]
    hashes = shingles.word_hashes(texts)[0]
    by = {}
    for w, h in zip(flat, hashes.tolist()):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


def test_bitmap_bound_never_prunes_a_match():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 2**32, rng.integers(5, 400), dtype=np.uint64).astype(np.uint32))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 2**32, 20, dtype=np.uint64).astype(np.uint32)]))
        n = np.array([len(a), len(b)])
        bits, level = neardup._bitmaps(np.concatenate([a, b]), n)
        size = (1 << level) >> 3
        x, y = np.unpackbits(bits[: size[0]], bitorder="little"), np.unpackbits(bits[size[0] :], bitorder="little")
        m = min(len(x), len(y))
        x, y = x.reshape(-1, m).max(0), y.reshape(-1, m).max(0)
        bound = min(n[0] - (x & (1 - y)).sum(), n[1] - (y & (1 - x)).sum())
        assert len(np.intersect1d(a, b)) <= bound


@pytest.mark.parametrize("low,high", [(85, 100), (40, 60), (60, 130)])
def test_many_revisions_of_one_short_text(spark, low, high):
    """More revisions than a node holds, around the size at which the width of bitmaps changes."""
    rng = random.Random(low)
    base = [f"w{k}" for k in range(high + 2)]
    texts = []
    for k in range(70):
        w = base[: rng.randint(low, high) + 2]
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        texts.append((k, " ".join(w)))
    members, links = neardup.near_duplicates(spark.createDataFrame(texts, "id long, text string"), "id", "text", 0.6, 3, 30)
    got = [tuple(r) for r in neardup.expand(members, links).collect()]
    want = brute(texts, 3, 30, 0.6)
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 400
