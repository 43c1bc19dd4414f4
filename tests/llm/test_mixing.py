import random

import numpy as np
import pytest

from scriptorium.llm import mixing as M

_DOCS = "doc_id long, text string, source string, lang string, kind string, repeats int"


def docs(spark, sizes):
    rng = random.Random(4)
    words = {s: [f"{s}{k}" for k in range(40)] for s in sizes}
    rows = []
    for s, n in sizes.items():
        rows += [(len(rows) + k, " ".join(rng.choice(words[s]) for _ in range(rng.randint(5, 60))), s, "fr", "k", 0) for k in range(n)]
    return rows, words, rng


def test_shares_are_reached(spark):
    rows, words, rng = docs(spark, {"a": 400, "b": 150, "c": 40, "other": 30})
    truth = {}
    for k in range(60):
        s = rng.choice("ab")
        truth[10_000 + k] = s
        rows.append((10_000 + k, " ".join(rng.choice(words[s]) for _ in range(40)), None, "fr", "k", 0))
    rows += [(20_000, None, "a", None, None, 0), (20_001, "", "b", None, None, 0)]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("c", 0.2, 3), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    used, report = M.mix(spark.createDataFrame(rows, _DOCS), targets)
    got, caps = used.collect(), {"a": 1, "b": 2, "c": 3}
    assert len({r.id for r in got}) == len(got) and all(1 <= r.repeats <= caps[r.source] for r in got)
    assert not any(r.id >= 20_000 for r in got) and all(r.source in caps for r in got)
    for r in report.collect():
        assert abs(r.actual_share - {"a": 0.5, "b": 0.3, "c": 0.2}[r.source]) < 0.02, r
    right = [truth[r.id] == r.source for r in got if r.predicted]
    assert right and sum(right) / len(right) > 0.9


def test_scarce_and_absent_sources(spark):
    rows, _, _ = docs(spark, {"a": 200, "b": 2})
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 2), ("none", 0.1, 5)], "source string, target_share double, max_repeats int")
    used, report = M.mix(spark.createDataFrame(rows, _DOCS), targets)
    r = {x.source: x for x in report.collect()}
    assert r["none"].actual_share == 0 and r["none"].n_documents == 0
    assert r["b"].most_repeats == 2 and r["b"].n_used == 2  # used up to the cap
    assert sum(x.actual_share for x in r.values()) == pytest.approx(1)


def test_empty_tables(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    none = spark.createDataFrame([], _DOCS)
    used, report = M.mix(none, targets)
    assert used.isEmpty() and report.first().actual_share == 0
    used, report = M.mix(spark.createDataFrame([(1, "x", "a", None, None, 0)], _DOCS), targets.limit(0))
    assert used.isEmpty() and report.isEmpty()


def test_rates_are_the_least_squares():
    grains = np.array([[8, 0], [0, 8], [4, 4]])
    tokens, shares, caps = np.array([100.0, 50.0, 20.0]), np.array([0.5, 0.5]), np.array([1.0, 2.0])
    rate, want = M.fit_rates(grains, tokens, shares, caps)
    assert ((rate >= 0) & (rate <= np.array([1, 2, 1]) + 1e-9)).all()
    assert np.allclose((grains / 8 * (tokens * rate)[:, None]).sum(0), want, rtol=1e-3)


def test_grains_add_up():
    for p in ([0.5, 0.5], [0.34, 0.33, 0.33], [1.0], [0.01, 0.99]):
        assert sum(M._in_grains(np.array(p))) == M.GRAIN
    assert abs(np.array([5, 7, 3, 11])[M._fill(np.array([5, 7, 3, 11]), 14.0)].sum() - 14) <= 1
