import random

import pytest

from scriptorium.llm.components import connected_groups


def brute(pairs):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a and b and a != b:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


def shapes():
    rng = random.Random(3)
    name = lambda p, k: f"{p}{k:03d}"
    path = [(name("p", k), name("p", k + 1)) for k in range(70)]
    ring = [(name("r", k), name("r", (k + 1) % 25)) for k in range(25)]
    star = [("hub", name("s", k)) for k in range(80)]
    dense = [(name("d", rng.randrange(30)), name("d", rng.randrange(30))) for _ in range(200)]
    tree = [(name("t", k), name("t", rng.randrange(k))) for k in range(1, 60)]
    dirt = [("x", "x"), ("y", None), (None, "z"), (None, None), ("hub", "s001"), ("s001", "hub"), ("é", "e"), ("\U0001f600", "ﬁ")]
    return path + ring + star + dense + tree + dirt


@pytest.mark.parametrize("rounds,core", [(0, 0), (0, 1000), (2, 0), (40, 0), (40, 1000)])
def test_groups(spark, rounds, core):
    pairs = shapes()
    random.Random(1).shuffle(pairs)
    df = spark.createDataFrame([(a, b, "clash") for a, b in pairs], "a string, b string, v string")
    got = connected_groups(df, "a", "b", rounds, core).collect()
    assert len(got) == len({r[0] for r in got})
    assert dict(map(tuple, got)) == brute(pairs)


def test_empty(spark):
    assert connected_groups(spark.createDataFrame([], "a string, b string"), "a", "b").isEmpty()
    assert connected_groups(spark.createDataFrame([("a", "a")], "a string, b string"), "a", "b").isEmpty()


def test_hot_vertices(spark, monkeypatch):
    """Hubs of which every row stays where it is: the same groups."""
    from scriptorium.llm import components as C
    from scriptorium.operators import linkage as L

    monkeypatch.setattr(C, "LEAST_HOT", 5)
    monkeypatch.setattr(L, "LEAST_HOT", 5)
    pairs = shapes() + [("hub2", f"s{k:03d}") for k in range(40, 120)] + [("hub2", "p010")]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert dict(map(tuple, connected_groups(df, "a", "b", 40, 0).collect())) == brute(pairs)
    assert dict(map(tuple, connected_groups(df, "a", "b", 0, 0).collect())) == brute(pairs)
