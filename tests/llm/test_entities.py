import itertools
import random

import numpy as np

from scriptorium.llm import entities as E

_FIELDS = "id string, title string, subtitle string, day string, location string, preacher string"


def test_when():
    assert E.when("(lamp) 7.01.85")[:3] == (1985, 1, 7) and E.when("20 juillet 1972, soir")[:3] == (1972, 7, 20)
    assert E.when("1978-09")[:3] == (1978, 9, 0) and E.when("1952")[:3] == (1952, 0, 0) and E.when(None)[:3] == (0, 0, 0) and E.when("31.02.1960")[:3] == (1960, 2, 0)


def test_matching(spark):
    left = [("l1", "La lampe", "The Lamp and the Covenant — 10 août 1953", "1953-08-10", "Kadazeta", "Langart Yolande"), ("l2", "Le puits", "7 janvier 1960, matin", "1960-01-07", "Val de Run", "C. Solfig"), ("l3", "Autre", None, None, None, None), ("l4", "La nuit", "Résumé de : THE NIHGT OF THE HARVEST, soir", None, "Ste Murpi", None)]
    right = [("r1", "The Lamp and the Covenant", None, "1953-08-10", "Kaadzeta", "Yolande Langart"), ("r2", "The Well", None, "1960-01-07", "Val de Run", "Clémence Solfig"), ("r3", None, None, None, None, None), ("r4", "The Night of the Harvest", None, "1971-04-04", "Sainte-Murpi", "Anselme Bel"), ("r5", "The Lamp and the Covenant", None, "1981-02-02", "Elsewhere", "Nobody Here")]
    known = spark.createDataFrame([("l9", "r9")], "a string, b string")
    got = {(r.path_a, r.path_b): r.confidence for r in E.match(spark.createDataFrame(left, _FIELDS), spark.createDataFrame(right, _FIELDS), known).collect()}
    assert set(got) == {("l1", "r1"), ("l2", "r2"), ("l4", "r4")} and all(0.5 < c <= 1 for c in got.values())
    forced = E.match(spark.createDataFrame(left, _FIELDS), spark.createDataFrame(right, _FIELDS), spark.createDataFrame([("l3", "r3"), ("l3", "r3")], "a string, b string"))
    assert ("l3", "r3", 1.0) in [tuple(r) for r in forced.collect()]


def test_empty_sides(spark):
    none, known = spark.createDataFrame([], _FIELDS), spark.createDataFrame([], "a string, b string")
    assert E.match(none, none, known).isEmpty()


def test_large_keys_are_compared_by_what_they_share(spark):
    """Thirty summaries and thirty sermons of one year, speaker and place: every pair with a day or title in common meets."""
    rng = random.Random(6)
    said = [" ".join(rng.sample("Lamp Well River Harvest Door Night Garden Stone Tower Cloud Key Road Sheaf Anchor Lantern".split(), 3)) for _ in range(30)]
    left = [(f"l{k:02d}", "Autre", f"Résumé de : {x}", "1960", "Val de Run", "Anselme Garsel") for k, x in enumerate(said)]
    right = [(f"r{k:02d}", x, None, "1960", "Val de Run", "Anselme Garsel") for k, x in enumerate(said)]
    rows = spark.createDataFrame([(i, s, *r) for s, side in ((0, left), (1, right)) for i, *r in side], "id string, side int, title string, subtitle string, day string, location string, preacher string")
    lexicon = spark.sparkContext.broadcast({})
    keyed = rows.mapInArrow(E._keyed(lexicon), f"{E._SCHEMA}, key string")
    found = [{(r.a, r.b): r.e for r in E._blocks(keyed, lexicon, 10, tile).collect()} for tile in (256, 4)]
    assert found[0] == found[1] and all((f"l{k:02d}", f"r{k:02d}") in found[1] for k in range(30))


def best_total(edges):
    a = sorted({x for x, _, _ in edges})
    by = {(x, y): e for x, y, e in edges}
    b = sorted({y for _, y, _ in edges}) + [None] * len(a)
    return max(sum(by.get(p, 0) for p in zip(a, q)) for q in itertools.permutations(b, len(a)))


def test_assignment_is_the_largest(spark):
    rng = random.Random(5)
    edges = []
    for g in range(6):
        edges += [(f"a{g}{i}", f"b{g}{j}", rng.randint(1, 9) + rng.random()) for i in range(3) for j in range(3) if rng.random() < 0.8]
    got = E.one_to_one(spark.createDataFrame(edges, "a string, b string, e double")).collect()
    assert len({r.a for r in got}) == len(got) == len({r.b for r in got})
    want = sum(best_total([e for e in edges if e[0][1] == str(g)]) for g in range(6) if any(e[0][1] == str(g) for e in edges))
    assert abs(sum(r.e for r in got) - want) < 1e-9


def test_hungarian():
    rng = np.random.default_rng(2)
    for n in (1, 2, 4, 5):
        c = rng.random((n, n))
        to = E._hungarian(c)
        assert sorted(to) == list(range(n))
        assert abs(sum(c[i, to[i]] for i in range(n)) - min(sum(c[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n)))) < 1e-9


def test_windows_reach_over_partitions(spark):
    left = [(f"l{k:03d}", None, f"Title{k} Word{k} — 1 mai 1960", "1960-05-01", f"Place{k}", None) for k in range(120)]
    right = [(f"r{k:03d}", f"Title{k} Word{k}", None, "1960-05-01", f"Place{k}", None) for k in range(120)]
    got = E.match(spark.createDataFrame(left, _FIELDS).repartition(7), spark.createDataFrame(right, _FIELDS).repartition(7), spark.createDataFrame([], "a string, b string")).collect()
    assert {(r.path_a[1:], r.path_b[1:]) for r in got} == {(f"{k:03d}", f"{k:03d}") for k in range(120)}


def test_keys_of_many_records(spark):
    """Pairs that meet only under a speaker and month which many records of both sides share."""
    left = [(f"l{k:03d}", None, f"a{k:02d}xyzw golden h{k:02d}arbour amber", "1960-05", None, "Anselme Bel") for k in range(40)]
    right = [(f"r{k:03d}", f"z{k:02d}xyzw golden h{k:02d}arbour zmber", None, "1960-05", None, "Anselme Bel") for k in range(40)]
    got = E.match(spark.createDataFrame(left, _FIELDS), spark.createDataFrame(right, _FIELDS), spark.createDataFrame([], "a string, b string")).collect()
    assert {(r.path_a[1:], r.path_b[1:]) for r in got} == {(f"{k:03d}", f"{k:03d}") for k in range(40)}


def test_large_components_are_assigned_exactly(spark):
    edges = [(f"a{g}{i}", f"b{g}{j}", e) for g in range(600) for i, j, e in (("x", "x", 5.1), ("x", "y", 5.0), ("y", "x", 5.0))]
    edges += [(f"a{g}y", f"b{g + 1}y", 0.1) for g in range(599)]
    got = E.one_to_one(spark.createDataFrame(edges, "a string, b string, e double")).collect()
    assert len({r.a for r in got}) == len(got) == len({r.b for r in got}) == 1200
    assert abs(sum(r.e for r in got) - 6000) < 1e-6


def test_sparse_matching():
    rng = random.Random(4)
    for _ in range(60):
        w = [{j: rng.random() * 9 for j in range(5) if rng.random() < 0.6} for _ in range(5)]
        to = E._sparse(w, 5)
        used = [j for j in to if j >= 0]
        assert len(used) == len(set(used))
        assert abs(sum(w[i][j] for i, j in enumerate(to) if j >= 0) - max(sum(w[i].get(p[i], 0) for i in range(5)) for p in itertools.permutations(range(5)))) < 1e-9
