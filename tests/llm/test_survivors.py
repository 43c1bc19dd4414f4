import itertools
import random
from datetime import datetime

from scriptorium.llm import survivors as S

_COLS = "md_id long, path string, source string, duplicate_of string, editorial_pass string, status string, ingested_at timestamp, title string, subtitle string, date string, location string, preacher string, summary string, tags array<string>, persons array<string>, places array<string>, bible_refs array<string>, trust int"


def table(spark, rows):
    return spark.createDataFrame(rows, _COLS)


def row(k, path, source, dup, edited, full, at=None, status=None):
    text = ["x"] * min(full, 6) + ["" if k % 2 else None] * (6 - min(full, 6))
    lists = [["x"]] * max(0, full - 6) + [[] if k % 2 else None] * (4 - max(0, full - 6))
    return (k, path, source, dup, edited, status, at, *text, *lists, 99)


def brute(rows, trust):
    groups = {}
    for r in rows:
        groups.setdefault(r[3] or r[1], []).append((r[0], sum(bool(x) for x in r[7:17]), r[4] or "", -trust.get(r[2], S.WORST_TRUST)))
    out = {}
    for g, rs in groups.items():
        top = [a for a in rs if not any(b[i] > a[i] for b in rs for i in (1, 2, 3))]
        if len(rs) > 1 and len(top) == 1 and g:
            out[g] = top[0][0]
    return out


def test_tops(spark):
    rng = random.Random(9)
    rows = [row(k, f"p{rng.randrange(30)}", rng.choice(["a", "b", "zz", None]), rng.choice([None, None, f"p{rng.randrange(30)}"]), rng.choice([None, "2024-01-01", "2025-01-01"]), rng.randrange(11)) for k in range(150)]
    rows += [row(500, None, "a", None, None, 3), row(501, None, "a", None, None, 4)]
    sources = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("n", None)], "source string, trust int")
    got = {r.group_key: r.id for r in S.tops(S.standings(table(spark, rows), sources)).collect()}
    assert got == brute(rows, {"a": 1, "b": 2})


def test_repeated_rows_have_no_top(spark):
    rows = [row(1, "p", "a", None, None, 5)] * 2
    sources = spark.createDataFrame([("a", 1)], "source string, trust int")
    assert S.tops(S.standings(table(spark, rows), sources)).isEmpty()
    assert S.tops(S.standings(table(spark, rows).limit(0), sources)).isEmpty()


def test_learned_order_of_values(spark):
    day = [datetime(2024, 1, k) for k in range(1, 9)]
    rows = [(g, v, t) for g, (a, b) in enumerate(itertools.repeat(("draft", "published"), 5)) for v, t in ((a, day[0]), (b, day[1]))]
    rows += [(9, "published", day[0]), (9, "draft", day[1])]  # against the rule once
    df = spark.createDataFrame([(str(g), v, t) for g, v, t in rows], "g string, v string, t timestamp")
    learned = S.transitions(df, "g", "v", "t")
    assert [(r.earlier, r.later, r.n, r.against) for r in learned.collect()] == [("draft", "published", 5, 1)]
    untimed = spark.createDataFrame([("x", "published", None), ("x", "draft", None), ("x", "draft", None), ("y", None, None), ("z", "draft", day[0]), ("z", "published", None)], "g string, v string, t timestamp")
    assert {r.g: r.v for r in S.latest_values(untimed, "g", "v", "t", learned).collect()} == {"x": "published", "z": "draft"}


def test_topological_order(spark):
    """Through others, and through a cycle whose weakest step is given up; values of no learned order come last."""
    steps = [("", "a", "b", 3, 0), ("", "b", "c", 3, 0), ("", "c", "d", 5, 1), ("", "x", "y", 4, 0), ("", "y", "z", 4, 0), ("", "z", "x", 1, 0), ("k", "d", "a", 9, 0)]
    learned = spark.createDataFrame(steps, "kind string, earlier string, later string, n long, against long")
    got = {(r.kind, r.v): r.level for r in S.levels(learned).collect()}
    assert got["", "a"] < got["", "b"] < got["", "c"] < got["", "d"] and got["", "x"] < got["", "y"] < got["", "z"] and got["k", "d"] < got["k", "a"]
    untimed = [("g", "a"), ("g", "d"), ("h", "z"), ("h", "x"), ("h", "x"), ("i", "q"), ("i", "a"), ("j", "q"), ("j", "q"), ("j", "p")]
    df = spark.createDataFrame([(g, v, None) for g, v in untimed], "g string, v string, t timestamp")
    assert {r.g: r.v for r in S.latest_values(df, "g", "v", "t", learned).collect()} == {"g": "d", "h": "z", "i": "a", "j": "q"}
    assert S.levels(learned.limit(0)).isEmpty()


def test_golden(spark):
    at = datetime(2024, 1, 1)
    rows = [row(1, "p", "a", None, "2024-01-01", 9, at, "draft"), row(2, "p", "b", None, None, 2, datetime(2024, 2, 1), "published")]
    sources = spark.createDataFrame([("a", 1), ("b", 2)], "source string, trust int")
    r = S.golden(table(spark, rows), sources, ["status", "title"]).first()
    assert (r.id, r.n, r.status, r.title) == (1, 2, "published", "x")


def test_golden_without_timestamps(spark):
    at = datetime(2024, 1, 1)
    rows = [r for k in range(4) for r in (row(2 * k, f"p{k}", "a", None, None, 2, at, "draft"), row(2 * k + 1, f"p{k}", "a", None, None, 2, datetime(2024, 2, 1), "published"))]
    rows += [row(20, "q", "a", None, None, 2, None, "published"), row(21, "q", "a", None, None, 2, None, "draft"), row(22, "q", "a", None, None, 2, None, "draft")]
    sources = spark.createDataFrame([("a", 1)], "source string, trust int")
    assert {r.group_key: r.status for r in S.golden(table(spark, rows), sources, ["status"]).collect()} == {**{f"p{k}": "published" for k in range(4)}, "q": "published"}
