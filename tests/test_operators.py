import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import linkage, merge, quality, search, windows
from scriptorium.plans import catalogue
from scriptorium.sources import files
from scriptorium.streaming import progress


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merges(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("b", 9, "z"), ("c", 3, "q")], "k string, v int, w string")
    assert rows(merge.insert_ignore(old, new, ["k"])) == [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "q")]
    assert rows(merge.upsert(old, new, ["k"], ["v"])) == [("a", 1, "x"), ("b", 9, "y"), ("c", 3, "q")]
    assert rows(merge.upsert_content(old, new, ["k"])) == [("a", 1, "x"), ("b", 9, "z"), ("c", 3, "q")]
    assert merge.changed(old, old, ["k"], "w").isEmpty() and rows(merge.changed(old, new, ["k"], "w").select("k")) == [("b",), ("c",)]
    good, bad = merge.quarantine(spark.createDataFrame([(1,), (None,), (3,)], "v int"), F.col("v") > 2)
    assert rows(good) == [(3,)] and bad.count() == 2
    scanned = spark.createDataFrame([("b",)], "k string")
    assert rows(merge.refs_upsert(old, scanned, new.limit(0), spark.createDataFrame([("a",), ("b",)], "k string"), "k")) == [("a", 1, "x")]


def test_cascade_never_guesses(spark):
    c = spark.createDataFrame([("a", "x", True, False), ("a", "y", False, True), ("b", "x", True, True), ("b", "z", True, True), ("c", "w", None, None)], "a string, b string, p boolean, q boolean")
    got, left = linkage.cascade(c, {"only": F.expr("true"), "p": F.col("p"), "q": F.col("q")})
    assert rows(got) == [("a", "x", "p"), ("c", "w", "only")] and rows(left) == [("b",)]
    claims = spark.createDataFrame([("a", "x", False), ("b", "x", True), ("c", "y", False)], "a string, b string, d boolean")
    kept, refused = linkage.one_to_one(claims, "b", "d")
    assert rows(kept.select("a")) == [("b",), ("c",)] and rows(refused.select("a")) == [("a",)]


def test_components(spark):
    pairs = [(str(k), str(k + 1)) for k in range(30)] + [("p", "q"), ("q", "r"), ("r", "p"), ("z", "z"), ("y", None)]
    got = dict(linkage.components(spark.createDataFrame(pairs, "a string, b string")).collect())
    assert {got[str(k)] for k in range(31)} == {"0"} and {got[x] for x in "pqr"} == {"p"} and "z" not in got
    assert linkage.components(spark.createDataFrame([], "a string, b string")).isEmpty()


def test_moved_paths(spark):
    df = spark.createDataFrame([("a", ["b", "x"]), (None, None)], "p string, l array<string>")
    moves = spark.createDataFrame([("a", "A"), ("b", "B")], "old string, new string")
    assert rows(linkage.moved(df, moves, ["p", "l"])) == [("A", ["B", "x"]), (None, None)]


def test_windows(spark):
    df = spark.createDataFrame([("t", 1), ("t", 2), ("u", 3)], "t string, k int")
    assert rows(windows.slug_suffix(df, "t", ["k"]).select("unique_token")) == [("t",), ("t_2",), ("u",)]
    runs = spark.createDataFrame([([3, 5, 4, 9],), ([],)], "n array<int>")
    assert [r[0] for r in runs.select(windows.ascending_run(F.col("n"))).collect()] == [[3, 5], []]
    spans = spark.createDataFrame([([(0, "ab", "x"), (0, "abcd", "y"), (3, "de", "z"), (4, "e", "w")],)], "s array<struct<index:int,text:string,ref:string>>")
    assert [s.ref for s in spans.select(windows.nonoverlapping(F.col("s"))).first()[0]] == ["y", "w"]


def test_search(spark):
    docs = spark.createDataFrame([(1, "la lumière du soir"), (2, "le soir et le soir"), (3, None), (4, "")], "id long, t string")
    assert [r.id for r in search.bm25(docs, "id", "t", ["soir"]).orderBy(F.desc("score")).collect()] == [2, 1]
    assert rows(search.match(search.postings(docs, "id", "t"), ["soir", "lumiere"])) == [(1,)]
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [0.0, 0.0])], "id long, vector array<float>")
    assert [r.id for r in search.cosine_top(v, v.where("id = 1"), 2).orderBy("rank").collect()] == [2, 3]


def test_knn_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    q = e.where("id % 100 = 0")
    exact = {(r.query, r.id) for r in search.cosine_top(e, q, 10).collect()}
    near = {(r.query, r.id) for r in search.knn(e, q, 10).collect()}
    assert len(exact & near) / len(exact) >= 0.9


def test_quality(spark):
    df = spark.createDataFrame([(1, "2020-01-02", '{"a":1}'), (2, "2020-13", "{"), (2, None, None)], "k int, d string, j string")
    assert rows(quality.duplicates(df, ["k"])) == [(2, 2)]
    assert quality.invalid_dates(df, "d").count() == 1 and quality.invalid_json(df, "j").count() == 1
    assert quality.same(df, df).isEmpty()


def test_front_matter_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_text('---\ntitle: "Un \\"mot\\""\nyear: 1972\nbible_refs: ["Jean 1","Luc 2"]\ntags:\n  - "foi"\n  - "paix"\n---\n\nCorps\n---\nsuite')
    (tmp_path / "a" / "y.txt").write_text("no")
    d = files.walk_md(spark, str(tmp_path))
    p = files.frontmatter(F.col("text"))
    r = d.select(files.field(p["fields"], "title").alias("t"), files.field(p["fields"], "year").alias("y"), files.field(p["fields"], "none").alias("n"), files.json_list(p["fields"], "bible_refs").alias("b"), files.block_list(F.concat(p["head"], F.lit("\n")), "tags").alias("g"), p["body"].alias("body"), "size").collect()
    assert len(r) == 1
    assert (r[0].t, r[0].y, r[0].n, r[0].b, r[0].g, r[0].body) == ('Un "mot"', "1972", None, ["Jean 1", "Luc 2"], ["foi", "paix"], "Corps\n---\nsuite")
    changed = d.select(files.set_field(F.col("text"), "year", F.lit("1999")).alias("text"))
    again = changed.select(files.field(files.frontmatter(F.col("text"))["fields"], "year").alias("y"), files.drop_field(F.col("text"), "tags").alias("d")).first()
    assert again.y == "1999" and "foi" not in again.d
    added = d.select(files.set_field(F.col("text"), "lang", F.lit("fr")).alias("text")).select(files.field(files.frontmatter(F.col("text"))["fields"], "lang").alias("l")).first()
    assert added.l == "fr"


def test_other_sources(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"books":[{"nr":1,"chapters":[{"chapter":1,"verses":[{"verse":1,"text":"Au commencement"},{"verse":2,"text":"La terre"}]}]}]}')
    from scriptorium import schemas

    assert rows(files.bible_json(files.read_json(spark, str(tmp_path / "b.json"), schemas.BIBLE_JSON))) == [(1, 1, 1, "Au commencement"), (1, 1, 2, "La terre")]
    (tmp_path / "b.xml").write_text('<bible><book number="1"><chapter number="1"><verse number="1">Au  commencement</verse><verse number="2">La terre</verse></chapter></book></bible>')
    assert rows(files.bible_xml(spark, str(tmp_path / "b.xml"))) == [(1, 1, 1, "Au commencement"), (1, 1, 2, "La terre")]
    (tmp_path / "m.csv").write_text('email,name,note\na@b.c,"Un, deux","dit ""oui""\nligne"\n')
    assert files.csv(spark, str(tmp_path / "m.csv"), ["email"]).first().note == 'dit "oui"\nligne'
    with pytest.raises(ValueError):
        files.csv(spark, str(tmp_path / "m.csv"), ["labels"])
    lines = spark.createDataFrame([("# x",), ("Gen.1.1\tG2316 G0746",), ("== y",), ("Gen.1.1 G2316",), ("",)], "value string")
    assert rows(files.tagged_tsv(lines, "G")) == [("Gen", 1, 1, ["G0746", "G2316"])]
    listing = spark.createDataFrame([("d", k, v) for k, v in enumerate(["63-0112", "63-0112 Influence", "Phoenix AZ", "94 min", "[pdf](https://x/y.pdf)"])], "doc string, pos int, value string")
    assert rows(files.listing_md(listing)) == [("d", "63-0112", "Influence", "Phoenix AZ", 94, "https://x/y.pdf")]
    (tmp_path / "f.pdf").write_bytes(b"abc")
    assert files.binary_hash(spark, str(tmp_path)).first().hash == "a9993e364706816aba3e25717850c26c9cd0d89d"
    texts = files.plugin(spark.read.format("binaryFile").load(str(tmp_path / "f.pdf")), lambda b: 1 / 0 if b == b"x" else b.decode())
    assert texts.first().text == "abc"
    assert files.booklet_order(8) == [(8, 1), (2, 7), (6, 3), (4, 5)]
    rules = files.redirects(spark.createDataFrame([("/a/:slug /b/:slug 301",), ("x",)], "value string")).first()
    assert rules.pattern == "^/a/([^/]+)/?$"
    cms = '{"db":[{"data":{"posts":[{"id":"1","title":"T"}],"tags":[{"id":"t","name":"N"}],"users":[],"posts_tags":[{"post_id":"1","tag_id":"t","sort_order":0}],"posts_authors":[]}}]}'
    (tmp_path / "c.json").write_text(cms)
    tables = files.cms_export(files.read_json(spark, str(tmp_path / "c.json"), schemas.CMS))
    assert tables["posts"].first().title == "T" and tables["posts_tags"].count() == 1 and tables["users"].isEmpty()
    pages = spark.createDataFrame([("a", ["b", "x"]), ("b", ["c"]), ("c", ["a"]), ("d", [])], "url string, links array<string>")
    assert rows(files.frontier(pages, "a")) == [("a", 0), ("b", 1), ("c", 2)]


def test_stream_keeps_the_latest(spark, tmp_path):
    src = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = progress.read(spark, str(tmp_path / "in"), src.schema)
    q = progress.upsert_stream(stream, str(tmp_path / "out"), str(tmp_path / "check"), ["user_id"])
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out" / "v2"))
    assert rows(got) == rows(progress.progress(src, ["user_id"]))


def test_ranks_over_range_partitions(spark):
    df = spark.range(500).select((F.col("id") % 3).cast("string").alias("g"), F.pmod(F.xxhash64("id"), F.lit(50)).alias("x"), "id").repartition(6)
    df = df.withColumn("g", F.when(F.col("g") == "2", None).otherwise(F.col("g")))
    got = windows.ranked(df, ["g"], [F.col("x").desc(), "id"]).collect()
    for g in ("0", "1", None):
        own = sorted((r for r in got if r.g == g), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1))
        assert own == sorted(own, key=lambda r: (-r.x, r.id))


def test_cosine_in_blocks(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    q = e.where("id % 50 = 0")
    plain = lambda df: sorted((r.query, r.id, r["rank"], round(r.score, 9)) for r in df.collect())
    assert plain(search.cosine_top(e, q, 5, block=3)) == plain(search.cosine_top(e, q, 5))
    assert search.cosine_top(e, q.limit(0), 5).isEmpty()


def test_highlight_of_texts_with_accents(spark, tmp_path):
    texts = ["Le berger éclairé, BERGER!", "bergère et éberger", "l’été du berger_x", "bergeŕ", "« Berger » lumi lumière", "plain berger", None, "", "né\nberger"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def words(x):
        parts, at = [], 0
        while at < len(x):
            end = at
            while end < len(x) and (x[end] == "_" or unicodedata.category(x[end])[0] in "LMN"):
                end += 1
            end = max(end, at + 1)
            parts.append(x[at:end])
            at = end
        return parts

    want = {k: "".join(f"**{w}**" if w.lower() in ("lumi", "berger") else w for w in words(x)) for k, x in enumerate(texts) if x and "berger" in map(str.lower, words(x))}
    assert {r.doc_id: r.text for r in catalogue.QUERIES["fts_highlight"](spark, str(tmp_path)).collect()} == want
    assert set(want) == {0, 4, 5, 8}


def test_ranks_and_neighbours_of_large_groups(spark):
    from scriptorium.operators import windows

    rows = [("g", k, f"i{k:03d}") for k in range(50)] + [("h", None, "a"), ("h", 1, "b"), (None, 1, "c")]
    df = spark.createDataFrame(rows, "grp string, day int, item string").repartition(5)
    got = {r.item: (r.previous, r.next) for r in windows.prev_next(df, "grp", [F.col("day").asc_nulls_last(), F.col("item")], "item").collect()}
    assert got["i000"] == (None, "i001") and got["i049"] == ("i048", None) and got["b"] == (None, "a") and got["a"] == ("b", None) and got["c"] == (None, None)
    after = {(r.item, r.step): r.follower for r in windows.next_circular(df.where("grp is not null"), "grp", [F.col("day").asc_nulls_last(), F.col("item")], "item").collect()}
    assert after["i049", 1] == "i000" and after["i048", 2] == "i000" and after["b", 1] == "a" and ("b", 2) not in after


def test_written_index_reads_only_the_terms(spark, tmp_path):
    docs = spark.createDataFrame([(1, "La lampe, la nuit", "fr", "x"), (2, "the lamp", "en", None), (3, "", "fr", "z")], "doc_id long, text string, lang string, title string")
    index = search.write_index(docs, str(tmp_path / "index"), "doc_id", "text", ["lang"], ["title"])
    found = index["postings"].where("term = 'la'")
    assert [tuple(r) for r in found.collect()] == [("la", 1, 2)]
    assert "EqualTo(term,la)" in found._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.len for r in index["documents"].collect()} == {1: 4, 2: 2, 3: 0}


def test_most_alike_by_parts(spark):
    """As all pairs compared one by one, ties, empty and null sets included; no pair of records is written for a shared item."""
    rng = random.Random(5)
    weights = [1 / (k + 3) for k in range(900)]
    some = lambda: set(rng.choices(range(900), weights, k=rng.randint(0, 90)))
    near = lambda s: {x for x in s if rng.random() < 0.85} | set(rng.choices(range(900), k=len(s) // 6))
    right = {k: some() for k in range(500)}
    right |= {k + 1000: right[k] for k in range(40)}  # ties
    left = {k: near(right[k]) if k % 2 else some() for k in range(300)}
    df = lambda sets: spark.createDataFrame([*((k, [x * 7919 - 1000 for x in s]) for k, s in sets.items()), (5000, None)], "id long, items array<long>")
    want = {}
    for k, s in left.items():
        like, other = max(((len(s & o) / len(s | o), -i) for i, o in right.items() if s | o), default=(0, 0))
        if like >= 0.5:
            want[k] = (-other, like)
    assert len(want) > 50
    out = linkage.jaccard_best(df(left), df(right), 0.5)
    assert {r.id: (r.best, r.similarity) for r in out.collect()} == want
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert linkage.jaccard_best(df(left), df({}), 0.5).isEmpty()
