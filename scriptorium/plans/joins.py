"""Joins, linkage, similarity, citations, text and ranking queries over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import align, norm, refs, similarity
from ..functions import text as tx
from ..operators import linkage, search
from ..shared import shared_dir, spread, write_table
from .registry import WORKS, query


@query(f"WITH {WORKS}, m AS (SELECT path, max(file_hash) AS file_hash, max(size_bytes) AS size_bytes FROM manifest WHERE path IS NOT NULL GROUP BY 1) SELECT w.path, w.title, m.file_hash, m.size_bytes FROM works w LEFT JOIN m ON m.path = w.path")
def join_doc_manifest(t):
    m = t.manifest.where("path is not null").groupBy("path").agg(F.max("file_hash").alias("file_hash"), F.max("size_bytes").alias("size_bytes"))
    return t.works.select("path", "title").join(m, "path", "left")


@query("SELECT path, string_agg(r.canonical, '|' ORDER BY c.pos NULLS FIRST, c.cite_id) AS refs FROM cites c JOIN bible_ref r USING (ref_id) WHERE path IS NOT NULL GROUP BY 1")
def join_post_tags(t):
    e = t.cites.where("path is not null").join(t.bible_ref.select("ref_id", "canonical"), "ref_id")
    item = F.struct(F.coalesce("pos", F.lit(-1)).alias("p"), "cite_id", "canonical")
    return e.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda s: s["canonical"]), "|").alias("refs"))


_BOOKS = ", ".join(f"({k}, '{a}')" for k, a in enumerate(refs.BOOKS_FR, 1))


@query(f"SELECT r.ref_id, b.k AS canon_order FROM bible_ref r JOIN (VALUES {_BOOKS}) b(k, name) ON b.name = r.book")
def join_book_lookup(t):
    return t.bible_ref.select("ref_id", refs.book_number(F.col("book")).alias("canon_order")).where("canon_order is not null")


@query("SELECT e.cite_id, r.book, r.chapter FROM cites e JOIN bible_ref r USING (ref_id)")
def join_fk_deref(t):
    return t.cites.select("cite_id", "ref_id").join(t.bible_ref.select("ref_id", "book", "chapter"), "ref_id").drop("ref_id")


@query("SELECT DISTINCT 'mentions' AS edge, path, trim(x) AS name FROM (SELECT path, unnest(persons) AS x FROM markdown) WHERE trim(x) <> '' UNION SELECT DISTINCT 'mentions_place', path, trim(x) FROM (SELECT path, unnest(places) AS x FROM markdown) WHERE trim(x) <> '' UNION SELECT DISTINCT 'has_theme', path, trim(x) FROM (SELECT path, unnest(themes) AS x FROM markdown) WHERE trim(x) <> '' UNION SELECT DISTINCT 'has_tag', path, trim(x) FROM (SELECT path, unnest(tags) AS x FROM markdown) WHERE trim(x) <> '' UNION SELECT DISTINCT 'by', path, trim(preacher) FROM markdown WHERE trim(preacher) <> ''")
def join_entity_edges(t):
    # one scan: all edge kinds of a row side by side
    kinds = {"mentions": F.col("persons"), "mentions_place": F.col("places"), "has_theme": F.col("themes"), "has_tag": F.col("tags"), "by": F.array("preacher")}
    none = F.array().cast("array<string>")
    named = lambda k: lambda x: F.struct(F.lit(k).alias("edge"), F.trim(x).alias("name"))
    cells = F.concat(*[F.transform(F.coalesce(c, none), named(k)) for k, c in kinds.items()])
    return t.markdown.select("path", F.explode(cells).alias("e")).select("e.edge", "path", "e.name").where("name <> ''").distinct()


@query("SELECT r.ref_id, v.v::INTEGER AS verse FROM bible_ref r, range(1, 200) v(v) WHERE r.verse_start IS NOT NULL AND v.v BETWEEN r.verse_start AND coalesce(r.verse_end, r.verse_start)")
def join_verse_range(t):
    return t.bible_ref.where("verse_start is not null").select("ref_id", F.explode(F.sequence("verse_start", F.greatest("verse_start", F.coalesce("verse_end", "verse_start")))).alias("verse"))


@query("WITH v AS (SELECT r.ref_id, r.book, r.chapter, v.v FROM bible_ref r, range(1, 200) v(v) WHERE v.v BETWEEN r.verse_start AND coalesce(r.verse_end, r.verse_start)) SELECT a.ref_id, string_agg(DISTINCT b.ref_id::VARCHAR, ',' ORDER BY b.ref_id::VARCHAR) AS touching FROM v a JOIN v b USING (book, chapter, v) WHERE a.ref_id <> b.ref_id GROUP BY 1")
def join_strong_range(t):
    v = t.bible_ref.where("verse_start is not null").select("ref_id", "book", "chapter", F.explode(F.sequence("verse_start", F.greatest("verse_start", F.coalesce("verse_end", "verse_start")))).alias("v"))
    b = v.select(F.col("ref_id").alias("other"), "book", "chapter", "v")
    return v.join(b, ["book", "chapter", "v"]).where("ref_id <> other").groupBy("ref_id").agg(F.array_join(F.array_sort(F.collect_set(F.col("other").cast("string"))), ",").alias("touching"))


def _items(df, id_col, words, width):
    """Distinct fingerprint items of the texts."""
    return linkage.exploded(spread(df).select(id_col, words.alias("w")), id_col, similarity.shingles(F.col("w"), width))


@query()
def join_jaccard_best(t):
    d = t.markdown.where("body is not null").select("md_id", "source", "body")
    items = F.transform(similarity.fingerprint(F.col("body")), lambda w: F.xxhash64(w))
    of = lambda source: spread(d.where(F.col("source") == source)).select(F.col("md_id").alias("id"), items.alias("items"))
    return linkage.jaccard_best(of("mevar-pdfs"), of("mevar"), 0.5)


@query("WITH w AS (SELECT doc_id AS id, list_filter(string_split(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL), i AS (SELECT DISTINCT id, array_to_string(w[k:k+4], ' ') AS s FROM (SELECT id, w, unnest(range(1, len(w) - 3)) AS k FROM w)), n AS (SELECT id, count(*) AS n FROM i GROUP BY 1), d AS (SELECT s FROM i GROUP BY 1 HAVING count(*) BETWEEN 2 AND 20), k AS (SELECT i.* FROM i JOIN d USING (s)), p AS (SELECT a.id AS a, b.id AS b, count(*) AS shared FROM k a JOIN k b ON a.s = b.s AND a.id < b.id GROUP BY 1, 2 HAVING count(*) >= 50) SELECT a, b, shared, round(shared / x.n, 3) AS share_a, round(shared / y.n, 3) AS share_b, CASE WHEN least(round(shared / x.n, 3), round(shared / y.n, 3)) >= 0.9 THEN 'same_text' WHEN greatest(round(shared / x.n, 3), round(shared / y.n, 3)) >= 0.7 THEN 'same_sermon' WHEN greatest(round(shared / x.n, 3), round(shared / y.n, 3)) >= 0.2 THEN 'uncertain' ELSE 'none' END AS band FROM p JOIN n x ON x.id = a JOIN n y ON y.id = b JOIN documents da ON da.doc_id = a JOIN documents db ON db.doc_id = b WHERE da.source IS DISTINCT FROM db.source")
def join_shingle_pairs(t):
    """Texts of different sources that share many runs of words; copies inside one source say nothing."""
    i = write_table(_items(t.documents.where("text is not null").select("doc_id", "text"), "doc_id", norm.words(F.col("text")), 5), "items")
    of = t.documents.select(F.col("doc_id").alias("id"), "source")
    pairs = linkage.shared_pairs(i, 20, 50).join(of.select(F.col("id").alias("a"), F.col("source").alias("s_a")), "a").join(of.select(F.col("id").alias("b"), F.col("source").alias("s_b")), "b")
    pairs = pairs.where(~F.col("s_a").eqNullSafe(F.col("s_b"))).select("a", "b", "shared")
    return linkage.with_containment(pairs, i.groupBy("id").agg(F.count("*").alias("n"))).select("a", "b", "shared", "share_a", "share_b", "band")


_WORDS = "list_distinct(list_filter(string_split(regexp_replace(strip_accents(lower(body)), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> ''))"
_SUFFIX = r"[-_ ](?:livret|brochure|a4|a5|imprimable|print|booklet|v\d+)$"


@query(f"WITH {WORKS}, g AS (SELECT md_id, regexp_replace(coalesce(duplicate_of, path), '{_SUFFIX}', '') AS g, {_WORDS} AS w FROM works WHERE body IS NOT NULL), k AS (SELECT g, arg_max(md_id, (len(w), -md_id)) AS keeper, count(*) AS members FROM g WHERE g IS NOT NULL GROUP BY 1) SELECT g.md_id, k.keeper, round(len(list_intersect(g.w, o.w)) / greatest(len(g.w), 1), 3) AS share, len(list_intersect(g.w, o.w)) / greatest(len(g.w), 1) >= 0.9 AS variant FROM g JOIN k USING (g) JOIN g o ON o.md_id = k.keeper WHERE k.members > 1 AND g.md_id <> k.keeper")
def join_variant_group(t):
    """Layout variants: works of one path, suffixes of layouts apart, whose words the longest of them holds to 0.9."""
    w = F.array_distinct(norm.words(F.col("body")))
    g = write_table(t.works.where("body is not null").select("md_id", F.regexp_replace(F.coalesce("duplicate_of", "path"), _SUFFIX, "").alias("g"), w.alias("w")).where("g is not null"), "variants")
    k = g.groupBy("g").agg(F.max_by("md_id", F.struct(F.size("w"), -F.col("md_id"))).alias("keeper"), F.count("*").alias("members")).where("members > 1").drop("members")
    rows = g.join(k, "g").where("md_id <> keeper").join(g.select(F.col("md_id").alias("keeper"), F.col("w").alias("o")), "keeper")
    share = F.size(F.array_intersect("w", "o")) / F.greatest(F.size("w"), F.lit(1))
    return rows.select("md_id", "keeper", F.round(share, 3).alias("share"), (share >= 0.9).alias("variant"))


@query(f"WITH {WORKS}, m AS (SELECT entry_id AS id, path, sermon_id, title FROM manifest), p AS (SELECT path, min(md_id) AS x FROM works WHERE path IS NOT NULL GROUP BY 1), s AS (SELECT sermon_id, min(md_id) AS x FROM works WHERE sermon_id IS NOT NULL GROUP BY 1), t AS (SELECT title, min(md_id) AS x FROM works WHERE title IS NOT NULL GROUP BY 1) SELECT m.id, coalesce(p.x, s.x, t.x) AS match, CASE WHEN p.x IS NOT NULL THEN 'path' WHEN s.x IS NOT NULL THEN 'sermon_id' WHEN t.x IS NOT NULL THEN 'title' ELSE 'unique' END AS tier FROM m LEFT JOIN p USING (path) LEFT JOIN s USING (sermon_id) LEFT JOIN t USING (title)")
def join_tier_cascade(t):
    left = t.manifest.select(F.col("entry_id").alias("id"), "path", "sermon_id", "title")
    return linkage.tiers(left, t.works.select(F.col("md_id").alias("id"), "path", "sermon_id", "title"), ["path", "sermon_id", "title"])


def _day_candidates(t):
    w = t.works
    a = w.where("source = 'le-scribe' and date is not null").select(F.col("path").alias("a"), "date", F.col("preacher").alias("pa"), F.col("location").alias("la"))
    b = w.where("source = 'sermons-en' and date is not null").select(F.col("path").alias("b"), "date", F.col("preacher").alias("pb"), F.col("location").alias("lb"))
    return a.join(b, "date")


_DAY = f"WITH {WORKS}, c AS (SELECT a.path AS a, b.path AS b, coalesce(a.preacher = b.preacher, false) AS h1, coalesce(a.location = b.location, false) AS h2 FROM works a JOIN works b ON a.date = b.date WHERE a.source = 'le-scribe' AND b.source = 'sermons-en'), n AS (SELECT *, count(*) OVER w AS n0, sum(h1::INT) OVER w AS n1, sum(h2::INT) OVER w AS n2 FROM c WINDOW w AS (PARTITION BY a)), m AS (SELECT a, b, CASE WHEN n0 = 1 THEN 'only one' WHEN n1 = 1 AND h1 THEN 'preacher' WHEN n1 <> 1 AND n2 = 1 AND h2 THEN 'place' END AS rule FROM n)"


def _cascade(t):
    rules = {"only one": F.expr("true"), "preacher": F.expr("pa = pb"), "place": F.expr("la = lb")}
    return linkage.cascade(_day_candidates(t), rules)


@query(_DAY + " SELECT a, b, rule FROM m WHERE rule IS NOT NULL")
def join_day_cascade(t):
    return _cascade(t)[0]


@query(_DAY + " SELECT DISTINCT a FROM c WHERE a NOT IN (SELECT a FROM m WHERE rule IS NOT NULL)")
def join_titlepage_cascade(t):
    return _cascade(t)[1]


@query(_DAY + " SELECT a, b, rule FROM m WHERE rule IS NOT NULL AND b IN (SELECT b FROM m WHERE rule IS NOT NULL GROUP BY 1 HAVING count(*) = 1)")
def join_one_to_one_guard(t):
    return linkage.one_to_one(_cascade(t)[0])[0]


@query("SELECT md_id FROM markdown WHERE list_contains(persons, 'Anselme Garselmimi') AND year = 1965")
def join_semi_mentions(t):
    return t.markdown.where(F.array_contains("persons", "Anselme Garselmimi") & (F.col("year") == 1965)).select("md_id")


@query("WITH c AS (SELECT DISTINCT path, ref_id FROM cites WHERE path IS NOT NULL AND ref_id IS NOT NULL), w AS (SELECT min(path) AS p FROM c) SELECT b.path, count(*) AS shared FROM c a JOIN c b USING (ref_id), w WHERE a.path = w.p AND b.path <> w.p GROUP BY 1 ORDER BY shared DESC, path LIMIT 20")
def join_shared_count(t):
    c = t.cited
    one = c.agg(F.min("path").alias("p"))
    mine = c.join(one, F.col("path") == F.col("p")).select("ref_id", "p")
    return c.join(mine, "ref_id").where("path <> p").groupBy("path").agg(F.count("*").alias("shared")).orderBy(F.desc("shared"), "path").limit(20)


@query("SELECT c.path, string_agg(DISTINCT r.book, '|' ORDER BY r.book) AS books FROM cites c JOIN bible_ref r USING (ref_id) WHERE c.path IS NOT NULL GROUP BY 1")
def join_traverse_fwd(t):
    e = t.cited.join(t.bible_ref.select("ref_id", "book"), "ref_id")
    return e.groupBy("path").agg(F.array_join(F.array_sort(F.collect_set("book")), "|").alias("books"))


@query("SELECT r.canonical, count(DISTINCT m.preacher) AS preachers FROM bible_ref r JOIN cites c USING (ref_id) JOIN markdown m USING (path) WHERE m.preacher IS NOT NULL GROUP BY 1")
def join_traverse_rev(t):
    e = t.cited.join(t.bible_ref.select("ref_id", "canonical"), "ref_id").join(t.markdown.where("preacher is not null").select("path", "preacher").distinct(), "path")
    return e.groupBy("canonical").agg(F.count_distinct("preacher").alias("preachers"))


@query("WITH d AS (SELECT record_id, duplicate_of, max(share_ab) AS share FROM mevar_duplicates WHERE record_id <> duplicate_of GROUP BY 1, 2), k AS (SELECT path, max(title) AS title FROM manifest GROUP BY 1) SELECT a.title AS title_a, b.title AS title_b, share FROM d JOIN k a ON a.path = d.record_id JOIN k b ON b.path = d.duplicate_of WHERE share >= 0.95")
def join_edge_props(t):
    d = t.mevar_duplicates.where("record_id <> duplicate_of").groupBy("record_id", "duplicate_of").agg(F.max("share_ab").alias("share")).where("share >= 0.95")
    k = t.manifest.groupBy("path").agg(F.max("title").alias("title"))
    return d.join(k.select(F.col("path").alias("record_id"), F.col("title").alias("title_a")), "record_id").join(k.select(F.col("path").alias("duplicate_of"), F.col("title").alias("title_b")), "duplicate_of").select("title_a", "title_b", "share")


@query("WITH c AS (SELECT DISTINCT sha256(text) AS h, lang AS model FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL), d AS (SELECT sha256(body) AS h FROM markdown WHERE body IS NOT NULL), m AS (SELECT unnest(['fr', 'en']) AS model) SELECT m.model, count(c.h) AS hits, count(*) - count(c.h) AS misses FROM m JOIN d ON true LEFT JOIN c ON c.h = d.h AND c.model = m.model GROUP BY 1")
def join_cache(t):
    """Texts whose vector the cache has, and those it lacks, for each of two models; the key is text and model."""
    cache = t.documents.where("text is not null and lang is not null").select(F.sha2("text", 256).alias("content_hash"), F.col("lang").alias("model")).distinct().withColumn("vector", F.lit(None).cast("array<float>"))
    docs = t.markdown.where("body is not null").select(F.sha2("body", 256).alias("content_hash"))
    parts = []
    for model in ("fr", "en"):
        found, lacking = search.with_cache(docs, cache, model)
        both = found.select(F.lit(1).alias("hit")).unionByName(lacking.select(F.lit(0).alias("hit")))
        parts.append(both.agg(F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"), (F.count("*") - F.coalesce(F.sum("hit"), F.lit(0))).alias("misses")).select(F.lit(model).alias("model"), "hits", "misses"))
    return parts[0].unionByName(parts[1])


@query("SELECT DISTINCT person FROM (SELECT unnest(persons) AS person FROM markdown) WHERE person IS NOT NULL AND person NOT IN (SELECT preacher FROM documents WHERE preacher IS NOT NULL)")
def join_registry(t):
    """Persons that the registry of speakers does not have."""
    return t.markdown.select(F.explode("persons").alias("person")).where("person is not null").distinct().join(t.documents.select(F.col("preacher").alias("person")), "person", "left_anti")


@query(f"WITH {WORKS} SELECT w.path, o.title AS original_title FROM works w JOIN works o ON w.original = o.path")
def join_self_ref(t):
    w = t.works
    return w.where("original is not null").select("path", F.col("original").alias("o")).join(w.select(F.col("path").alias("o"), F.col("title").alias("original_title")), "o").drop("o")


@query(f"WITH {WORKS}, g AS (SELECT pdf_url, min(path) AS path, count(DISTINCT path) AS posts, max(year) AS year FROM manifest WHERE pdf_url IS NOT NULL GROUP BY 1) SELECT g.pdf_url, g.path, g.posts, g.year, w.title, w.status FROM g LEFT JOIN works w ON w.path = g.path")
def join_triage_posts(t):
    """Files by address with the post that offers them, where it is there."""
    g = t.manifest.where("pdf_url is not null").groupBy("pdf_url").agg(F.min("path").alias("path"), F.count_distinct("path").alias("posts"), F.max("year").alias("year"))
    return g.join(t.works.where("path is not null").select("path", "title", "status"), "path", "left").select("pdf_url", "path", "posts", "year", "title", "status")


@query(f"WITH {WORKS}, e AS (SELECT DISTINCT pdf_url, path, coalesce(duplicate_of, path) AS root FROM works WHERE pdf_url IS NOT NULL AND path IS NOT NULL), b AS (SELECT path FROM e GROUP BY 1 HAVING count(DISTINCT pdf_url) BETWEEN 1 AND 6), k AS (SELECT e.* FROM e JOIN b USING (path)) SELECT pdf_url, CASE WHEN count(DISTINCT path) = 1 THEN min(path) ELSE min(root) END AS page, CASE WHEN count(DISTINCT path) = 1 THEN 'only page' ELSE 'through duplicates' END AS how FROM k GROUP BY 1 HAVING count(DISTINCT path) = 1 OR count(DISTINCT root) = 1")
def join_page_offers(t):
    """The one page that offers a file: of pages with one to six files; of several, the one that all are copies of."""
    e = t.works.where("pdf_url is not null and path is not null").select("pdf_url", "path", F.coalesce("duplicate_of", "path").alias("root")).distinct()
    few = e.groupBy("path").agg(F.count_distinct("pdf_url").alias("n")).where("n between 1 and 6").select("path")
    g = e.join(few, "path").groupBy("pdf_url").agg(F.min("path").alias("p"), F.max("path").alias("q"), F.min("root").alias("r"), F.max("root").alias("s"))
    return g.where("p = q or r = s").select("pdf_url", F.when(F.expr("p = q"), F.col("p")).otherwise(F.col("r")).alias("page"), F.when(F.expr("p = q"), "only page").otherwise("through duplicates").alias("how"))


@query("SELECT phrase, doc_id, ((length(low) - length(replace(low, phrase, ''))) // length(phrase))::BIGINT AS n FROM (SELECT doc_id, lower(text) AS low FROM documents WHERE text IS NOT NULL), (VALUES ('la lumière'), ('le berger'), ('the harvest')) p(phrase) WHERE contains(low, phrase)")
def join_phrase_docs(t):
    phrases = ["la lumière", "le berger", "the harvest"]  # a stated set, carried along as one array
    d = t.documents.where("text is not null").select("doc_id", F.lower("text").alias("low"))
    rows = d.select("doc_id", "low", F.explode(F.array(*[F.lit(p) for p in phrases])).alias("phrase")).where(F.contains("low", F.col("phrase")))
    return rows.select("phrase", "doc_id", ((F.length("low") - F.length(F.replace("low", F.col("phrase"), F.lit("")))) / F.length("phrase")).cast("long").alias("n"))


@query(f"WITH {WORKS} SELECT a.path, coalesce(b.date, a.date) AS date FROM works a LEFT JOIN works b ON a.duplicate_of = b.path")
def join_keeper_copy(t):
    w = t.works
    b = w.select(F.col("path").alias("k"), F.col("date").alias("d"))
    return w.select("path", "date", "duplicate_of").join(b, F.col("duplicate_of") == F.col("k"), "left").select("path", F.coalesce("d", "date").alias("date"))


@query("WITH mv AS (SELECT path AS old, source || '/moved/' || sermon_id AS new FROM (SELECT path, min(source) AS source, min(sermon_id) AS sermon_id FROM markdown WHERE source = 'sermons-en' GROUP BY 1)) SELECT md_id, coalesce(a.new, original) AS original, coalesce(b.new, duplicate_of) AS duplicate_of FROM markdown LEFT JOIN mv a ON a.old = original LEFT JOIN mv b ON b.old = duplicate_of WHERE original IS NOT NULL OR duplicate_of IS NOT NULL")
def join_moved_paths(t):
    m = t.markdown.where("source = 'sermons-en'").groupBy(F.col("path").alias("old")).agg(F.min("source").alias("s"), F.min("sermon_id").alias("i"))
    moves = m.select("old", F.concat("s", F.lit("/moved/"), "i").alias("new"))
    return linkage.moved(t.markdown.where("original is not null or duplicate_of is not null").select("md_id", "original", "duplicate_of"), moves, ["original", "duplicate_of"])


@query("WITH p AS (SELECT DISTINCT least(record_id, duplicate_of) AS a, greatest(record_id, duplicate_of) AS b FROM mevar_duplicates WHERE duplicate_of IS NOT NULL AND record_id <> duplicate_of), d AS (SELECT least(path, duplicate_of) AS a, greatest(path, duplicate_of) AS b, CASE WHEN max(llm_cleaned::INT) = 1 THEN 'same' ELSE 'different' END AS verdict FROM markdown WHERE duplicate_of IS NOT NULL AND path IS NOT NULL GROUP BY 1, 2) SELECT coalesce(p.a, d.a) AS a, coalesce(p.b, d.b) AS b, coalesce(d.verdict, 'found') AS verdict FROM p FULL JOIN d ON p.a = d.a AND p.b = d.b WHERE d.verdict IS DISTINCT FROM 'different'")
def join_decisions(t):
    p = t.mevar_duplicates.where("duplicate_of is not null and record_id <> duplicate_of").select(F.least("record_id", "duplicate_of").alias("a"), F.greatest("record_id", "duplicate_of").alias("b")).distinct()
    d = t.markdown.where("duplicate_of is not null and path is not null").groupBy(F.least("path", "duplicate_of").alias("a"), F.greatest("path", "duplicate_of").alias("b")).agg(F.when(F.max(F.col("llm_cleaned").cast("int")) == 1, "same").otherwise("different").alias("verdict"))
    return linkage.decisions(p, d)[0]


@query("WITH RECURSIVE e AS (SELECT record_id AS a, duplicate_of AS b FROM mevar_duplicates WHERE record_id <> duplicate_of UNION SELECT duplicate_of, record_id FROM mevar_duplicates WHERE record_id <> duplicate_of), c(v, w) AS (SELECT a, a FROM e UNION SELECT c.v, e.b FROM c JOIN e ON c.w = e.a) SELECT v AS record, min(w) AS \"group\" FROM c GROUP BY 1")
def join_cooccur_edges(t):
    return linkage.components(t.mevar_duplicates, "record_id", "duplicate_of")


@query()
def align_diff_words(t):
    w = t.works.where("body is not null").select("md_id", "path", "duplicate_of", "body")
    pairs = w.join(w.select(F.col("path").alias("k"), F.col("body").alias("source")), F.col("duplicate_of") == F.col("k")).select(F.col("md_id").alias("id"), F.col("body").alias("text"), "source")
    return align.aligned(pairs, "words").select("id", F.md5("text").alias("hash"))


@query()
def clean_page_headers(t):
    """Copies of texts without the page headers that their sources show to be none of the text."""
    w = t.works.where("body is not null").select("md_id", "path", "duplicate_of", "body")
    d = w.join(w.select(F.col("path").alias("duplicate_of"), F.col("body").alias("source")), "duplicate_of").select(F.col("md_id").alias("id"), F.col("body").alias("text"), "source")
    return align.aligned(d, "headers").select("id", F.length("text").alias("n"))


_W4 = "list_filter(string_split(regexp_replace(strip_accents(lower({})), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: length(x) > 3)"


@query(f"WITH {WORKS} SELECT a.md_id, CASE WHEN len(list_distinct({_W4.format('a.title')})) + len(list_distinct({_W4.format('b.title')})) > 0 THEN round(2.0 * len(list_intersect(list_distinct({_W4.format('a.title')}), {_W4.format('b.title')})) / (len(list_distinct({_W4.format('a.title')})) + len(list_distinct({_W4.format('b.title')}))), 6) ELSE 0 END AS dice FROM works a JOIN works b ON a.duplicate_of = b.path WHERE a.title IS NOT NULL AND b.title IS NOT NULL")
def sim_dice_title(t):
    w = t.works.where("title is not null")
    pairs = w.select("md_id", "title", "duplicate_of").join(w.select(F.col("path").alias("k"), F.col("title").alias("other")), F.col("duplicate_of") == F.col("k"))
    return pairs.select("md_id", F.round(similarity.dice_title(F.col("title"), F.col("other")), 6).alias("dice"))


@query("SELECT a.md_id, round(len(list_intersect(a.tags, b.tags)) / len(list_distinct(list_concat(a.tags, b.tags))), 6) AS jaccard FROM markdown a JOIN markdown b ON a.path = b.path AND a.md_id < b.md_id WHERE len(a.tags) > 0 AND len(b.tags) > 0")
def sim_jaccard(t):
    m = t.markdown.where(F.size("tags") > 0).select("md_id", "path", "tags")
    o = m.select(F.col("md_id").alias("m2"), "path", F.col("tags").alias("t2"))
    return m.join(o, "path").where("md_id < m2").select("md_id", F.round(similarity.jaccard(F.col("tags"), F.col("t2")), 6).alias("jaccard"))


@query("SELECT pair_id, CASE WHEN least(share_ab, share_ba) >= 0.9 THEN 'same_text' WHEN greatest(share_ab, share_ba) >= 0.7 THEN 'same_sermon' WHEN greatest(share_ab, share_ba) >= 0.2 THEN 'uncertain' ELSE 'none' END AS band FROM mevar_duplicates WHERE share_ab IS NOT NULL AND share_ba IS NOT NULL")
def sim_containment(t):
    d = t.mevar_duplicates.where("share_ab is not null and share_ba is not null")
    return d.select("pair_id", similarity.band(F.col("share_ab"), F.col("share_ba")).alias("band"))


@query("SELECT duplicate_of, round(sum(share_ab), 6) AS total FROM mevar_duplicates WHERE duplicate_of IS NOT NULL AND record_id <> duplicate_of GROUP BY 1 HAVING sum(share_ab) >= 0.9")
def sim_download_rule(t):
    d = t.mevar_duplicates.where("duplicate_of is not null and record_id <> duplicate_of").groupBy("duplicate_of").agg(F.sum("share_ab").alias("s"))
    return d.where("s >= 0.9").select("duplicate_of", F.round("s", 6).alias("total"))


@query("SELECT a.md_id, levenshtein(strip_accents(a.preacher), strip_accents(b.preacher))::INTEGER AS edits FROM markdown a JOIN markdown b ON a.path = b.path AND a.md_id < b.md_id WHERE a.preacher IS NOT NULL AND b.preacher IS NOT NULL")
def sim_levenshtein(t):
    m = t.markdown.where("preacher is not null").select("md_id", "path", norm.unaccent(F.col("preacher")).alias("p"))
    return m.join(m.select(F.col("md_id").alias("m2"), "path", F.col("p").alias("p2")), "path").where("md_id < m2").select("md_id", F.levenshtein("p", "p2").alias("edits"))


def _copies(t):
    w = t.works.where("title is not null")
    return w.select("md_id", "title", "duplicate_of").join(w.select(F.col("path").alias("k"), F.col("title").alias("other")), F.col("duplicate_of") == F.col("k"))


@query(f"WITH {WORKS} SELECT a.md_id, len(list_filter(range(1, least(length(a.title), length(b.title)) + 1), lambda k: left(lower(replace(a.title, '’', '''')), k) = left(lower(replace(b.title, '’', '''')), k)))::INTEGER AS n FROM works a JOIN works b ON a.duplicate_of = b.path WHERE a.title IS NOT NULL AND b.title IS NOT NULL")
def sim_common_prefix(t):
    return _copies(t).select("md_id", similarity.common_prefix(F.col("title"), F.col("other")).alias("n"))


@query()
def sim_shares_stem(t):
    return _copies(t).select("md_id", similarity.shares_stem(F.col("title"), F.col("other")).alias("same"))


_LONG = "list_filter(string_split_regex(regexp_replace(lower(text), '[^a-zà-ÿ ]+', ' ', 'g'), ' +'), lambda x: length(x) >= 4)"


@query(f"SELECT doc_id, len(list_distinct({_LONG}[1:200])) AS n_first, least(200, len(list_distinct({_LONG}))) AS n_distinct FROM documents WHERE text IS NOT NULL")
def tok_fingerprint(t):
    d = spread(t.documents.where("text is not null").select("doc_id", "text"))
    return d.select("doc_id", F.size(similarity.fingerprint(F.col("text"))).cast("long").alias("n_first"), F.size(similarity.fingerprint_distinct(F.col("text"))).cast("long").alias("n_distinct"))


@query("WITH w AS (SELECT md_id, list_filter(string_split(regexp_replace(strip_accents(lower(body)), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM markdown WHERE body IS NOT NULL) SELECT md_id, count(DISTINCT array_to_string(w[k:k+4], ' ')) AS n FROM (SELECT md_id, w, unnest(range(1, len(w) - 3)) AS k FROM w) GROUP BY 1")
def tok_shingles(t):
    d = spread(t.markdown.where("body is not null").select("md_id", "body")).select("md_id", norm.words(F.col("body")).alias("w"))
    n = F.size(similarity.shingles(F.col("w"))).cast("long")
    return d.select("md_id", F.explode(F.filter(F.array(n), lambda k: k > 0)).alias("n"))  # a filter on n would make n twice


@query()
def tok_ngrams(t):
    d = spread(t.markdown.where("body is not null").select("md_id", "body"))
    return d.select("md_id", similarity.bigrams(norm.words_once(F.col("body"), 2), "|").alias("phrases"))


@query()
def tok_stems(t):
    return t.markdown.where("title is not null").select("md_id", F.array_join(similarity.stems(norm.words(F.col("title"))), " ").alias("stems"))


@query()
def tok_ocr_noise(t):
    return t.markdown.where("body is not null").select("md_id", similarity.ocr_noise(F.col("body")).alias("n"))


@query()
def extract_refs_fr(t):
    d = spread(t.markdown.where("body is not null and lang = 'fr'").select("md_id", "body")).select("md_id", F.inline(refs.extract(F.col("body"), "fr")))
    return d.select("md_id", "index", "ref")


@query()
def extract_refs_en(t):
    d = t.markdown.where("body is not null and lang = 'en'").select("md_id", F.inline(refs.extract(F.col("body"), "en")))
    return d.select("md_id", "index", "ref")


@query("SELECT cite_id, CASE WHEN raw_ref LIKE '% chapitre %' AND verse_start IS NOT NULL THEN book || ' ' || chapter || ':' || verse_start ELSE canonical END AS ref FROM cites c JOIN bible_ref r USING (ref_id) WHERE raw_ref IS NOT NULL")
def extract_refs_fr_spoken(t):
    """References as written, in any notation, read and compared with the table they point to."""
    c = t.cites.where("ref_id is not null and raw_ref is not null").select("cite_id", "ref_id", F.get(refs.extract(F.col("raw_ref")), F.lit(0))["ref"].alias("ref"))
    return c.join(t.bible_ref.select("ref_id", "canonical"), "ref_id").select("cite_id", F.coalesce("ref", F.lit("unread")).alias("ref"))


@query("SELECT ref_id, book || ' ' || chapter || coalesce(':' || verse_start || coalesce('-' || verse_end, ''), '') AS ref FROM bible_ref")
def ref_render(t):
    c = F.col
    spans = F.concat(F.lit(":"), c("verse_start").cast("string"), F.coalesce(F.concat(F.lit("-"), c("verse_end").cast("string")), F.lit("")))
    return t.bible_ref.select("ref_id", F.concat("book", F.lit(" "), c("chapter").cast("string"), F.coalesce(spans, F.lit(""))).alias("ref"))


_MAX = ", ".join(f"('{b}', {n})" for b, n in zip(refs.BOOKS_FR, refs.CHAPTERS_FR))


@query(f"SELECT ref_id, chapter <= coalesce(m.n, 0) AND coalesce(verse_end, verse_start, 1) <= 176 AS possible FROM bible_ref r LEFT JOIN (VALUES {_MAX}) m(book, n) ON m.book = r.book")
def ref_possible(t):
    top = F.create_map(*[F.lit(x) for p in zip(refs.BOOKS_FR, refs.CHAPTERS_FR) for x in p])
    return t.bible_ref.select("ref_id", ((F.col("chapter") <= F.coalesce(F.try_element_at(top, F.col("book")), F.lit(0))) & (F.coalesce("verse_end", "verse_start", F.lit(1)) <= refs.MOST_VERSES)).alias("possible"))


@query("SELECT ref_id, book, chapter, verse_start, verse_end FROM bible_ref")
def ref_parse_graph(t):
    p = refs.parse_graph(F.col("canonical"))
    return t.bible_ref.select("ref_id", *[v.alias(k) for k, v in p.items()])


@query("SELECT r.ref_id, unnest(range(r.verse_start, coalesce(r.verse_end, r.verse_start) + 1))::INTEGER AS verse FROM bible_ref r WHERE r.verse_start IS NOT NULL")
def ref_parse_site(t):
    return t.bible_ref.select("ref_id", F.explode(refs.verses_of(F.col("canonical"))).alias("verse"))


@query("SELECT ref_id, '/bible/' || regexp_replace(strip_accents(lower(book)), '[^a-z0-9]+', '-', 'g') || '/' || chapter || '/' || coalesce('#v' || verse_start, '') AS url FROM bible_ref")
def ref_url(t):
    return t.bible_ref.select("ref_id", refs.url(F.col("canonical")).alias("url"))


@query("SELECT md_id, CASE WHEN regexp_matches(sermon_id, '^\\d{2}-\\d{4}') THEN '19' || sermon_id[1:2] || CASE WHEN sermon_id[4:5] BETWEEN '01' AND '12' THEN '-' || sermon_id[4:5] || CASE WHEN sermon_id[6:7] BETWEEN '01' AND '31' THEN '-' || sermon_id[6:7] ELSE '' END ELSE '' END END AS day FROM markdown WHERE source = 'sermons-en'")
def extract_date_from_id(t):
    return t.markdown.where("source = 'sermons-en'").select("md_id", tx.date_from_id(F.col("sermon_id")).alias("day"))


@query("SELECT entry_id, nullif(regexp_extract(pdf_url, '/((19|20)\\d\\d)/', 1), '') AS year FROM manifest WHERE pdf_url IS NOT NULL")
def extract_date_from_name(t):
    return t.manifest.where("pdf_url is not null").select("entry_id", F.nullif(F.regexp_extract("pdf_url", r"/((19|20)\d\d)/", 1), F.lit("")).alias("year"))


@query("SELECT entry_id, nullif(regexp_extract(duration, '(\\d+)\\s*min', 1), '')::INTEGER AS minutes FROM manifest WHERE duration IS NOT NULL")
def extract_minutes(t):
    return t.manifest.where("duration is not null").select("entry_id", F.nullif(F.regexp_extract("duration", r"(\d+)\s*min", 1), F.lit("")).cast("int").alias("minutes"))


def _rows_only(name, f):
    query(name=name)(f)


_rows_only("extract_metadata", lambda t: t.markdown.where("body is not null").select("md_id", *[v.alias(k) for k, v in tx.metadata(F.col("body")).items()]))
_rows_only("extract_title_page", lambda t: t.markdown.where("body is not null").select("md_id", *[v.alias(k) for k, v in tx.title_page(F.col("body")).items()]))
_rows_only("extract_header_html", lambda t: t.documents.where("text is not null").select("doc_id", *[v.alias(k) for k, v in tx.title_page(tx.html_to_text(F.col("text"))).items()]))
_rows_only("extract_printed", lambda t: t.markdown.where("body is not null and location is not null").select("md_id", tx.printed(F.col("body"), F.col("location")).alias("printed")))
_rows_only("extract_signature", lambda t: t.markdown.where("body is not null and preacher is not null").select("md_id", tx.signature(F.col("body"), F.col("preacher")).alias("state")))
_rows_only("extract_part_number", lambda t: t.markdown.where("title is not null").select("md_id", tx.part_number(F.col("title")).alias("part")))
_rows_only("extract_links", lambda t: t.documents.where("text is not null").select("doc_id", F.posexplode(tx.links(F.col("text"))).alias("k", "href")))
_rows_only("txt_html_to_md", lambda t: t.documents.where("contains(text, '<a ')").select("doc_id", tx.html_to_md(F.col("text")).alias("md")))
_rows_only("txt_clean_lines", lambda t: t.markdown.where("body is not null").select("md_id", tx.clean_lines(F.col("body")).alias("text")))
_rows_only("txt_file_cards", lambda t: t.markdown.where("body is not null").select("md_id", tx.relink(tx.file_cards(F.col("body")), "mevar.example").alias("text")))
_rows_only("txt_chunk_paragraph", lambda t: t.markdown.where("body is not null").select("md_id", F.posexplode(tx.chunk_paragraph(F.col("body"), 2000)).alias("k", "chunk")))
_rows_only("txt_chunk_words", lambda t: t.markdown.where("body is not null").select("md_id", F.posexplode(tx.chunk_words(F.col("body"), 300)).alias("k", "chunk")))
_rows_only("txt_excerpt_200", lambda t: t.markdown.where("body is not null").select("md_id", tx.excerpt_chars(F.col("body")).alias("excerpt")))
_rows_only("txt_excerpt_words", lambda t: t.markdown.where("body is not null").select("md_id", tx.excerpt_words(F.col("body")).alias("excerpt")))
_rows_only("txt_french_spacing", lambda t: t.markdown.where("lang = 'fr' and body is not null").select("md_id", tx.french_spacing(F.col("body")).alias("text")))
_rows_only("txt_sentence_case", lambda t: t.markdown.where("subtitle is not null").select("md_id", tx.sentence_case(F.col("subtitle")).alias("subtitle")))
_rows_only("txt_heading_guard", lambda t: t.markdown.where("title is not null").select("md_id", tx.heading_guard(F.upper("title"), F.col("title")).alias("same")))
_rows_only("txt_heading_candidates", lambda t: t.markdown.where("body is not null").select("md_id", F.posexplode(tx.heading_candidates(F.col("body"))).alias("k", "heading")))


@query()
def txt_html_to_text(t):
    return t.documents.where("text is not null").select("doc_id", tx.html_to_text(F.col("text")).alias("text"))


@query("SELECT doc_id, regexp_replace(text, '\\.{8,}', '… ', 'g') AS text FROM documents WHERE text IS NOT NULL")
def txt_dot_leaders(t):
    return t.documents.where("text is not null").select("doc_id", tx.dot_leaders(F.col("text")).alias("text"))


@query("SELECT md_id, greatest(1, floor(len(string_split_regex(coalesce(body, ''), '[ \\t\\n\\x0B\\f\\r]+')) / 200 + 0.5))::INTEGER AS minutes FROM markdown")
def txt_reading_minutes(t):
    return t.markdown.select("md_id", tx.reading_minutes(F.col("body")).alias("minutes"))


_MONTHS = "[" + ", ".join(f"'{m}'" for m in tx.MONTHS_FR) + "]"


@query(f"SELECT md_id, CASE WHEN length(date) = 10 THEN date[9:10]::INT || ' ' || {_MONTHS}[date[6:7]::INT] || ' ' || date[1:4] WHEN length(date) = 7 THEN {_MONTHS}[date[6:7]::INT] || ' ' || date[1:4] ELSE date END AS said FROM markdown")
def txt_date_fr(t):
    return t.markdown.select("md_id", tx.date_fr(F.col("date")).alias("said"))


@query("SELECT path, '> ' || string_agg('**' || pos || '** ' || raw_ref, ' ' ORDER BY pos, raw_ref) || ' (' || path || ')' AS quote FROM cites WHERE path IS NOT NULL AND pos IS NOT NULL AND raw_ref IS NOT NULL GROUP BY 1")
def txt_blockquote(t):
    g = t.cites.where("path is not null and pos is not null and raw_ref is not null").groupBy("path").agg(F.collect_list(F.struct(F.col("pos").alias("v"), F.col("raw_ref").alias("text"))).alias("v"))
    return g.select("path", tx.blockquote(F.col("v"), F.col("path")).alias("quote"))


_TOK = "list_filter(string_split(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
_TERMS = ["lumiere", "berger", "harvest"]
_HITS = ", ".join(f"len(list_filter(w, lambda x: x = '{q}')) AS tf{k}" for k, q in enumerate(_TERMS))
_BM = f"WITH d AS (SELECT doc_id AS id, len(w) AS n, {_HITS} FROM (SELECT doc_id, {_TOK} AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) > 0), s AS (SELECT count(*) AS c, avg(n) AS a, {', '.join(f'count(*) FILTER (WHERE tf{k} > 0) AS df{k}' for k in range(3))} FROM d)"
_SCORE = " + ".join(f"ln(1 + (c - df{k} + 0.5) / (df{k} + 0.5)) * tf{k} * 2.2 / (tf{k} + 1.2 * (0.25 + 0.75 * n / a))" for k in range(3))


@query(f"{_BM} SELECT id, round({_SCORE}, 6) AS score FROM d, s WHERE tf0 + tf1 + tf2 > 0")
def fts_bm25(t):
    return search.bm25(t.documents, "doc_id", "text", _TERMS).select("id", F.round("score", 6).alias("score"))


@query(f"{_BM} SELECT id FROM d WHERE tf0 > 0 AND tf1 > 0")
def fts_match(t):
    return search.match(search.postings(t.documents.where("text is not null"), "doc_id", "text"), ["lumiere", "berger"])


@query(f"SELECT term, lang, count(DISTINCT doc_id) AS df, count(*) AS cf, min(title) AS title FROM (SELECT doc_id, lang, title, unnest({_TOK}) AS term FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2")
def sink_search_index(t):
    """Postings and documents with a filter and a title, written and read back: terms by language."""
    at = f"{shared_dir(t.spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    index = search.write_index(t.documents.where("text is not null"), at, "doc_id", "text", ["lang"], ["title"])
    p = index["postings"].join(index["documents"], "id")
    return p.groupBy("term", "lang").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"), F.min("title").alias("title"))


@query()
def fts_analyzer(t):
    rows = t.documents.where("text is not null").select(F.explode(search.tokens(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return rows.groupBy(search.stem(F.col("term"), "fr").alias("stem")).agg(F.sum("n").alias("n"))


@query()
def fts_highlight(t):
    """All documents that hold the word; letters and marks of every script are parts of words."""
    d = t.documents.where(F.col("text").rlike(search.whole_words(["berger"])))
    return d.select("doc_id", search.highlight(F.col("text"), ["lumi", "berger"]).alias("text"))


@query()
def fts_site_search(t):
    return search.site_search(t.documents, "doc_id", "text", ["lumiere", "berger"], {"lang": "fr", "source": "mevar"}).select("id", F.round("score", 6).alias("score"), "rank")


def _vectors(t):
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def _queries(t):
    return _vectors(t).where("id % 100 = 0")


@query("SELECT q.vec_id AS query, v.vec_id AS id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 5) AS score FROM embeddings q JOIN embeddings v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0 QUALIFY row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) DESC, v.vec_id) <= 10")
def vec_cosine_scan(t):
    return search.cosine_top(_vectors(t), _queries(t), 10).select("query", "id", F.round("score", 5).alias("score"))


@query()
def vec_knn_hnsw(t):
    return search.knn(_vectors(t), _queries(t), 10).select("query", "id", F.round("score", 5).alias("score"))


@query()
def vec_hybrid(t):
    text = search.bm25(t.documents, "doc_id", "text", _TERMS)
    near = search.cosine_top(_vectors(t), _vectors(t).where("id = 0"), 20).select("id", "score")
    return search.hybrid(text, near).select("id", F.round("score", 6).alias("score"))


@query()
def vec_embed(t):
    """Vectors of distinct texts from a stand-in model: shares of letters. A real model is given by the caller."""

    def model(texts):
        return [[float(x.count(c)) / max(len(x), 1) for c in "aeiourstln"] for x in texts]

    return search.embed(t.documents, "text", model).select("content_hash", F.size("vector").alias("dim"))


@query()
def db_introspect(t):
    return t.spark.createDataFrame([(c, k) for c, k in t.markdown.dtypes], "column string, type string")
