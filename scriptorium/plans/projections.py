"""Projections, filters, sources and sinks over the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import norm
from ..functions import text as tx
from ..operators import merge
from ..sources import files
from .registry import VISIBLE, WORKS, query

FOLD = "strip_accents(lower({}))"


def _document(t):
    """Every reading as a document file: front matter and body."""
    line = lambda k: F.concat(F.lit(f"{k}: "), F.coalesce(F.to_json(F.struct(F.col(k).cast("string").alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(k).cast("string").alias("v")))) - 6), F.lit("")), F.lit("\n"))
    items = F.concat(F.lit("tags:\n"), F.array_join(F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda x: F.concat(F.lit('  - "'), F.regexp_replace(x, '"', '\\\\"'), F.lit('"\n'))), ""))
    refs = F.concat(F.lit("bible_refs: "), F.to_json(F.coalesce("bible_refs", F.array().cast("array<string>"))), F.lit("\n"))
    return t.markdown.select("md_id", F.concat(F.lit("---\n"), line("path"), line("title"), line("source"), line("year"), refs, items, F.lit("---\n\n"), F.coalesce("body", F.lit(""))).alias("text"))


@query("SELECT md_id, path, nullif(title, '') AS title, source, year, length(coalesce(body, '')) AS body_chars FROM markdown")
def src_frontmatter(t):
    d = _document(t)
    p = files.frontmatter(F.col("text"))
    rows = d.select("md_id", p["fields"].alias("f"), p["body"].alias("b"))
    get = lambda k: files.field(F.col("f"), k).alias(k)
    return rows.select("md_id", get("path"), get("title"), get("source"), files.field(F.col("f"), "year").cast("int").alias("year"), F.length("b").cast("long").alias("body_chars"))


@query("SELECT md_id, k, v FROM (SELECT md_id, unnest(tags) AS v, generate_subscripts(tags, 1) AS k FROM markdown WHERE len(tags) > 0)")
def src_frontmatter_list(t):
    d = _document(t).select("md_id", files.frontmatter(F.col("text"))["head"].alias("h"))
    return d.select("md_id", F.posexplode(files.block_list(F.concat("h", F.lit("\n")), "tags")).alias("k", "v")).select("md_id", (F.col("k") + 1).cast("long").alias("k"), "v")


@query("SELECT md_id, len(bible_refs) AS n, array_to_string(bible_refs, '|') AS refs FROM markdown WHERE len(bible_refs) > 0")
def src_frontmatter_jsonlist(t):
    d = _document(t).select("md_id", files.frontmatter(F.col("text"))["fields"].alias("f")).select("md_id", files.json_list(F.col("f"), "bible_refs").alias("r"))
    return d.where(F.size("r") > 0).select("md_id", F.size("r").cast("long").alias("n"), F.array_join("r", "|").alias("refs"))


@query("SELECT source, sermon_id, max(entry_id) AS entry_id FROM manifest GROUP BY 1, 2")
def src_manifests(t):
    m = t.manifest
    top = m.groupBy("source", "sermon_id").agg(F.max("entry_id").alias("last"))
    parts = m.join(top, ["source", "sermon_id"])
    older, newer = parts.where("entry_id < last").drop("duration"), parts.where("entry_id = last")
    return files.manifests([merge.first_of(older, ["source", "sermon_id"], [F.desc("entry_id")]), newer]).select("source", "sermon_id", "entry_id")


@query("SELECT DISTINCT regexp_replace(trim(pdf_url), '^https?://(www\\.)?', 'https://') AS url FROM manifest WHERE lower(pdf_url) LIKE '%.pdf'")
def src_url_list(t):
    return files.url_list(t.manifest, "pdf_url").select("url")


@query(f"WITH RECURSIVE {WORKS}, e AS (SELECT path AS a, original AS b FROM works WHERE original IS NOT NULL UNION SELECT path, duplicate_of FROM works WHERE duplicate_of IS NOT NULL), l AS (SELECT a, b FROM e UNION SELECT b, a FROM e), s AS (SELECT min(a) AS url FROM l), r(url) AS (SELECT url FROM s UNION SELECT b FROM r JOIN l ON l.a = r.url WHERE b IN (SELECT a FROM l)) SELECT url FROM r")
def src_crawl(t):
    w = t.works
    e = w.where("original is not null").select(F.col("path").alias("a"), F.col("original").alias("b")).unionByName(w.where("duplicate_of is not null").select(F.col("path").alias("a"), F.col("duplicate_of").alias("b")))
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pages = both.groupBy(F.col("a").alias("url")).agg(F.collect_set("b").alias("links"))
    start = pages.agg(F.min("url")).first()[0]
    return files.frontier(pages, start).select("url")


@query("SELECT url, count(DISTINCT doc_id) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'https?://[^\\s)\"''<>|]+')) AS url FROM documents) GROUP BY 1")
def src_links(t):
    rows = t.documents.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("(https?://[^\\s)\"'<>|]+)"), 1)).alias("url"))
    return rows.groupBy("url").agg(F.count_distinct("doc_id").alias("n"))


@query("SELECT source, count(*) AS n FROM documents WHERE source IN ('mevar', 'cmpp') GROUP BY 1")
def src_collection(t):
    return t.documents.where(F.col("source").isin("mevar", "cmpp")).groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT sha1(coalesce(text, '')) AS hash, count(*) AS n FROM documents GROUP BY 1")
def src_binary_hash(t):
    return t.documents.groupBy(F.sha1(F.coalesce("text", F.lit(""))).alias("hash")).agg(F.count("*").alias("n"))


@query(f"WITH {WORKS} SELECT source, path, title, date, year FROM works")
def sink_index(t):
    return t.works.select("source", "path", "title", "date", "year").orderBy("source", F.coalesce("date", F.lit("9999")), "path")


@query(f"WITH {VISIBLE}, o AS (SELECT path, min(ref_id) AS ref FROM cites WHERE ref_id IS NOT NULL AND path IS NOT NULL GROUP BY 1), n AS (SELECT path, max(ref_id) AS ref FROM cites WHERE ref_id IS NOT NULL AND path LIKE 'cmpp/%' GROUP BY 1) SELECT path, ref FROM o WHERE path NOT LIKE 'cmpp/%' AND path IN (SELECT path FROM visible) UNION ALL SELECT path, ref FROM n")
def sink_refs_upsert(t):
    c = t.cites.where("ref_id is not null and path is not null")
    old, new = c.groupBy("path").agg(F.min("ref_id").alias("ref")), c.where("path like 'cmpp/%'").groupBy("path").agg(F.max("ref_id").alias("ref"))
    scanned = c.where("path like 'cmpp/%'").select("path").distinct()
    return merge.refs_upsert(old, scanned, new, t.visible.select("path"), "path")


@query("SELECT path, min(entry_id) AS id FROM manifest WHERE path IS NOT NULL GROUP BY 1 UNION ALL SELECT path, min(md_id) FROM markdown WHERE path NOT IN (SELECT path FROM manifest WHERE path IS NOT NULL) GROUP BY 1")
def sink_insert_ignore(t):
    old = t.manifest.where("path is not null").groupBy("path").agg(F.min("entry_id").alias("id"))
    return merge.insert_ignore(old, t.markdown.where("path is not null").groupBy("path").agg(F.min("md_id").alias("id")), ["path"])


@query(f"WITH {WORKS}, o AS (SELECT path, max(title) AS title, max(location) AS location, max(file_hash) AS file_hash FROM manifest WHERE path IS NOT NULL GROUP BY 1) SELECT coalesce(o.path, w.path) AS path, CASE WHEN w.path IS NOT NULL THEN w.title ELSE o.title END AS title, CASE WHEN o.path IS NULL THEN w.location ELSE o.location END AS location, o.file_hash FROM o FULL JOIN works w ON o.path = w.path")
def sink_upsert_cols(t):
    old = t.manifest.where("path is not null").groupBy("path").agg(F.max("title").alias("title"), F.max("location").alias("location"), F.max("file_hash").alias("file_hash"))
    return merge.upsert(old, t.works.select("path", "title", "location"), ["path"], ["title"])


@query("SELECT DISTINCT path, ref_id FROM cites WHERE path IS NOT NULL AND ref_id IS NOT NULL")
def sink_relate(t):
    return merge.edges(t.cites.where("path is not null and ref_id is not null"), ["path", "ref_id"])


@query(f"WITH {WORKS}, n AS (SELECT path, max(title) AS t FROM manifest WHERE path IS NOT NULL GROUP BY 1) SELECT w.path, n.t AS manifest_title, w.title FROM works w LEFT JOIN n ON n.path = w.path")
def sink_merge_obj(t):
    old = t.works.select("path", F.create_map(F.lit("own"), F.col("title")).alias("m"))
    new = t.manifest.where("path is not null").groupBy("path").agg(F.max("title").alias("t")).select("path", F.create_map(F.lit("manifest"), F.col("t")).alias("m"))
    return merge.merge_map(old, new, ["path"], "m").select("path", F.try_element_at("m", F.lit("manifest")).alias("manifest_title"), F.try_element_at("m", F.lit("own")).alias("title"))


@query("WITH n AS (SELECT user_id, max(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY 1) SELECT user_id, max(value) AS v FROM events WHERE user_id NOT IN (SELECT user_id FROM n) GROUP BY 1 UNION ALL SELECT user_id, v FROM n")
def sink_upsert_content(t):
    old = t.events.groupBy("user_id").agg(F.max("value").alias("v"))
    return merge.upsert_content(old, t.events.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("value").alias("v")), ["user_id"])


@query("SELECT path, max(source_path) AS source_path FROM manifest GROUP BY 1 HAVING max(source_path) IS DISTINCT FROM min(source_path)")
def sink_patch_if_changed(t):
    """Paths that were entered again with another file behind them."""
    g = t.manifest.groupBy("path")
    old, new = g.agg(F.min("source_path").alias("source_path")), g.agg(F.max("source_path").alias("source_path"))
    return merge.changed(old, new, ["path"], "source_path")


@query("SELECT cite_id, CASE WHEN c.ref_id IS NULL THEN 'no reference' ELSE 'unknown document' END AS reason FROM cites c WHERE c.ref_id IS NULL OR c.path IS NULL OR c.path NOT IN (SELECT path FROM markdown WHERE path IS NOT NULL)")
def sink_quarantine(t):
    known = t.markdown.select("path", F.lit(True).alias("known")).distinct()
    _, bad = merge.quarantine(t.cites.join(known, "path", "left"), F.col("ref_id").isNotNull() & F.col("known"))
    return bad.select("cite_id", F.when(F.col("ref_id").isNull(), "no reference").otherwise("unknown document").alias("reason"))


_XML = "replace(replace(replace(coalesce({}, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
_ITEM = f"'<item><title>' || {_XML.format('title')} || '</title><link>/' || {_XML.format('path')} || '</link><pubDate>' || coalesce(date, '') || '</pubDate></item>'"


@query(f"WITH {VISIBLE}, n AS (SELECT * FROM visible WHERE source = 'mevar' ORDER BY date DESC NULLS LAST, path LIMIT 30) SELECT count(*) AS n, '<rss version=\"2.0\"><channel>' || string_agg({_ITEM}, '' ORDER BY date DESC NULLS LAST, path) || '</channel></rss>' AS feed FROM n")
def sink_rss(t):
    """The feed document of the thirty newest works: one row, its size is given by the limit."""
    newest = t.visible.where("source = 'mevar'").select("path", "title", "date").orderBy(F.col("date").desc_nulls_last(), "path").limit(30)
    safe = lambda c: F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = F.concat(F.lit("<item><title>"), safe("title"), F.lit("</title><link>/"), safe("path"), F.lit("</link><pubDate>"), F.coalesce("date", F.lit("")), F.lit("</pubDate></item>"))
    w = Window.orderBy(F.col("date").desc_nulls_last(), "path")  # thirty rows
    items = newest.select(F.row_number().over(w).alias("k"), item.alias("x")).agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("i"))
    return items.select(F.size("i").cast("long").alias("n"), F.concat(F.lit('<rss version="2.0"><channel>'), F.array_join(F.transform("i", lambda s: s["x"]), ""), F.lit("</channel></rss>")).alias("feed"))


@query(f"WITH {WORKS} SELECT a.path AS old_path, b.path AS new_path, '/' || a.path || ' /' || b.path || ' 301' AS rule FROM works a JOIN works b ON a.duplicate_of = b.path WHERE a.status IS DISTINCT FROM 'draft' AND b.status IS DISTINCT FROM 'draft'")
def sink_redirect_rules(t):
    w = t.works.where(~F.col("status").eqNullSafe("draft"))
    pairs = w.select(F.col("path").alias("old_path"), F.col("duplicate_of").alias("new_path")).join(w.select(F.col("path").alias("new_path")), "new_path")
    return pairs.select("old_path", "new_path", F.concat(F.lit("/"), "old_path", F.lit(" /"), "new_path", F.lit(" 301")).alias("rule"))


@query("SELECT file_hash AS key, size_bytes AS size FROM manifest m WHERE file_hash IS NOT NULL AND NOT EXISTS (SELECT 1 FROM manifest o WHERE o.source = 'cmpp' AND o.file_hash = m.file_hash AND o.size_bytes = m.size_bytes)")
def sink_bucket(t):
    m = t.manifest.where("file_hash is not null").select(F.col("file_hash").alias("key"), F.col("size_bytes").alias("md5"))
    remote = t.manifest.where("source = 'cmpp'").select(F.col("file_hash").alias("key"), F.col("size_bytes").alias("md5"))
    return merge.diff_upload(m, remote).select("key", F.col("md5").alias("size"))


_KIND_SQL = "CASE WHEN source = 'cmpp' THEN 'bible_study' WHEN source IN ('le-scribe', 'sermons-en') THEN 'sermon' WHEN source = 'local' THEN 'book' WHEN preacher IS NOT NULL AND location IS NOT NULL THEN 'sermon' ELSE 'article' END"


def kind():
    """Kind of a work: an ordered decision."""
    c = F.col
    return F.when(c("source") == "cmpp", "bible_study").when(c("source").isin("le-scribe", "sermons-en"), "sermon").when(c("source") == "local", "book").when(c("preacher").isNotNull() & c("location").isNotNull(), "sermon").otherwise("article")


@query(f"SELECT md_id, {_KIND_SQL} AS kind FROM markdown")
def proj_kind(t):
    return t.markdown.select("md_id", kind().alias("kind"))


@query("SELECT md_id, CASE WHEN source = 'sermons-en' THEN 'en' ELSE 'fr' END AS lang FROM markdown")
def proj_lang(t):
    return t.markdown.select("md_id", F.when(F.col("source") == "sermons-en", "en").otherwise("fr").alias("lang"))


@query("SELECT CASE WHEN source = 'sermons-en' THEN 'original' WHEN source = 'le-scribe' THEN 'translation' ELSE 'french' END AS layer, count(*) AS n FROM markdown GROUP BY 1")
def proj_layer(t):
    return t.markdown.groupBy(F.when(F.col("source") == "sermons-en", "original").when(F.col("source") == "le-scribe", "translation").otherwise("french").alias("layer")).agg(F.count("*").alias("n"))


@query("SELECT md_id, coalesce(date, year::VARCHAR, '') AS sort_date, coalesce(preacher, persons[1]) AS speaker FROM markdown")
def proj_coalesce(t):
    return t.markdown.select("md_id", F.coalesce("date", F.col("year").cast("string"), F.lit("")).alias("sort_date"), F.coalesce("preacher", F.get("persons", F.lit(0))).alias("speaker"))


@query(f"WITH k AS (SELECT md_id, tags, {_KIND_SQL} AS kind FROM markdown) SELECT md_id, CASE WHEN list_contains(tags, 'silence') THEN 'silence' WHEN list_contains(tags, 'espérance') THEN 'espérance' ELSE kind END AS category FROM k")
def proj_category(t):
    has = lambda x: F.coalesce(F.array_contains("tags", x), F.lit(False))
    return t.markdown.select("md_id", F.when(has("silence"), "silence").when(has("espérance"), "espérance").otherwise(kind()).alias("category"))


@query(f"WITH {WORKS}, m AS (SELECT path, max(location) AS location, max(date) AS date FROM manifest GROUP BY 1) SELECT w.path, CASE WHEN m.location IS NULL OR m.location = '' OR regexp_matches(m.location, '(?i)^\\s*unknown\\b') THEN w.location ELSE m.location END AS location, CASE WHEN m.date IS NULL OR m.date = '' THEN w.date ELSE m.date END AS date FROM works w LEFT JOIN m ON m.path = w.path")
def proj_merge_nonnull(t):
    m = t.manifest.groupBy("path").agg(F.max("location").alias("l"), F.max("date").alias("d"))
    good = lambda c: F.when((c != "") & ~c.rlike(r"(?i)^\s*unknown\b"), c)
    return t.works.select("path", "location", "date").join(m, "path", "left").select("path", F.coalesce(good(F.col("l")), "location").alias("location"), F.coalesce(good(F.col("d")), "date").alias("date"))


@query(f"WITH {WORKS}, m AS (SELECT path, max(title) AS title, max(duration) AS duration FROM manifest WHERE path IS NOT NULL GROUP BY 1) SELECT coalesce(w.path, m.path) AS path, coalesce(w.title, m.title) AS title, m.duration, w.lang FROM m FULL JOIN works w ON w.path = m.path")
def proj_override(t):
    m = t.manifest.where("path is not null").groupBy("path").agg(F.max("title").alias("title"), F.max("duration").alias("duration"))
    return merge.override(m, t.works.select("path", "title", "lang"), ["path"])


@query("SELECT md_id, title AS t, struct_extract(struct_pack(y := year), 'y') AS y FROM markdown WHERE year IS NOT NULL")
def proj_nested(t):
    return t.markdown.where("year is not null").select("md_id", F.col("title").alias("t"), F.struct(F.col("year").alias("y")).alias("s")).select("md_id", "t", F.col("s")["y"].alias("y"))


@query("SELECT string_agg(source, ',' ORDER BY source) AS sources FROM (SELECT DISTINCT source FROM sources)")
def proj_value(t):
    return t.sources.agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


@query("SELECT md_id, title, year FROM markdown WHERE year = 1965 AND original IS NOT NULL")
def filt_eq_null(t):
    return t.markdown.where((F.col("year") == 1965) & F.col("original").isNotNull()).select("md_id", "title", "year")


@query("SELECT md_id FROM markdown WHERE source IN ('mevar', 'local') AND path IN (SELECT path FROM cites WHERE ref_id = 1)")
def filt_in_subquery(t):
    return t.markdown.where(F.col("source").isin("mevar", "local")).join(t.cites.where("ref_id = 1").select("path").distinct(), "path", "left_semi").select("md_id")


@query("SELECT md_id FROM markdown WHERE list_has_any(bible_refs, (SELECT list(canonical) FROM bible_ref WHERE book = 'Jean' AND chapter = 8))")
def filt_array_any(t):
    refs = t.bible_ref.where("book = 'Jean' and chapter = 8").select(F.col("canonical").alias("r"))
    return t.markdown.select("md_id", F.explode("bible_refs").alias("r")).join(refs, "r", "left_semi").select("md_id").distinct()


@query("SELECT ref_id, canonical FROM bible_ref WHERE book = 'Psaumes' AND verse_start <= 20 AND coalesce(verse_end, verse_start) >= 20")
def filt_range_contains(t):
    return t.bible_ref.where("book = 'Psaumes' and verse_start <= 20 and coalesce(verse_end, verse_start) >= 20").select("ref_id", "canonical")


@query(f"WITH {VISIBLE} SELECT path FROM visible")
def filt_visible(t):
    return t.visible.select("path")


@query(f"WITH {VISIBLE} SELECT path FROM visible WHERE source = 'mevar' OR (source IN ('mevar-pdfs', 'onedrive') AND editorial_pass IS NOT NULL)")
def filt_edited(t):
    return t.visible.where("source = 'mevar' or (source in ('mevar-pdfs', 'onedrive') and editorial_pass is not null)").select("path")


@query("SELECT md_id, sermon_id FROM markdown WHERE regexp_matches(sermon_id, '^6[0-9]-[0-9]{4}')")
def filt_regex(t):
    return t.markdown.where(F.col("sermon_id").rlike("^6[0-9]-[0-9]{4}")).select("md_id", "sermon_id")


@query("SELECT event_id, event_type, value FROM events WHERE user_id = 42")
def filt_acl(t):
    return t.events.where(F.col("user_id") == F.lit(42)).select("event_id", "event_type", "value")


@query()
def filt_opening(t):
    return t.markdown.select("md_id", F.posexplode(tx.opening(F.col("body"))).alias("k", "line"))


_NORMS = {
    "norm_key_fr": (norm.key_fr, f"trim(regexp_replace(regexp_replace({FOLD.format('title')}, '\\.', '', 'g'), '\\s+', ' ', 'g'))"),
    "norm_key_en": (norm.key_en, "trim(regexp_replace(regexp_replace(lower(title), '\\.', '', 'g'), '\\s+', ' ', 'g'))"),
    "norm_token_id": (norm.token_id, f"coalesce(nullif(left(regexp_replace(regexp_replace({FOLD.format('title')}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 60), ''), 'x')"),
    "norm_title": (norm.title, f"trim(regexp_replace({FOLD.format('title')}, '[^a-z0-9]+', ' ', 'g'))"),
    "norm_slug": (norm.slug, f"regexp_replace(regexp_replace(replace(replace({FOLD.format('title')}, 'œ', 'oe'), 'æ', 'ae'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"),
    "norm_fold_print": (norm.fold_print, f"trim(regexp_replace({FOLD.format('title')}, '[ \t]+', ' ', 'g'))"),
    "norm_phrase": (norm.phrase, "trim(regexp_replace(lower(regexp_replace(regexp_replace(title, '\\]\\([^)]*\\)', ']', 'g'), '[’‘]', '''', 'g')), '\\s+', ' ', 'g'))"),
    "norm_words": (lambda c: F.array_join(norm.words(c), " "), f"trim(regexp_replace({FOLD.format('title')}, '[^a-z0-9]+', ' ', 'g'))"),
}

for _name, (_f, _sql) in _NORMS.items():
    query(f"SELECT md_id, {_sql} AS value FROM markdown WHERE title IS NOT NULL", name=_name)(lambda t, f=_f: t.markdown.where("title is not null").select("md_id", f(F.col("title")).alias("value")))


@query("SELECT ref_id, regexp_replace(strip_accents(lower(replace(replace(canonical, '-', 'to'), ',', 'and'))), '[^a-z0-9]+', '_', 'g') AS value FROM bible_ref")
def norm_ref_id(t):
    return t.bible_ref.select("ref_id", norm.ref_id(F.col("canonical")).alias("value"))


@query()
def norm_spelling_key(t):
    return t.markdown.where("preacher is not null").select("preacher", norm.spelling_key(F.col("preacher")).alias("value")).distinct()


@query()
def norm_words_accented(t):
    return t.markdown.select("md_id", F.size(norm.words_accented(F.col("body"))).alias("n"))


@query()
def norm_unmark(t):
    return t.markdown.where("body is not null").select("md_id", norm.unmark(F.col("body")).alias("value"))
