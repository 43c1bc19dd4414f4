"""Published queries over works, references, people and vectors (``q..``) and the lists of a reading site (``s..``)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import search, windows
from . import aggregates, joins, projections
from .aggregates import agg_count_all, agg_degree
from .joins import _BM, _SCORE, _TERMS, _queries, _vectors
from .registry import ORACLES, VISIBLE, WORKS, query

query(ORACLES["agg_count_all"], name="q1_totals")(agg_count_all)


@query(f"WITH {WORKS} SELECT source, count(*) AS n FROM works GROUP BY 1")
def q2_per_source(t):
    return t.works.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


@query("SELECT count(*) FILTER (WHERE summary IS NOT NULL) AS with_summary, count(*) FILTER (WHERE len(bible_refs) > 0) AS with_refs FROM markdown")
def q3_coverage(t):
    return t.markdown.agg(F.count("summary").alias("with_summary"), F.count_if(F.size("bible_refs") > 0).alias("with_refs"))


@query("SELECT ref_id, canonical, verse_start FROM bible_ref WHERE book = 'Jean' AND chapter = 8 ORDER BY verse_start NULLS FIRST, ref_id")
def q4_chapter(t):
    return t.bible_ref.where("book = 'Jean' and chapter = 8").select("ref_id", "canonical", "verse_start").orderBy(F.col("verse_start").asc_nulls_first(), "ref_id")


@query(f"SELECT * FROM ({ORACLES['agg_degree']}) ORDER BY n DESC, ref_id LIMIT 10")
def q5_most_cited(t):
    return agg_degree(t).orderBy(F.desc("n"), "ref_id").limit(10)


@query("WITH w AS (SELECT min(path) AS path FROM cites) SELECT w.path, string_agg(DISTINCT r.canonical, '|' ORDER BY r.canonical) AS refs FROM w JOIN cites c USING (path) JOIN bible_ref r USING (ref_id) GROUP BY 1")
def q6_one_work(t):
    w = t.cites.agg(F.min("path").alias("path"))
    e = t.cited.join(w, "path").join(t.bible_ref.select("ref_id", "canonical"), "ref_id")
    return e.groupBy("path").agg(F.array_join(F.array_sort(F.collect_set("canonical")), "|").alias("refs"))


query(ORACLES["join_shared_count"], name="q7_shared_refs")(joins.join_shared_count)


@query(f"WITH {WORKS} SELECT path, title, date FROM works WHERE list_contains(persons, 'Anselme Garselmimi') ORDER BY date DESC NULLS LAST, path LIMIT 20")
def q8_mentioning(t):
    return t.works.where(F.array_contains("persons", "Anselme Garselmimi")).select("path", "title", "date").orderBy(F.col("date").desc_nulls_last(), "path").limit(20)


@query(f"WITH {WORKS} SELECT path, date FROM works WHERE source = 'cmpp' AND path IN (SELECT path FROM cites JOIN bible_ref USING (ref_id) WHERE book = 'Jean' AND chapter = 8)")
def q9_citing_chapter(t):
    refs = t.bible_ref.where("book = 'Jean' and chapter = 8").select("ref_id")
    return t.works.where("source = 'cmpp'").join(t.cited.join(refs, "ref_id").select("path"), "path", "left_semi").select("path", "date")


@query("SELECT v.vec_id AS id, round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 5) AS score FROM embeddings q JOIN embeddings v ON v.vec_id <> q.vec_id WHERE q.vec_id = 0 ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) DESC, v.vec_id LIMIT 10")
def q10_nearest(t):
    return search.cosine_top(_vectors(t), _vectors(t).where("id = 0"), 10).select("id", F.round("score", 5).alias("score"))


@query("SELECT q.vec_id AS query, 10::BIGINT AS n, true AS reached FROM embeddings q WHERE q.vec_id % 100 = 0")
def q11_nearest_approximate(t):
    """Approximate neighbours of each query, and whether their recall against the exact scan is 0.9 or more over all."""
    found = search.knn(_vectors(t), _queries(t), 10)
    mean = search.recall_of(found, search.cosine_top(_vectors(t), _queries(t), 10)).agg((F.avg("recall") >= 0.9).alias("reached"))
    return found.groupBy("query").agg(F.count("*").alias("n")).crossJoin(F.broadcast(mean))  # one row on the right


@query(f"{_BM} SELECT id, round({_SCORE}, 6) AS score FROM d, s WHERE tf0 + tf1 + tf2 > 0 ORDER BY score DESC, id LIMIT 10")
def q12_ranked(t):
    return search.bm25(t.documents, "doc_id", "text", _TERMS).select("id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "id").limit(10)


@query(f"{_BM}, x AS (SELECT id, {_SCORE} AS t FROM d, s WHERE tf0 + tf1 + tf2 > 0), v AS (SELECT b.vec_id AS id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS c FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id = 0 ORDER BY c DESC, b.vec_id LIMIT 20) SELECT id, round(0.3 * coalesce(t, 0) + 0.7 * coalesce(c, 0), 5) AS score FROM x FULL JOIN v USING (id) ORDER BY 0.3 * coalesce(t, 0) + 0.7 * coalesce(c, 0) DESC, id LIMIT 10")
def q13_hybrid(t):
    near = search.cosine_top(_vectors(t), _vectors(t).where("id = 0"), 20).select("id", "score")
    return search.hybrid(search.bm25(t.documents, "doc_id", "text", _TERMS), near).select("id", F.round("score", 5).alias("score"))


@query(f"WITH {WORKS} SELECT path, date, title FROM works WHERE year = 1965")
def q14_of_year(t):
    return t.works.where("year = 1965").select("path", "date", "title").orderBy("date")


@query("SELECT year, count(*) AS n FROM markdown GROUP BY 1")
def q15_years(t):
    return t.markdown.groupBy("year").agg(F.count("*").alias("n")).orderBy("year")


@query("SELECT floor(year / 10)::INTEGER * 10 AS decade, count(*) AS n, count(DISTINCT source) AS sources FROM markdown WHERE year IS NOT NULL GROUP BY 1")
def q16_decades(t):
    return t.markdown.where("year is not null").groupBy((F.floor(F.col("year") / 10) * 10).cast("int").alias("decade")).agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))


@query(f"WITH {WORKS} SELECT preacher, count(*) AS n FROM works WHERE preacher IS NOT NULL GROUP BY 1 ORDER BY n DESC, preacher LIMIT 10")
def q17_most_published(t):
    return t.works.where("preacher is not null").groupBy("preacher").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "preacher").limit(10)


@query(f"WITH {WORKS} SELECT path, title, location FROM works WHERE preacher = 'Anselme Garselmimi' AND year = 1965")
def q18_by_preacher_in_year(t):
    return t.works.where("preacher = 'Anselme Garselmimi' and year = 1965").select("path", "title", "location")


query(ORACLES["join_self_ref"], name="q19_summary_pairs")(joins.join_self_ref)


@query("SELECT event_id, event_type FROM events WHERE user_id = 7 AND event_type = 'click'")
def q20_bookmarks(t):
    return t.events.where("user_id = 7 and event_type = 'click'").select("event_id", "event_type")


@query("SELECT event_type, max(value) AS progress FROM events WHERE user_id = 7 GROUP BY 1")
def q21_progress(t):
    return t.events.where("user_id = 7").groupBy("event_type").agg(F.max("value").alias("progress"))


@query("SELECT event_id, props FROM events WHERE user_id = 7 AND event_type = 'view' ORDER BY ts DESC, event_id LIMIT 20")
def q22_annotations(t):
    return t.events.where("user_id = 7 and event_type = 'view'").orderBy(F.desc("ts"), "event_id").limit(20).select("event_id", "props")


query(name="q23_introspection")(lambda t: t.spark.createDataFrame([(n, len(getattr(t, n).columns)) for n in ("markdown", "manifest", "cites", "documents")], "name string, columns int"))


@query("SELECT count(DISTINCT c.path) AS n FROM cites c JOIN bible_ref r USING (ref_id) WHERE r.book = 'Jean' AND r.chapter = 8 AND r.verse_start <= 12 AND coalesce(r.verse_end, r.verse_start) >= 12")
def q24_verse(t):
    r = t.bible_ref.where("book = 'Jean' and chapter = 8 and verse_start <= 12 and coalesce(verse_end, verse_start) >= 12").select("ref_id")
    return t.cited.join(r, "ref_id").agg(F.count_distinct("path").alias("n"))


_RECENT = "ORDER BY date DESC NULLS LAST, path"


@query(f"WITH {VISIBLE} SELECT path, title FROM visible WHERE source = 'mevar' {_RECENT} LIMIT 8")
def s1_home(t):
    return t.visible.where("source = 'mevar'").orderBy(F.col("date").desc_nulls_last(), "path").limit(8).select("path", "title")


@query(f"WITH {VISIBLE} SELECT source, count(*) AS n, max(date) AS newest FROM visible WHERE source <> 'mevar' GROUP BY 1")
def s2_archives(t):
    return t.visible.where("source <> 'mevar'").groupBy("source").agg(F.count("*").alias("n"), F.max("date").alias("newest"))


@query(f"WITH {VISIBLE} SELECT path, ceil(row_number() OVER ({_RECENT}) / 60.0)::INTEGER AS page FROM visible WHERE source = 'cmpp'")
def s3_archive_pages(t):
    v = t.visible.where("source = 'cmpp'").select("path", "date", F.lit("cmpp").alias("source"))
    return windows.paginate(v, [F.col("date").desc_nulls_last(), "path"], 60, ["source"]).select("path", "page")


@query(f"WITH {VISIBLE} SELECT preacher, count(*) AS n, count(*) FILTER (WHERE source = 'mevar') AS own FROM visible WHERE preacher IS NOT NULL GROUP BY 1")
def s4_authors(t):
    return t.visible.where("preacher is not null").groupBy("preacher").agg(F.count("*").alias("n"), F.count_if(F.col("source") == "mevar").alias("own"))


@query(f"WITH {VISIBLE} SELECT theme, count(*) AS n FROM (SELECT unnest(list_distinct(themes)) AS theme FROM visible) GROUP BY 1")
def s5_themes(t):
    return t.visible.select(F.explode(F.array_distinct("themes")).alias("theme")).groupBy("theme").agg(F.count("*").alias("n"))


@query(f"WITH {VISIBLE}, s AS (SELECT preacher, count(*) AS parts, max(date) AS newest FROM visible WHERE preacher IS NOT NULL AND source = 'mevar' GROUP BY 1) SELECT preacher, parts FROM s WHERE parts > 1")
def s6_series(t):
    return t.visible.where("preacher is not null and source = 'mevar'").groupBy("preacher").agg(F.count("*").alias("parts")).where("parts > 1")


@query(f"WITH {VISIBLE} SELECT path FROM visible WHERE llm_cleaned AND editorial_pass IS NOT NULL")
def s7_selection(t):
    return t.visible.where("llm_cleaned and editorial_pass is not null").select("path")


@query(f"WITH {VISIBLE}, b AS (SELECT r.book, count(DISTINCT v.path) AS n FROM visible v JOIN cites c USING (path) JOIN bible_ref r USING (ref_id) GROUP BY 1) SELECT book, n, round(n / max(n) OVER (), 6) AS shade FROM b ORDER BY n DESC, book LIMIT 7")
def s8_bible(t):
    e = t.cited.join(t.visible.select("path"), "path", "left_semi").join(t.bible_ref.select("ref_id", "book"), "ref_id")
    b = e.groupBy("book").agg(F.count_distinct("path").alias("n"))
    top = b.agg(F.max("n").alias("m"))
    return b.crossJoin(F.broadcast(top)).select("book", "n", F.round(F.col("n") / F.col("m"), 6).alias("shade")).orderBy(F.desc("n"), "book").limit(7)  # one row on the right


@query("SELECT chapter, count(DISTINCT path) AS n FROM cites JOIN bible_ref USING (ref_id) WHERE book = 'Psaumes' AND path IS NOT NULL GROUP BY 1")
def s9_book(t):
    return t.cited.join(t.bible_ref.where("book = 'Psaumes'").select("ref_id", "chapter"), "ref_id").groupBy("chapter").agg(F.count_distinct("path").alias("n"))


@query("SELECT ref_id, path FROM (SELECT ref_id, path, row_number() OVER (PARTITION BY ref_id ORDER BY path) AS r FROM (SELECT DISTINCT ref_id, path FROM cites WHERE path IS NOT NULL AND ref_id IN (SELECT ref_id FROM bible_ref WHERE book = 'Jean'))) WHERE r <= 10")
def s10_chapter(t):
    e = t.cited.join(t.bible_ref.where("book = 'Jean'").select("ref_id"), "ref_id")
    w = Window.partitionBy("ref_id").orderBy("path")
    return e.withColumn("r", F.row_number().over(w)).where("r <= 10").select("ref_id", "path")


@query("WITH e AS (SELECT DISTINCT ref_id, path FROM cites WHERE path IS NOT NULL AND ref_id IS NOT NULL), b AS (SELECT ref_id FROM e GROUP BY 1 HAVING count(*) > 60) SELECT ref_id, path, ceil(row_number() OVER (PARTITION BY ref_id ORDER BY path) / 60.0)::INTEGER AS page FROM e WHERE ref_id IN (SELECT ref_id FROM b)")
def s11_verse(t):
    e = t.cited
    many = e.groupBy("ref_id").agg(F.count("*").alias("n")).where("n > 60").select("ref_id")
    return windows.paginate(e.join(many, "ref_id", "left_semi"), ["path"], 60, ["ref_id"]).select("ref_id", "path", "page")


@query(f"WITH {VISIBLE} SELECT path, lag(path) OVER w AS previous, lead(path) OVER w AS next, array_to_string(bible_refs[1:7], '|') AS first_refs FROM visible WHERE preacher IS NOT NULL AND len(bible_refs) > 0 WINDOW w AS (PARTITION BY preacher ORDER BY date NULLS LAST, path)")
def s12_work(t):
    v = t.visible.where((F.col("preacher").isNotNull()) & (F.size("bible_refs") > 0)).select("preacher", "path", "date", F.array_join(F.slice("bible_refs", 1, 7), "|").alias("first_refs"))
    return windows.prev_next(v, "preacher", [F.col("date").asc_nulls_last(), "path"], "path").select("path", "previous", "next", "first_refs")


@query("SELECT md_id, CASE WHEN starts_with(path, 'mevar/') THEN '/' || path[7:] || '/' ELSE '/works/' || path || '/' END AS url FROM markdown")
def s13_routes(t):
    return t.markdown.select("md_id", F.when(F.startswith("path", F.lit("mevar/")), F.concat(F.lit("/"), F.expr("substring(path, 7)"), F.lit("/"))).otherwise(F.concat(F.lit("/works/"), "path", F.lit("/"))).alias("url"))


query(ORACLES["sink_rss"], name="s14_feed")(projections.sink_rss)
query(ORACLES["agg_facets"], name="s15_facets")(aggregates.agg_facets)


@query("SELECT user_id, max(value) AS progress, CASE WHEN max(value) >= 95 THEN 'done' ELSE 'open' END AS state FROM events GROUP BY 1")
def s16_reading_list(t):
    return t.events.groupBy("user_id").agg(F.max("value").alias("progress")).withColumn("state", F.when(F.col("progress") >= 95, "done").otherwise("open"))


@query()
def s17_issue(t):
    v = t.visible.where("status = 'published' and body is not null")
    return v.select("path", F.array_join(F.slice("bible_refs", 1, 3), ", ").alias("refs"), tx.excerpt_words(F.col("body")).alias("excerpt"))


@query("SELECT DISTINCT path FROM markdown WHERE status = 'published' AND path NOT IN (SELECT record_id FROM mevar_duplicates)")
def s18_not_sent(t):
    return t.markdown.where("status = 'published'").select("path").distinct().join(t.mevar_duplicates.select(F.col("record_id").alias("path")), "path", "left_anti")
