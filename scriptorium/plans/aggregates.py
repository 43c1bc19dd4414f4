"""Aggregations, window-like operators, sorts, limits and sets over the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import refs, similarity
from ..functions import text as tx
from ..operators import quality, windows
from ..shared import spread
from .registry import VISIBLE, WORKS, query


@query("SELECT (SELECT count(*) FROM markdown) AS works, (SELECT count(*) FROM bible_ref) AS refs, (SELECT count(*) FROM (SELECT DISTINCT path, ref_id FROM cites WHERE ref_id IS NOT NULL AND path IS NOT NULL)) AS edges")
def agg_count_all(t):
    one = lambda df, n: df.agg(F.count("*").alias(n))
    return one(t.markdown, "works").crossJoin(one(t.bible_ref, "refs")).crossJoin(one(t.cited, "edges"))  # three single rows


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1")
def agg_group_count(t):
    return t.documents.groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query("SELECT (year // 10) * 10 AS decade, count(*) AS n FROM markdown WHERE year IS NOT NULL GROUP BY 1")
def agg_group_expr(t):
    return t.markdown.where("year is not null").groupBy((F.floor(F.col("year") / 10) * 10).cast("int").alias("decade")).agg(F.count("*").alias("n"))


@query("SELECT r.ref_id, r.canonical, count(c.path) AS n FROM bible_ref r LEFT JOIN (SELECT DISTINCT path, ref_id FROM cites WHERE path IS NOT NULL) c ON c.ref_id = r.ref_id GROUP BY 1, 2")
def agg_degree(t):
    n = t.cited.groupBy("ref_id").agg(F.count("*").alias("n"))
    return t.bible_ref.select("ref_id", "canonical").join(n, "ref_id", "left").na.fill(0, ["n"])


@query("SELECT path, count(*) FILTER (WHERE ref_id IN (SELECT ref_id FROM bible_ref WHERE book = 'Jean')) AS n FROM (SELECT DISTINCT path, ref_id FROM cites WHERE path IS NOT NULL AND ref_id IS NOT NULL) GROUP BY 1")
def agg_filtered_edge_count(t):
    john = t.bible_ref.where("book = 'Jean'").select("ref_id", F.lit(1).alias("hit"))
    return t.cited.join(john, "ref_id", "left").groupBy("path").agg(F.count("hit").alias("n"))


@query("SELECT r.book, r.chapter, v.v AS verse, count(DISTINCT c.path) AS n FROM bible_ref r, range(1, 177) v(v), cites c WHERE v.v BETWEEN r.verse_start AND coalesce(r.verse_end, r.verse_start) AND c.ref_id = r.ref_id AND c.path IS NOT NULL GROUP BY 1, 2, 3")
def agg_verse_citations(t):
    v = t.bible_ref.where("verse_start is not null").select("ref_id", "book", "chapter", F.explode(F.sequence(F.col("verse_start").cast("long"), F.greatest("verse_start", F.coalesce("verse_end", "verse_start")).cast("long"))).alias("verse"))
    return t.cited.join(v, "ref_id").groupBy("book", "chapter", "verse").agg(F.count_distinct("path").alias("n"))


@query("SELECT book, chapter, count(DISTINCT path) FILTER (WHERE verse_start IS NULL) AS whole, count(DISTINCT path) FILTER (WHERE verse_start IS NOT NULL) AS in_verses FROM cites JOIN bible_ref USING (ref_id) WHERE path IS NOT NULL GROUP BY 1, 2")
def agg_chapter_index(t):
    e = t.cited.join(t.bible_ref.select("ref_id", "book", "chapter", "verse_start"), "ref_id")
    return e.groupBy("book", "chapter").agg(F.count_distinct(F.when(F.col("verse_start").isNull(), F.col("path"))).alias("whole"), F.count_distinct(F.when(F.col("verse_start").isNotNull(), F.col("path"))).alias("in_verses"))


@query("SELECT book, count(DISTINCT path) AS works, count(DISTINCT chapter) AS chapters FROM cites JOIN bible_ref USING (ref_id) WHERE path IS NOT NULL GROUP BY 1")
def agg_book_distinct(t):
    e = t.cited.join(t.bible_ref.select("ref_id", "book", "chapter"), "ref_id")
    return e.groupBy("book").agg(F.count_distinct("path").alias("works"), F.count_distinct("chapter").alias("chapters"))


@query("SELECT max(n) AS most, (SELECT count(DISTINCT path) FROM cites WHERE ref_id IS NOT NULL) AS works FROM (SELECT book, count(DISTINCT path) AS n FROM cites JOIN bible_ref USING (ref_id) WHERE path IS NOT NULL GROUP BY 1)")
def agg_max_global(t):
    per = agg_book_distinct(t).agg(F.max("works").alias("most"))
    return per.crossJoin(t.cited.agg(F.count_distinct("path").alias("works")))  # two single rows


@query(f"WITH {VISIBLE} SELECT preacher AS name, string_agg(path, '|' ORDER BY date NULLS LAST, path) AS parts, max(date) AS newest FROM visible WHERE preacher IS NOT NULL AND source = 'mevar' GROUP BY 1")
def agg_series_group(t):
    v = t.visible.where("preacher is not null and source = 'mevar'")
    part = F.struct(F.col("date").isNull().alias("u"), "date", "path")
    return v.groupBy(F.col("preacher").alias("name")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda s: s["path"]), "|").alias("parts"), F.max("date").alias("newest"))


@query(f"WITH {VISIBLE} SELECT source, editorial_pass IS NOT NULL AS edited, count(*) AS n FROM visible GROUP BY 1, 2")
def agg_source_sections(t):
    return t.visible.groupBy("source", F.col("editorial_pass").isNotNull().alias("edited")).agg(F.count("*").alias("n"))


@query("SELECT tag, count(DISTINCT md_id) AS n FROM (SELECT md_id, unnest(tags) AS tag FROM markdown) GROUP BY 1 HAVING count(DISTINCT md_id) > 0")
def agg_tag_counts(t):
    return t.markdown.select("md_id", F.explode("tags").alias("tag")).groupBy("tag").agg(F.count_distinct("md_id").alias("n")).orderBy(F.desc("n"), "tag")


@query("SELECT sha256(text) AS hash, min(doc_id) AS canonical, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def agg_hash_groups(t):
    g = t.documents.where("text is not null").groupBy(F.sha2("text", 256).alias("hash"))
    return g.agg(F.min("doc_id").alias("canonical"), F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("ids")).where("n > 1")


@query()
def agg_doc_freq(t):
    words = F.split(F.trim(F.regexp_replace(F.lower("body"), "[^a-zà-ÿ']+", " ")), " ")
    return spread(t.markdown.where("body is not null").select("body")).select(F.explode(F.array_distinct(similarity.ngrams(words, 2, 3))).alias("phrase")).groupBy("phrase").agg(F.count("*").alias("df")).where("df >= 8")


@query("WITH i AS (SELECT DISTINCT md_id, tag FROM (SELECT md_id, unnest(tags) AS tag FROM markdown)) SELECT md_id, tag FROM i WHERE tag IN (SELECT tag FROM i GROUP BY 1 HAVING count(*) <= 20)")
def agg_df_cap(t):
    i = t.markdown.select("md_id", F.explode("tags").alias("tag")).distinct()
    return i.join(i.groupBy("tag").agg(F.count("*").alias("df")).where("df <= 20").select("tag"), "tag", "left_semi")


@query("SELECT phrase, count(*) FILTER (WHERE lang = 'fr') AS fr, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'de') AS de, sum((length(low) - length(replace(low, phrase, ''))) // length(phrase))::BIGINT AS mentions, min(year) AS first_year FROM (SELECT lower(text) AS low, lang, year FROM documents WHERE text IS NOT NULL), (VALUES ('la lumière'), ('the light'), ('das licht'), ('la semence')) p(phrase) WHERE contains(low, phrase) GROUP BY 1")
def agg_layer_matrix(t):
    phrases = ["la lumière", "the light", "das licht", "la semence"]
    d = t.documents.where("text is not null").select(F.lower("text").alias("low"), "lang", "year")
    rows = d.select("low", "lang", "year", F.explode(F.array(*[F.lit(p) for p in phrases])).alias("phrase")).where(F.contains("low", F.col("phrase")))
    n = (F.length("low") - F.length(F.replace("low", F.col("phrase"), F.lit("")))) / F.length("phrase")
    return rows.groupBy("phrase").agg(*[F.count_if(F.col("lang") == x).alias(x) for x in ("fr", "en", "de")], F.sum(n.cast("long")).alias("mentions"), F.min("year").alias("first_year"))


@query("SELECT least(9, floor(least(share_ab, share_ba) * 10))::INTEGER AS bin, count(*) AS n FROM mevar_duplicates WHERE share_ab IS NOT NULL AND share_ba IS NOT NULL GROUP BY 1")
def agg_histogram(t):
    d = t.mevar_duplicates.where("share_ab is not null and share_ba is not null")
    return d.groupBy(F.least(F.lit(9), F.floor(F.least("share_ab", "share_ba") * 10)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(title) AS titles, count(date) AS dates, count(location) AS locations, count(*) FILTER (WHERE len(tags) > 0) AS tagged, count(*) FILTER (WHERE llm_cleaned) AS cleaned FROM markdown")
def agg_cond_counts(t):
    return t.markdown.agg(F.count("*").alias("n"), F.count("title").alias("titles"), F.count("date").alias("dates"), F.count("location").alias("locations"), F.count_if(F.size("tags") > 0).alias("tagged"), F.count_if("llm_cleaned").alias("cleaned"))


@query("SELECT path, string_agg(DISTINCT raw_ref, '|' ORDER BY raw_ref) AS refs FROM cites WHERE path IS NOT NULL GROUP BY 1")
def agg_set_union(t):
    return t.cites.where("path is not null").groupBy("path").agg(F.array_join(F.array_sort(F.collect_set("raw_ref")), "|").alias("refs"))


@query("SELECT path, string_agg(raw_ref, ' ' ORDER BY pos, cite_id) AS refs FROM cites WHERE path IS NOT NULL GROUP BY 1")
def agg_string_join(t):
    g = t.cites.where("path is not null and raw_ref is not null").groupBy("path")
    return g.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "cite_id", "raw_ref"))), lambda s: s["raw_ref"]), " ").alias("refs"))


@query("SELECT md.source, count(*) AS refs, count(DISTINCT ref_id) AS distinct_refs FROM (SELECT DISTINCT path, ref_id FROM cites WHERE ref_id IS NOT NULL) c JOIN (SELECT path, min(source) AS source FROM markdown GROUP BY 1) md USING (path) GROUP BY 1")
def agg_distinct_refs(t):
    src = t.markdown.groupBy("path").agg(F.min("source").alias("source"))
    return t.cited.join(src, "path").groupBy("source").agg(F.count("*").alias("refs"), F.count_distinct("ref_id").alias("distinct_refs"))


@query("SELECT source, min(date) AS first_date, max(date) AS last_date FROM markdown GROUP BY 1")
def agg_min_max(t):
    return t.markdown.groupBy("source").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem GROUP BY 1")
def agg_sum_cost(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("SELECT band, (duplicate_of IS NULL) AS nothing_found, count(*) AS n FROM mevar_duplicates GROUP BY 1, 2")
def agg_run_tally(t):
    return t.mevar_duplicates.groupBy("band", F.col("duplicate_of").isNull().alias("nothing_found")).agg(F.count("*").alias("n"))


@query("SELECT 'source' AS facet, source AS value, count(*) AS n FROM documents WHERE lang = 'fr' AND source IS NOT NULL GROUP BY 2 UNION ALL SELECT 'year', year::VARCHAR, count(*) FROM documents WHERE lang = 'fr' AND year IS NOT NULL GROUP BY 2 UNION ALL SELECT 'preacher', preacher, count(*) FROM documents WHERE lang = 'fr' AND preacher IS NOT NULL GROUP BY 2")
def agg_facets(t):
    from ..operators.search import facets

    return facets(t.documents.where("lang = 'fr'"), ["source", "year", "preacher"])


@query("SELECT path, string_agg(coalesce(body, ''), E'\\n\\n' ORDER BY ingested_at, md_id) AS text, arg_min(title, md_id) AS title FROM markdown WHERE title IS NOT NULL GROUP BY 1")
def agg_concat_chunks(t):
    g = t.markdown.where("title is not null").groupBy("path")
    return g.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ingested_at", "md_id", F.coalesce("body", F.lit("")).alias("b")))), lambda s: s["b"]), "\n\n").alias("text"), F.min_by("title", "md_id").alias("title"))


@query("SELECT path, min(entry_id) AS entry_id FROM manifest GROUP BY 1")
def win_dedup_first(t):
    w = Window.partitionBy("path").orderBy("entry_id")
    return t.manifest.withColumn("r", F.row_number().over(w)).where("r = 1").select("path", "entry_id")


@query("SELECT group_key, md_id FROM (SELECT coalesce(duplicate_of, path) AS group_key, md_id, row_number() OVER (PARTITION BY coalesce(duplicate_of, path) ORDER BY status IS NOT DISTINCT FROM 'published' DESC, editorial_pass IS NOT NULL DESC, length(coalesce(body, '')) DESC, md_id) AS r FROM markdown) WHERE r = 1")
def win_keeper(t):
    key = F.coalesce("duplicate_of", "path")
    w = Window.partitionBy(key).orderBy(F.desc(F.col("status").eqNullSafe("published")), F.desc(F.col("editorial_pass").isNotNull()), F.desc(F.length(F.coalesce("body", F.lit("")))), "md_id")
    return t.markdown.select(key.alias("group_key"), "md_id", F.row_number().over(w).alias("r")).where("r = 1").drop("r")


_RANK = "CASE split_part(source_path, '.', -1) WHEN 'md' THEN 0 WHEN 'pdf' THEN 1 WHEN 'mp3' THEN 2 ELSE 3 END"


@query(f"SELECT path, source_path FROM (SELECT path, source_path, row_number() OVER (PARTITION BY path ORDER BY {_RANK}, source_path, entry_id) AS r FROM manifest WHERE path IS NOT NULL) WHERE r = 1")
def win_variant_rank(t):
    ext = F.element_at(F.split("source_path", "\\."), -1)
    w = Window.partitionBy("path").orderBy(F.when(ext == "md", 0).when(ext == "pdf", 1).when(ext == "mp3", 2).otherwise(3), "source_path", "entry_id")
    return t.manifest.where("path is not null").select("path", "source_path", F.row_number().over(w).alias("r")).where("r = 1").drop("r")


@query("SELECT file_hash, arg_min(source_path, (length(source_path), source_path)) AS canonical, count(*) AS n FROM manifest WHERE source_path IS NOT NULL GROUP BY 1")
def win_canonical(t):
    return t.manifest.where("source_path is not null").groupBy("file_hash").agg(F.min_by("source_path", F.struct(F.length("source_path"), "source_path")).alias("canonical"), F.count("*").alias("n"))


@query(f"WITH {WORKS} SELECT date, path, row_number() OVER (PARTITION BY date ORDER BY sermon_id, path) AS nth FROM works WHERE source = 'sermons-en' AND date IS NOT NULL")
def win_nth(t):
    w = Window.partitionBy("date").orderBy("sermon_id", "path")
    return t.works.where("source = 'sermons-en' and date is not null").select("date", "path", F.row_number().over(w).cast("long").alias("nth"))


@query(f"WITH {VISIBLE} SELECT preacher, path, row_number() OVER (PARTITION BY preacher ORDER BY year NULLS LAST, date NULLS LAST, path) AS part FROM visible WHERE preacher IS NOT NULL")
def win_part_number(t):
    v = t.visible.where("preacher is not null").select("preacher", "path", "year", "date")
    return windows.part_number(v, "preacher", "year", "date", "path").select("preacher", "path", F.col("part").cast("long").alias("part"))


@query(f"WITH {VISIBLE} SELECT path, lag(path) OVER w AS previous, lead(path) OVER w AS next FROM visible WHERE preacher IS NOT NULL WINDOW w AS (PARTITION BY preacher ORDER BY date NULLS LAST, path)")
def win_prev_next(t):
    v = t.visible.where("preacher is not null").select("preacher", "path", "date")
    return windows.prev_next(v, "preacher", [F.col("date").asc_nulls_last(), "path"], "path").select("path", "previous", "next")


@query(f"WITH {VISIBLE}, r AS (SELECT location, path, row_number() OVER (PARTITION BY location ORDER BY date NULLS LAST, path) - 1 AS k, count(*) OVER (PARTITION BY location) AS m FROM visible WHERE location IS NOT NULL), s AS (SELECT r.*, unnest(range(1, least(2, m - 1)::BIGINT + 1)) AS step FROM r WHERE m > 1) SELECT s.path, s.step::INTEGER AS step, o.path AS follower FROM s JOIN r o ON o.location = s.location AND o.k = (s.k + s.step) % s.m")
def win_next_circular(t):
    v = t.visible.where("location is not null").select("location", "path", "date")
    return windows.next_circular(v, "location", [F.col("date").asc_nulls_last(), "path"], "path").select("path", "step", "follower")


@query(f"WITH {VISIBLE} SELECT source, path, ceil(row_number() OVER (PARTITION BY source ORDER BY date DESC NULLS LAST, path) / 60.0)::INTEGER AS page FROM visible")
def win_paginate(t):
    return windows.paginate(t.visible.select("source", "path", "date"), [F.col("date").desc_nulls_last(), "path"], 60, ["source"]).select("source", "path", "page")


@query("WITH x AS (SELECT md_id, regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', '_', 'g') AS tok FROM markdown WHERE title IS NOT NULL) SELECT md_id, CASE WHEN row_number() OVER w = 1 THEN tok ELSE tok || '_' || row_number() OVER w END AS unique_token FROM x WINDOW w AS (PARTITION BY tok ORDER BY md_id)")
def win_slug_suffix(t):
    from ..functions import norm

    x = t.markdown.where("title is not null").select("md_id", F.regexp_replace(norm.unaccent(F.lower("title")), "[^a-z0-9]+", "_").alias("tok"))
    return windows.slug_suffix(x, "tok", ["md_id"]).select("md_id", "unique_token")


@query("WITH x AS (SELECT md_id, path, left(regexp_replace(lower(path), '[^a-z0-9]+', '_', 'g'), 12) AS tok FROM markdown) SELECT md_id, CASE WHEN row_number() OVER (PARTITION BY tok ORDER BY md_id) = 1 THEN tok ELSE tok || '_' || left(sha256(path), 8) END AS unique_token FROM x")
def win_hash_suffix(t):
    x = t.markdown.select("md_id", "path", F.substring(F.regexp_replace(F.lower("path"), "[^a-z0-9]+", "_"), 1, 12).alias("tok"))
    return windows.hash_suffix(x, "tok", "path", ["md_id"]).select("md_id", "unique_token")


@query(f"WITH {WORKS}, a AS (SELECT path, title || '-' || year AS l0, title || '-' || coalesce(date, '') AS l1, title || '-' || path AS l2 FROM works), b AS (SELECT *, count(*) OVER (PARTITION BY l0) AS n0, count(*) OVER (PARTITION BY l1) AS n1, count(*) OVER (PARTITION BY l2) AS n2 FROM a) SELECT path, CASE WHEN l0 IS NOT NULL AND n0 = 1 THEN l0 WHEN l1 IS NOT NULL AND n1 = 1 THEN l1 WHEN l2 IS NOT NULL AND n2 = 1 THEN l2 END AS file_name FROM b")
def win_name_levels(t):
    levels = [F.concat("title", F.lit("-"), F.col("year").cast("string")), F.concat("title", F.lit("-"), F.coalesce("date", F.lit(""))), F.concat("title", F.lit("-"), "path")]
    return windows.name_levels(t.works.select("path", "title", "year", "date"), levels).select("path", "file_name")


@query()
def win_ascending_run(t):
    refs_ = t.markdown.where(F.size("bible_refs") > 0).select("md_id", F.transform("bible_refs", lambda r: F.coalesce(F.regexp_extract(r, r" (\d+)", 1).try_cast("int"), F.lit(0))).alias("c"))
    return refs_.select("md_id", F.array_join(windows.ascending_run(F.col("c")), ",").alias("run"))


@query()
def win_nonoverlap(t):
    d = t.markdown.where("lang = 'fr' and body is not null").select("md_id", refs.extract(F.col("body")).alias("c"))
    return d.select("md_id", F.posexplode(F.transform(windows.nonoverlapping(F.col("c")), lambda s: s["ref"])).alias("k", "ref"))


@query(f"WITH {WORKS} SELECT path, row_number() OVER (PARTITION BY source ORDER BY coalesce(date, '9999'), sermon_id, path) AS place FROM works")
def sort_stable_multi(t):
    rows = t.works.select("source", "path", "sermon_id", F.coalesce("date", F.lit("9999")).alias("day"))
    return windows.ranked(rows, ["source"], [F.col("day"), F.col("sermon_id"), F.col("path")]).select("path", F.col("rank").cast("long").alias("place"))


@query(f"WITH {VISIBLE} SELECT path, title, date FROM visible ORDER BY coalesce(date, '') DESC, title NULLS FIRST, path LIMIT 50")
def sort_recent(t):
    return t.visible.select("path", "title", "date").orderBy(F.desc(F.coalesce("date", F.lit(""))), F.col("title").asc_nulls_first(), "path").limit(50)


@query(f"WITH {VISIBLE} SELECT path, source FROM visible ORDER BY source = 'mevar' DESC, date DESC NULLS LAST, path LIMIT 40")
def sort_partition_first(t):
    return t.visible.select("path", "source", "date").orderBy(F.desc(F.col("source") == "mevar"), F.col("date").desc_nulls_last(), "path").limit(40).select("path", "source")


@query("SELECT path, string_agg(raw_ref, '|' ORDER BY pos, length(raw_ref) DESC, raw_ref) AS refs FROM (SELECT path, raw_ref, min(pos) AS pos FROM cites WHERE path IS NOT NULL AND raw_ref IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def sort_by_position(t):
    first = t.cites.where("path is not null and raw_ref is not null").groupBy("path", "raw_ref").agg(F.min("pos").alias("pos"))
    return first.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", (-F.length("raw_ref")).alias("n"), "raw_ref"))), lambda s: s["raw_ref"]), "|").alias("refs"))


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts DESC, event_id) AS r FROM events) WHERE r <= 3")
def sort_saved_recent(t):
    w = Window.partitionBy("user_id").orderBy(F.desc("value"), F.desc("ts"), "event_id")
    return t.events.select("user_id", "event_id", F.row_number().over(w).alias("r")).where("r <= 3").drop("r")


@query("SELECT ref_id, n FROM (SELECT ref_id, count(DISTINCT path) AS n FROM cites WHERE ref_id IS NOT NULL AND path IS NOT NULL GROUP BY 1) ORDER BY n DESC, ref_id LIMIT 10")
def lim_topk(t):
    return t.cited.groupBy("ref_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ref_id").limit(10)


@query("SELECT record_id, duplicate_of FROM (SELECT record_id, duplicate_of, row_number() OVER (PARTITION BY record_id ORDER BY least(share_ab, share_ba) DESC, duplicate_of) AS r FROM mevar_duplicates WHERE duplicate_of IS NOT NULL AND record_id <> duplicate_of AND least(share_ab, share_ba) > 0) WHERE r = 1")
def lim_argmax(t):
    d = t.mevar_duplicates.where("duplicate_of is not null and record_id <> duplicate_of").withColumn("s", F.least("share_ab", "share_ba")).where("s > 0")
    w = Window.partitionBy("record_id").orderBy(F.desc("s"), "duplicate_of")
    return d.withColumn("r", F.row_number().over(w)).where("r = 1").select("record_id", "duplicate_of")


@query("SELECT name FROM (SELECT unnest(persons) AS name FROM markdown UNION SELECT preacher FROM markdown UNION SELECT preacher FROM documents) WHERE name IS NOT NULL")
def set_union(t):
    m = t.markdown
    names = m.select(F.explode("persons").alias("name")).union(m.select("preacher")).union(t.documents.select("preacher"))
    return names.where("name is not null").distinct()


@query("SELECT DISTINCT path FROM markdown WHERE path IN (SELECT path FROM manifest)")
def set_intersect(t):
    return t.markdown.select("path").intersect(t.manifest.select("path")).where("path is not null")


@query("SELECT DISTINCT path FROM manifest WHERE path IS NOT NULL AND path NOT IN (SELECT path FROM markdown WHERE path IS NOT NULL)")
def set_except(t):
    return t.manifest.select("path").where("path is not null").distinct().join(t.markdown.select("path"), "path", "left_anti")


@query("SELECT path, entry_id, epoch_us(discovered_at) AS discovered_us FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY discovered_at DESC, entry_id DESC) AS r FROM manifest WHERE path IS NOT NULL) m WHERE r = 1 AND EXISTS (SELECT 1 FROM markdown k WHERE k.path = m.path AND k.ingested_at < m.discovered_at)")
def inc_updated_at(t):
    w = Window.partitionBy("path").orderBy(F.desc("discovered_at"), F.desc("entry_id"))
    m = t.manifest.where("path is not null").withColumn("r", F.row_number().over(w)).where("r = 1").select("path", "entry_id", "discovered_at")
    first = t.markdown.groupBy("path").agg(F.min("ingested_at").alias("i"))
    return m.join(first, "path").where("i < discovered_at").select("path", "entry_id", F.unix_micros(F.col("discovered_at").cast("timestamp")).alias("discovered_us"))


@query("SELECT DISTINCT path FROM manifest WHERE path IS NOT NULL AND path NOT IN (SELECT path FROM markdown WHERE llm_cleaned AND path IS NOT NULL)")
def inc_cache_skip(t):
    return t.manifest.where("path is not null").select("path").distinct().join(t.markdown.where("llm_cleaned").select("path"), "path", "left_anti")


@query("SELECT user_id, max(value) AS progress, epoch_us(max(ts)) AS opened_us FROM events GROUP BY 1")
def inc_progress(t):
    from ..streaming.progress import progress

    return progress(t.events, ["user_id"]).select("user_id", "progress", F.unix_micros(F.col("opened").cast("timestamp")).alias("opened_us"))


_TARGETS = "list_concat(regexp_extract_all(text, '\\]\\(([^)\\s]+)\\)', 1), regexp_extract_all(text, 'href=\"([^\"]+)\"', 1))"


@query(f"WITH l AS (SELECT doc_id, regexp_replace(unnest({_TARGETS}), '#.*$', '') AS target FROM documents), d AS (SELECT DISTINCT doc_id, target FROM l WHERE target <> '') SELECT doc_id, target FROM d WHERE target NOT IN (SELECT url FROM documents WHERE url IS NOT NULL)")
def dq_assets_resolve(t):
    """Targets of links in the texts, fragments cut off, that are no document's address."""
    links = t.documents.select("doc_id", F.explode(tx.links(F.col("text"))).alias("target")).select("doc_id", F.regexp_replace("target", "#.*$", "").alias("target"))
    return quality.unresolved(links.where("target <> ''").distinct(), "target", t.documents.where("url is not null"), "url")


@query("SELECT DISTINCT duplicate_of AS path FROM markdown WHERE duplicate_of IS NOT NULL AND duplicate_of NOT IN (SELECT path FROM markdown WHERE path IS NOT NULL)")
def dq_links_resolve(t):
    return quality.unresolved(t.markdown.where("duplicate_of is not null").select(F.col("duplicate_of").alias("path")).distinct(), "path", t.markdown, "path")


@query("SELECT DISTINCT path FROM markdown WHERE path IS NOT NULL AND path NOT IN (SELECT path FROM manifest WHERE path IS NOT NULL)")
def dq_expected_present(t):
    return quality.missing(t.markdown.where("path is not null"), t.manifest, ["path"])


@query("SELECT DISTINCT path FROM cites WHERE path IN (SELECT path FROM markdown WHERE status = 'draft')")
def dq_forbidden_absent(t):
    return quality.forbidden(t.cites, t.markdown.where("status = 'draft'"), ["path"])


@query("SELECT path, count(*) AS n FROM markdown GROUP BY 1 HAVING count(*) > 1")
def dq_unique_keys(t):
    return quality.duplicates(t.markdown, ["path"])


@query("SELECT coalesce(length(date), 0)::INTEGER AS digits, date IS NULL OR regexp_full_match(date, '\\d{4}(-(0[1-9]|1[0-2])(-(0[1-9]|[12]\\d|3[01]))?)?') AS valid, count(*) AS n FROM markdown GROUP BY 1, 2")
def dq_dates_valid(t):
    """Dates by precision, those that are no day, month or year apart."""
    bad = quality.invalid_dates(t.markdown.select("md_id", "date"), "date").select("md_id", F.lit(False).alias("ok"))
    rows = t.markdown.select("md_id", "date").join(bad, "md_id", "left")
    return rows.groupBy(F.coalesce(F.length("date"), F.lit(0)).alias("digits"), F.coalesce("ok", F.lit(True)).alias("valid")).agg(F.count("*").alias("n"))


@query("SELECT event_type, count(*) AS n, count(*) FILTER (WHERE NOT json_valid(props)) AS invalid FROM events GROUP BY 1")
def dq_json_valid(t):
    bad = quality.invalid_json(t.events, "props").groupBy("event_type").agg(F.count("*").alias("bad"))
    return t.events.groupBy("event_type").agg(F.count("*").alias("n")).join(bad, "event_type", "left").select("event_type", "n", F.coalesce("bad", F.lit(0)).alias("invalid"))


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(text) > 20000")
def dq_file_limits(t):
    return quality.over_limit(t.documents.select("doc_id", F.length("text").cast("long").alias("n")), F.col("n"), 20000)


@query(f"WITH {VISIBLE}, n AS (SELECT path FROM visible WHERE source = 'mevar' ORDER BY date DESC NULLS LAST, path LIMIT 30), f AS (SELECT path FROM works WHERE source = 'mevar' ORDER BY date DESC NULLS LAST, path LIMIT 30) SELECT coalesce(n.path, f.path) AS path, CASE WHEN f.path IS NULL THEN 'missing' WHEN n.path IS NULL THEN 'stale' ELSE 'right' END AS state FROM n FULL JOIN f USING (path)")
def dq_rss_newest(t):
    """The newest visible works against a feed that was made from all works: what it lacks, and what it should not have."""
    newest = lambda df: df.where("source = 'mevar'").orderBy(F.col("date").desc_nulls_last(), "path").limit(30).select("path")
    both = newest(t.visible).withColumn("n", F.lit(True)).join(newest(t.works).withColumn("f", F.lit(True)), "path", "full_outer")
    return both.select("path", F.when(F.col("f").isNull(), "missing").when(F.col("n").isNull(), "stale").otherwise("right").alias("state"))


@query()
def dq_attribution(t):
    m = t.markdown.where("preacher is not null and body is not null")
    return m.groupBy(tx.signature(F.col("body"), F.col("preacher")).alias("state")).agg(F.count("*").alias("n"))


@query("SELECT count(DISTINCT coalesce(path, '')) AS n, 0 AS different FROM markdown")
def dq_idempotent(t):
    """Rows of a run, and how many of them a second run over what the first one wrote would change."""
    first = t.markdown.groupBy("path").agg(F.max("title").alias("title"), F.max("ingested_at").alias("at"))
    second = t.markdown.unionByName(first.select("path", "title", F.col("at").alias("ingested_at")), allowMissingColumns=True).groupBy("path").agg(F.max("title").alias("title"), F.max("ingested_at").alias("at"))
    odd = quality.same(first, second).agg(F.count("*").cast("int").alias("different"))
    return first.agg(F.count("*").alias("n")).crossJoin(F.broadcast(odd))  # one row each
