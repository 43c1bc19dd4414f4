"""Formats read back after being written or built from the tables, and the operators that remain."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from .. import schemas
from ..functions import align, norm, refs
from ..functions import text as tx
from ..operators import linkage, merge, quality
from ..shared import shared_dir, spread
from ..sources import files
from . import projections
from .registry import ORACLES, VISIBLE, WORKS, query


def _folder(t, label: str) -> str:
    return f"{shared_dir(t.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _bucket():
    return F.pmod(F.xxhash64("sermon_id"), F.lit(1024))


@query("SELECT source, count(*) AS n FROM markdown GROUP BY 1")
def src_walk_md(t):
    """One Markdown file for each source, with a line for each row; found by walking the folder."""
    at = _folder(t, "walk")
    lines = t.markdown.select("source", F.concat_ws(" ", F.lit("-"), F.col("md_id").cast("string")).alias("value"))
    lines.repartition("source").write.partitionBy("source").text(at)
    found = files.walk_md(t.spark, at, "*.txt").select(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), F.size(F.filter(F.split("text", "\n"), lambda x: x != "")).alias("k"))
    return found.groupBy("source").agg(F.sum("k").alias("n"))


@query("SELECT md_id, source FROM markdown")
def src_frontmatter_kv(t):
    f = projections._document(t).select("md_id", files.frontmatter(F.col("text"))["fields"].alias("f"))
    return f.select("md_id", F.regexp_replace(F.try_element_at("f", F.lit("source")), '^"|"$', "").alias("source"))


@query("SELECT md_id, tag FROM (SELECT md_id::VARCHAR AS md_id, unnest(list_distinct(tags)) AS tag FROM markdown WHERE year IS NOT NULL)")
def src_cms_export(t):
    """Exports of posts and tags, one for each source and year, and the tags of each post joined from them."""
    m = t.markdown.where("year is not null").select("source", "year", F.col("md_id").cast("string").alias("id"), "title", F.coalesce(F.array_distinct("tags"), F.array().cast("array<string>")).alias("tags"))
    post = F.struct("id", "title")
    link = F.transform("tags", lambda x: F.struct(F.col("id").alias("post_id"), x.alias("tag_id"), F.lit(0).alias("sort_order")))
    tag = F.transform("tags", lambda x: F.struct(x.alias("id"), x.alias("name")))
    g = m.groupBy("source", "year").agg(F.collect_list(post).alias("posts"), F.array_distinct(F.flatten(F.collect_list(tag))).alias("tags"), F.flatten(F.collect_list(link)).alias("posts_tags"))
    export = g.select(F.to_json(F.struct(F.array(F.struct(F.struct("posts", "tags", "posts_tags").alias("data"))).alias("db"))).alias("j"))
    tables = files.cms_export(export.select(F.from_json("j", schemas.CMS).alias("e")).select("e.*"))
    tags = tables["tags"].select(F.col("id").alias("tag_id"), F.col("name").alias("tag")).distinct()
    return tables["posts_tags"].join(tables["posts"].select(F.col("id").alias("post_id")), "post_id").join(tags, "tag_id").select(F.col("post_id").alias("md_id"), "tag")


_NESTED = "SELECT dense_rank() OVER (ORDER BY book)::INTEGER AS book, chapter, ref_id AS verse, canonical AS text FROM bible_ref"


def _books(t):
    """Books, chapters and verses of the reference table, nested."""
    from pyspark.sql import Window

    r = t.bible_ref.withColumn("nr", F.dense_rank().over(Window.orderBy("book")))  # a fixed table of some hundred rows
    c = r.groupBy("nr", "chapter").agg(F.collect_list(F.struct(F.col("ref_id").alias("verse"), F.col("canonical").alias("text"))).alias("verses"))
    return c.groupBy("nr").agg(F.collect_list(F.struct("chapter", "verses")).alias("chapters"))


@query(_NESTED)
def src_bible_json(t):
    j = _books(t).groupBy().agg(F.to_json(F.struct(F.collect_list(F.struct("nr", "chapters")).alias("books"))).alias("j"))
    return files.bible_json(j.select(F.from_json("j", schemas.BIBLE_JSON).alias("e")).select("e.*"))


@query(_NESTED)
def src_bible_xml(t):
    at = _folder(t, "bible")
    verse = lambda v: F.concat(F.lit('<verse number="'), v["verse"].cast("string"), F.lit('">'), v["text"], F.lit("</verse>"))
    chapter = lambda c: F.concat(F.lit('<chapter number="'), c["chapter"].cast("string"), F.lit('">'), F.array_join(F.transform(c["verses"], verse), ""), F.lit("</chapter>"))
    x = _books(t).select(F.concat(F.lit('<book number="'), F.col("nr").cast("string"), F.lit('">'), F.array_join(F.transform("chapters", chapter), ""), F.lit("</book>")).alias("value"))
    x.groupBy().agg(F.concat(F.lit("<bible>"), F.array_join(F.collect_list("value"), ""), F.lit("</bible>")).alias("value")).write.text(at)
    return files.bible_xml(t.spark, at)


@query("SELECT chapter, coalesce(verse_start, 1) AS verse, string_agg(DISTINCT 'G' || lpad((1000 + ref_id)::VARCHAR, 4, '0'), ',' ORDER BY 'G' || lpad((1000 + ref_id)::VARCHAR, 4, '0')) AS tokens FROM bible_ref GROUP BY 1, 2")
def src_tagged_tsv(t):
    lines = t.bible_ref.select(F.concat(F.lit("Ref."), F.col("chapter").cast("string"), F.lit("."), F.coalesce("verse_start", F.lit(1)).cast("string"), F.lit("\tG"), F.lpad((F.col("ref_id") + 1000).cast("string"), 4, "0")).alias("value"))
    return files.tagged_tsv(lines, "G").select("chapter", "verse", F.array_join("tokens", ",").alias("tokens"))


@query("SELECT entry_id, path, title FROM manifest")
def src_csv(t):
    at = _folder(t, "csv")
    t.manifest.select("entry_id", "path", "title").write.option("header", True).option("escape", '"').option("emptyValue", '""').csv(at)
    return files.csv(t.spark, at, ["entry_id", "path", "title"]).select(F.col("entry_id").cast("long").alias("entry_id"), "path", "title")


@query("SELECT entry_id, sermon_id AS id, coalesce(title, '-') AS title, coalesce(location, '-') AS location, nullif(regexp_extract(duration, '(\\d+) min', 1), '')::INTEGER AS minutes FROM manifest WHERE regexp_full_match(sermon_id, '\\d{2}-\\d{4}[A-Z]-[0-9a-z]+')")
def src_listing_md(t):
    m = t.manifest.where(F.col("sermon_id").rlike(r"^\d{2}-\d{4}[A-Z]-[0-9a-z]+$"))
    lines = m.select(F.col("entry_id").cast("string").alias("doc"), F.posexplode(F.array("sermon_id", F.coalesce("title", F.lit("-")), F.coalesce("location", F.lit("-")), F.coalesce("duration", F.lit("-")))).alias("pos", "value"))
    return files.listing_md(lines, r"^(\d{2}-\d{4}[A-Z]-[0-9a-z]+)$", 3).select(F.col("doc").cast("long").alias("entry_id"), "id", "title", "location", "minutes")


@query("SELECT regexp_replace(regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1), '/+$', '') AS path, min(url) AS url FROM documents WHERE regexp_matches(url, '^https?://(www\\.)?mevar\\.example/') GROUP BY 1")
def src_crawl_json(t):
    return files.crawl_json(t.documents.select("url", "text"), "mevar.example").select("path", "url")


@query("SELECT sermon_id AS id, min(year)::INTEGER AS year FROM manifest WHERE year IS NOT NULL AND sermon_id IS NOT NULL GROUP BY 1")
def src_allyears_merge(t):
    m = t.manifest.where("year is not null and sermon_id is not null").select(_bucket().alias("b"), F.col("year").cast("string").alias("y"), F.col("sermon_id").alias("id"), "title")
    years = m.groupBy("b", "y").agg(F.collect_list(F.struct("id", "title")).alias("rows")).groupBy("b").agg(F.map_from_entries(F.collect_list(F.struct("y", "rows"))).alias("m"))
    return files.all_years(years.select(F.to_json("m").alias("j")), "j").select("id", "year")


@query("SELECT left(sermon_id, 8) AS id, trim(location) AS location FROM manifest WHERE regexp_matches(sermon_id, '^\\d{2}-\\d{4}[A-Z]') AND location IS NOT NULL")
def src_html_listing(t):
    m = t.manifest.where(F.col("sermon_id").rlike(r"^\d{2}-\d{4}[A-Z]") & F.col("location").isNotNull())
    box = F.concat(F.lit('<div class="messagebox"><b>'), "sermon_id", F.lit('</b><span class="location"> '), "location", F.lit(" </span></div>"))
    return files.html_listing(m.select(_bucket().alias("b"), box.alias("x")).groupBy("b").agg(F.array_join(F.collect_list("x"), "\n").alias("html")), "html")


def _plugged(t):
    """Texts through a converter given by the caller; a stand-in that decodes bytes takes the place of native tools."""
    d = t.documents.where("text is not null").select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content"))
    return files.plugin(d, lambda b: b.decode()).select(F.col("path").cast("long").alias("doc_id"), F.length("text").cast("long").alias("n"), "error")


_SAME = "SELECT doc_id, length(text) AS n, NULL::VARCHAR AS error FROM documents WHERE text IS NOT NULL"
query(_SAME, name="src_pdf_text")(_plugged)


@query(_SAME)
def src_docx(t):
    """Texts as DOCX files, read back."""

    @F.pandas_udf("binary")
    def packed(x: pd.Series) -> pd.Series:
        return x.map(files.docx_file)

    d = spread(t.documents.where("text is not null").select(F.col("doc_id").cast("string").alias("path"), "text")).select("path", packed("text").alias("content"))
    return files.plugin(d, files.docx_text).select(F.col("path").cast("long").alias("doc_id"), F.length("text").cast("long").alias("n"), "error")


def _small_only(content: bytes) -> str:
    if len(content) > 2_000:
        raise ValueError("too long")
    return content.decode()


@query(_SAME)
def inc_retry(t):
    """Texts through a converter that takes short pieces only: long ones are tried again in halves."""
    d = spread(t.documents.where("text is not null").select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content")))
    return files.plugin(d, _small_only, retries=30).select(F.col("path").cast("long").alias("doc_id"), F.length("text").cast("long").alias("n"), "error")


@query()
def src_ocr_merge(t):
    """Whole bodies without their signs, which come back from the text that has them."""
    b = spread(t.markdown.where("body is not null").select(F.col("md_id").alias("id"), F.regexp_replace("body", r"[^\p{L}\p{M}\p{N}\p{Z}\s]", "").alias("text"), F.col("body").alias("source")))
    return align.aligned(b, "signs").select(F.col("id").alias("md_id"), "text")


@query("SELECT count(*) AS good, (SELECT count(*) FROM markdown WHERE body IS NULL) AS bad FROM markdown WHERE body IS NOT NULL")
def src_llm_cache(t):
    at = _folder(t, "answers")
    t.markdown.select("title", "subtitle", "date", F.col("body").alias("cleaned_markdown"), F.when(F.col("body").isNull(), "no text").alias("_error")).write.json(at)
    df = t.spark.read.schema(schemas.LLM_ANSWER).json(at)
    ok = F.col("_error").isNull() & F.col("_parse_error").isNull() & F.col("cleaned_markdown").isNotNull()
    return df.agg(F.count_if(ok).alias("good"), F.count_if(~ok).alias("bad"))


@query(f"WITH {WORKS} SELECT '^/' || path || '/?$' AS pattern, '/' || duplicate_of AS target FROM works WHERE duplicate_of IS NOT NULL")
def src_redirects(t):
    return files.redirects(t.works.where("duplicate_of is not null").select(F.concat(F.lit("/"), "path", F.lit(" /"), "duplicate_of", F.lit(" 301")).alias("value")))


@query("SELECT md_id, title FROM markdown WHERE llm_cleaned AND source = 'cmpp'")
def src_db_scan(t):
    return t.markdown.where("llm_cleaned and source = 'cmpp'").select("md_id", "title")


@query("SELECT pdf_url AS url, string_agg(DISTINCT entry_id::VARCHAR, ',' ORDER BY entry_id::VARCHAR) AS posts FROM manifest WHERE pdf_url LIKE 'http%.pdf' GROUP BY 1")
def src_pdf_links(t):
    found = files.pdf_links(t.manifest.select(F.col("entry_id").cast("string").alias("id"), F.concat(F.lit("[pdf]("), "pdf_url", F.lit(")")).alias("body")), "id", "body")
    return found.select("url", F.array_join("posts", ",").alias("posts"))


@query("SELECT sha256(text) AS hash, 'm' AS model, max(doc_id) AS v FROM documents WHERE text IS NOT NULL GROUP BY 1")
def sink_cache_put(t):
    d = t.documents.where("text is not null").groupBy(F.sha2("text", 256).alias("hash"), F.lit("m").alias("model"))
    return merge.upsert(d.agg(F.min("doc_id").alias("v")), d.agg(F.max("doc_id").alias("v")), ["hash", "model"], ["v"])


@query("SELECT vec_id, len(embedding) AS dim, label FROM embeddings")
def sink_jsonl(t):
    at = _folder(t, "vectors")
    merge.write_jsonl(t.embeddings, at)
    return t.spark.read.schema("vec_id long, embedding array<float>, label int").json(at).select("vec_id", F.size("embedding").cast("long").alias("dim"), "label")


@query("SELECT entry_id, title FROM manifest WHERE year = 1965")
def sink_partitioned_by_year(t):
    at = _folder(t, "years")
    merge.write_by_year(t.manifest.select("entry_id", "title", "year"), at)
    return t.spark.read.schema("entry_id long, title string, year int").parquet(at).where("year = 1965").select("entry_id", "title")


@query("SELECT '| ' || source || ' | ' || count(*) || ' |' AS line FROM markdown GROUP BY source")
def sink_report_md(t):
    return t.markdown.groupBy("source").agg(F.count("*").alias("n")).select(F.concat(F.lit("| "), "source", F.lit(" | "), F.col("n").cast("string"), F.lit(" |")).alias("line"))


@query("SELECT md_id, title, year AS published FROM markdown")
def proj_select(t):
    return t.markdown.select("md_id", "title", F.col("year").alias("published"))


query("SELECT md_id AS work, source AS origin FROM markdown", name="proj_alias")(lambda t: t.markdown.select(F.col("md_id").alias("work"), F.col("source").alias("origin")))


@query(f"WITH {WORKS} SELECT DISTINCT w.path, w.title, w.source, w.year FROM works w JOIN cites c USING (path) WHERE c.ref_id = 1")
def proj_star_through_edge(t):
    edge = t.cited.where("ref_id = 1").select("path")
    return edge.join(t.works.select("path", "title", "source", "year"), "path")


@query("SELECT md_id FROM markdown WHERE source IN ('cmpp', 'onedrive')")
def filt_in_list(t):
    return t.markdown.where(F.col("source").isin("cmpp", "onedrive")).select("md_id")


query(ORACLES["filt_edited"], name="filt_mission")(projections.filt_edited)


def _copies(t):
    """Texts and the text that each is a copy of."""
    w = t.works.where("body is not null")
    return w.select("md_id", "body", "duplicate_of").join(w.select(F.col("path").alias("duplicate_of"), F.col("body").alias("source")), "duplicate_of")


def _per_pair(f, kind: str):
    """A pandas function over pairs of texts, one result for each."""

    @F.pandas_udf(kind)
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x, y) for x, y in zip(a, b)])

    return run


def _unresolved(a: str, b: str) -> int:
    """How many of the words that differ from the source are not restored from it."""
    x, y = a.split(), b.split()
    return len(align.restore_spots(x, align.differing(x, y), y)[1])


query(name="align_anchor")(lambda t: _copies(t).select("md_id", _per_pair(lambda a, b: align.anchored(a.split(), b.split()), "int")("body", "source").alias("anchored")))
query(name="align_fixpoint")(lambda t: _copies(t).select("md_id", _per_pair(_unresolved, "int")("body", "source").alias("unresolved")))


@query("SELECT duplicate_of, count(*) AS claims FROM (SELECT DISTINCT record_id, duplicate_of FROM mevar_duplicates WHERE record_id <> duplicate_of) GROUP BY 1 HAVING count(*) = 1")
def align_claims(t):
    """Targets that exactly one record claims."""
    d = t.mevar_duplicates.where("record_id <> duplicate_of").select("record_id", "duplicate_of").distinct()
    return linkage.one_to_one(d, "duplicate_of")[0].groupBy("duplicate_of").agg(F.count("*").alias("claims"))


query(name="align_lcs")(lambda t: _copies(t).select("md_id", _per_pair(lambda a, b: len(align.common_letters(a, b)), "int")("body", "source").alias("letters")))
query(name="align_refs_guard")(lambda t: align.aligned(_copies(t).select(F.col("md_id").alias("id"), F.col("body").alias("text"), "source"), "words").select("id", F.size(refs.extract(F.col("text"))).alias("refs")))


@query("SELECT cite_id, split_part(canonical, ':', 1) || ':2-4' AS ref FROM cites JOIN bible_ref USING (ref_id) WHERE verse_start IS NULL")
def extract_refs_quote(t):
    """Chapters followed by a block quote with bold verse numbers."""
    c = t.cites.join(t.bible_ref.where("verse_start is null").select("ref_id", "canonical"), "ref_id")
    text = F.concat("canonical", F.lit(" :\n\n> **2** Un mot **3** puis **4** encore **1** fin"))
    return c.select("cite_id", F.get(refs.extract(text), F.lit(0))["ref"].alias("ref"))


@query("SELECT location, regexp_replace(regexp_replace(location, '^Ste[ -]', 'Sainte-'), '^St[ -]', 'Saint-') AS place FROM (SELECT DISTINCT location FROM manifest WHERE location IS NOT NULL)")
def extract_place(t):
    """Short forms of places spelled out by a table."""
    short = {"^Ste[ -]": "Sainte-", "^St[ -]": "Saint-"}
    place = F.col("location")
    for a, b in short.items():
        place = F.regexp_replace(place, a, b)
    return t.manifest.where("location is not null").select("location").distinct().select("location", place.alias("place"))


@query("SELECT doc_id, regexp_replace(text, 'https?://(www\\.)?lettres\\.example(/[^\\s)\"'']*)', '\\2', 'g') AS text FROM documents WHERE contains(text, 'lettres.example')")
def txt_relink(t):
    return t.documents.where(F.contains("text", F.lit("lettres.example"))).select("doc_id", tx.relink(F.col("text"), "lettres.example").alias("text"))


@query(f"WITH {WORKS} SELECT count(*) AS n, count(*) <= 2000 AS within FROM works WHERE duplicate_of IS NOT NULL")
def dq_redirect_limits(t):
    return t.works.where("duplicate_of is not null").agg(F.count("*").alias("n")).withColumn("within", F.col("n") <= 2000)


@query(f"WITH {VISIBLE} SELECT source, count(*) AS n, count(*) FILTER (WHERE title IS NULL OR regexp_replace(strip_accents(lower(title)), '[^a-z0-9]+', '', 'g') = '') AS without FROM visible GROUP BY 1")
def dq_titles_present(t):
    """Visible works of each source, and those whose title is missing or has no letter."""
    return t.visible.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("title").isNull() | (F.length(F.regexp_replace(norm.title(F.col("title")), " ", "")) == 0)).alias("without"))


@query("SELECT lang, count(*) AS n, count(*) FILTER (WHERE n_chars IS DISTINCT FROM length(text)) AS wrong FROM documents GROUP BY 1")
def dq_lengths(t):
    """Documents of each language, and those whose stated length is not that of their text."""
    return t.documents.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(~F.col("n_chars").eqNullSafe(F.length("text").cast("long"))).alias("wrong"))
