"""Readers of files: documents with front matter, manifests, exports, verse files, listings, links, plug-ins.

All readers are lazy, take folders as well as files, and keep what they cannot read: broken JSON becomes a row with
``_corrupt_record``, unknown keys stay in a map.
"""

from __future__ import annotations

import html
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as tx

_FENCE = r"^---\n([\s\S]*?)\n---\n+"


def walk_md(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """``(path, size, text)`` of all matching files under a folder, or of one file."""
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folder, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("value").alias("text"))


def collection(spark: SparkSession, folder: str, sources: list[str] | None = None) -> DataFrame:
    """Documents of a folder partitioned by ``source=``; a scope prunes partitions before anything is read."""
    df = spark.read.parquet(folder)
    return df.where(F.col("source").isin(sources)) if sources else df


def frontmatter(text: Column) -> dict[str, Column]:
    """Front matter, body, and the ``key: value`` lines as a map of raw values."""
    head = F.regexp_extract(text, _FENCE, 1)
    keys = F.regexp_extract_all(head, F.lit(r"(?m)^([a-z_]+):(?: (.*))?$"), 1)
    values = F.regexp_extract_all(head, F.lit(r"(?m)^([a-z_]+):(?: (.*))?$"), 2)
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    # the first of equal keys counts
    once = F.filter(pairs, lambda p, i: F.array_position(keys, p["k"]) == i + 1)
    return {"head": head, "body": F.regexp_replace(text, _FENCE, ""), "fields": F.map_from_arrays(F.transform(once, lambda p: p["k"]), F.transform(once, lambda p: p["v"]))}


def field(fields: Column, key: str) -> Column:
    """A scalar field: JSON strings unquoted, empty as null."""
    raw = F.trim(F.try_element_at(fields, F.lit(key)))
    return F.nullif(F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v"), F.regexp_replace(raw, "^[\"']|[\"']$", "")), F.lit(""))


def block_list(head: Column, key: str) -> Column:
    """A YAML block list: ``key:`` and lines ``  - "x"``."""
    block = F.regexp_extract(head, rf"(?m)^{key}:[ ]*\n((?:[ ]+- .*\n?)+)", 1)
    items = F.filter(F.split(block, "\n"), lambda x: x.rlike(r"^\s+- "))
    return F.transform(items, lambda x: F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), F.regexp_replace(x, r"^\s+- ", ""), F.lit("}")), "$.v"), F.regexp_replace(x, r"^\s+- ", "")))


def json_list(fields: Column, key: str) -> Column:
    """An inline JSON list."""
    return F.from_json(F.try_element_at(fields, F.lit(key)), "array<string>")


def set_field(text: Column, key: str, value: Column) -> Column:
    """The text with one field of its front matter set, in place if it is there, else as the last one."""
    line = F.concat(F.lit(f"{key}: "), F.to_json(F.struct(value.alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(value.alias("v")))) - 6))
    there = text.rlike(rf"(?s)^---\n(?:.*\n)?{key}:.*?\n---\n")
    safe = F.replace(F.replace(line, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.when(there, F.regexp_replace(text, F.lit(rf"(?m)^{key}:.*$"), safe)).otherwise(F.regexp_replace(text, F.lit(r"^---\n([\s\S]*?)\n---\n"), F.concat(F.lit("---\n$1\n"), safe, F.lit("\n---\n"))))


def drop_field(text: Column, key: str) -> Column:
    return F.regexp_replace(text, rf"(?m)^{key}:.*\n(?:[ ]+- .*\n)*", "")


def manifests(frames: list[DataFrame]) -> DataFrame:
    """Union of manifests whose columns differ, keyed ``source/sermon_id``; of equal keys the last manifest's wins."""
    out = None
    for k, df in enumerate(frames):
        df = df.withColumn("_order", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    w = Window.partitionBy("source", "sermon_id").orderBy(F.desc("_order"))
    return out.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_order")


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Multi-line JSON; records that cannot be parsed are kept in ``_corrupt_record``."""
    r = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    return (r.schema(schema + ", _corrupt_record string") if schema else r).json(path)


def cms_export(df: DataFrame) -> dict[str, DataFrame]:
    """Tables of a nested CMS export ``db[0].data``."""
    data = df.select(F.col("db")[0]["data"].alias("d"))
    return {t: data.select(F.explode(f"d.{t}").alias("r")).select("r.*") for t in ("posts", "tags", "users", "posts_tags", "posts_authors")}


def newest(files: DataFrame) -> DataFrame:
    """The one file whose name sorts last."""
    return files.orderBy(F.desc("path")).limit(1)


def bible_json(df: DataFrame) -> DataFrame:
    """``(book, chapter, verse, text)`` of nested books, chapters and verses."""
    b = df.select(F.explode("books").alias("b"))
    c = b.select(F.col("b.nr").alias("book"), F.explode("b.chapters").alias("c"))
    return c.select("book", F.col("c.chapter").alias("chapter"), F.explode("c.verses").alias("v")).select("book", "chapter", F.col("v.verse").alias("verse"), F.col("v.text").alias("text"))


def bible_xml(spark: SparkSession, path: str) -> DataFrame:
    """The same of ``<book number><chapter number><verse number>``, white space squeezed."""
    schema = "_number int, chapter array<struct<_number:int,verse:array<struct<_number:int,_VALUE:string>>>>"
    df = spark.read.format("xml").option("rowTag", "book").schema(schema).load(path)
    c = df.select(F.col("_number").alias("book"), F.explode("chapter").alias("c"))
    v = c.select("book", F.col("c._number").alias("chapter"), F.explode("c.verse").alias("v"))
    return v.select("book", "chapter", F.col("v._number").alias("verse"), F.trim(F.regexp_replace("v._VALUE", r"\s+", " ")).alias("text"))


def tagged_tsv(lines: DataFrame, letter: str) -> DataFrame:
    """``(book, chapter, verse, tokens)`` of lines with ``Abbr.chapter.verse`` and tokens such as G2316, comments apart."""
    kept = lines.where(~F.col("value").rlike(r"^\s*(?:#|==|$)"))
    at = lambda k: F.regexp_extract("value", r"\b([1-3]?[A-Z][A-Za-z]{1,3})\.(\d{1,3})\.(\d{1,3})\b", k)
    tokens = F.regexp_extract_all("value", F.lit(rf"\b({letter}\d{{4,5}})"), 1)
    rows = kept.select(at(1).alias("book"), at(2).alias("chapter"), at(3).alias("verse"), F.explode(tokens).alias("t")).where("book <> ''")
    return rows.groupBy("book", F.col("chapter").cast("int").alias("chapter"), F.col("verse").cast("int").alias("verse")).agg(F.array_sort(F.collect_set("t")).alias("tokens"))


def csv(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """RFC 4180 with a header; a missing column is an error before anything is used."""
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def listing_md(lines: DataFrame, id_pattern: str = r"^(\d{2}-\d{4}[A-Z]?)\s*$", window: int = 8) -> DataFrame:
    """Entries of a scraped listing: an id line, then title, place and duration, and links within ``window`` lines.

    ``lines`` has ``doc, pos, value``.
    """
    w = Window.partitionBy("doc").orderBy("pos")
    ahead = [F.lead("value", k).over(w) for k in range(1, window + 1)]
    rows = lines.withColumn("next", F.array(*ahead)).withColumn("id", F.regexp_extract("value", id_pattern, 1)).where("id <> ''")
    link = F.regexp_extract(F.array_join("next", "\n"), r"\((https?://[^)\s]+\.pdf)\)", 1)
    minutes = F.regexp_extract(F.array_join("next", "\n"), r"(\d+) min", 1)
    title = F.trim(F.regexp_replace(F.col("next")[0], F.concat(F.lit("^"), F.col("id"), F.lit(r"\s*")), F.lit("")))
    return rows.select("doc", "id", title.alias("title"), F.col("next")[1].alias("location"), F.nullif(minutes, F.lit("")).cast("int").alias("minutes"), F.nullif(link, F.lit("")).alias("pdf_url"))


def url_list(links: DataFrame, col: str) -> DataFrame:
    """Distinct PDF addresses with the host in one form and the date that the file name says."""
    u = F.regexp_replace(F.trim(F.col(col)), r"^https?://(?:www\.)?", "https://")
    return links.select(u.alias("url")).where(F.lower("url").endswith(".pdf")).distinct().withColumn("date", tx.date_from_name(F.regexp_extract("url", r"([^/]+)$", 1)))


def frontier(pages: DataFrame, start: str) -> DataFrame:
    """Pages ``(url, depth)`` reached from ``start`` over the links of stored pages ``(url, links)``; no fetching.

    One round for each depth, until a round finds nothing new.
    """
    from ..shared import drop_table, write_table

    spark = pages.sparkSession
    edges = write_table(pages.select("url", F.explode("links").alias("to")).distinct(), "links")
    seen = write_table(spark.createDataFrame([(start, 0)], "url string, depth int"), "seen")
    k = 0
    while True:
        k += 1
        last = seen.where(F.col("depth") == k - 1)
        new = edges.join(last.select("url"), "url", "left_semi").select(F.col("to").alias("url")).distinct().join(pages.select("url").distinct(), "url", "left_semi").join(seen.select("url"), "url", "left_anti")
        new = write_table(new.withColumn("depth", F.lit(k)), "found")
        if new.isEmpty():
            drop_table(edges, new)
            return seen
        more = write_table(seen.unionByName(new), "seen")
        drop_table(seen, new)
        seen = more


def crawl_json(df: DataFrame, host: str) -> DataFrame:
    """One row for each path of a host: title from the first heading, year from the path or the text."""
    path = F.regexp_replace(F.parse_url("url", F.lit("PATH")), "/+$", "")
    rows = df.where(F.regexp_replace(F.parse_url("url", F.lit("HOST")), "^www\\.", "") == host).select(path.alias("path"), "url", "text")
    w = Window.partitionBy("path").orderBy("url")
    year = F.coalesce(F.nullif(F.regexp_extract("path", r"\b((?:19|20)\d{2})\b", 1), F.lit("")), F.nullif(F.regexp_extract("text", r"\b((?:19|20)\d{2})\b", 1), F.lit("")))
    return rows.withColumn("r", F.row_number().over(w)).where("r = 1").select("path", "url", F.nullif(F.regexp_extract("text", r"(?m)^#\s+(.+)$", 1), F.lit("")).alias("title"), year.cast("int").alias("year"))


def all_years(df: DataFrame, col: str) -> DataFrame:
    """Rows of ``{year: [rows]}`` JSON, one for each id."""
    rows = df.select(F.explode(F.from_json(col, "map<string,array<struct<id:string,title:string>>>")).alias("year", "rows")).select(F.col("year").cast("int").alias("year"), F.explode("rows").alias("r")).select("year", "r.*")
    w = Window.partitionBy("id").orderBy("year")
    return rows.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def html_listing(df: DataFrame, col: str, marker: str = 'class="messagebox"') -> DataFrame:
    """Id and place of each box of a listing page."""
    boxes = df.select(F.posexplode(F.split(F.col(col), re.escape(marker))).alias("k", "box")).where("k > 0")
    return boxes.select(F.regexp_extract("box", r"(\d{2}-\d{4}[A-Z]?)", 1).alias("id"), F.trim(F.regexp_extract("box", r"<(?:span|div)[^>]*class=\"location\"[^>]*>([^<]+)<", 1)).alias("location")).where("id <> ''")


def binary_hash(spark: SparkSession, folder: str, pattern: str = "*.{pdf,docx}") -> DataFrame:
    """Size and SHA-1 of the bytes of all matching files."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return df.select("path", F.col("length").alias("size"), F.sha1("content").alias("hash"))


def _halves(content: bytes) -> tuple[bytes, bytes]:
    """Two parts, cut behind a blank before the middle if there is one, never inside a character."""
    mid = len(content) // 2
    cut = max(content.rfind(b" ", 0, mid), content.rfind(b"\n", 0, mid)) + 1 or mid
    while 0 < cut < len(content) and content[cut] & 0xC0 == 0x80:
        cut -= 1
    return content[:cut], content[cut:]


def with_retry(convert: Callable[[bytes], str], content: bytes, depth: int) -> str:
    """The converted text; if the converter fails, that of both halves, ``depth`` times over."""
    try:
        return convert(content)
    except Exception:
        parts = _halves(content)
        if not depth or not all(parts):
            raise
        return "".join(with_retry(convert, p, depth - 1) for p in parts)


def plugin(files: DataFrame, convert: Callable[[bytes], str], retries: int = 0) -> DataFrame:
    """``(path, text, error)`` of binary files through a converter given by the caller (PDF, OCR, DOCX, a model).

    A file that the converter fails on is tried again in ever smaller halves, ``retries`` times over; if that fails
    too, it gives the message instead of a text.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for path, content in zip(pdf.path, pdf.content):
                try:
                    out.append((path, with_retry(convert, bytes(content), retries), None))
                except Exception as e:
                    out.append((path, None, str(e)))
            yield pd.DataFrame(out, columns=["path", "text", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, error string")


_WORD_NS = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def docx_text(content: bytes) -> str:
    """Text of a DOCX file: one line for each paragraph, tabs and breaks kept, ``_xHHHH_`` escapes decoded."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    lines = []
    for p in root.iter(f"{_WORD_NS}p"):
        now = []
        for x in p.iter():
            if x.tag == f"{_WORD_NS}t":
                now.append(x.text or "")
            elif x.tag in (f"{_WORD_NS}tab", f"{_WORD_NS}br"):
                now.append("\t" if x.tag.endswith("tab") else "\n")
        lines.append("".join(now))
    return re.sub(r"_x([0-9A-F]{4})_", lambda m: chr(int(m[1], 16)), "\n".join(lines))


def docx_file(text: str) -> bytes:
    """The least DOCX file that holds a text, a paragraph for each line."""
    escaped = re.sub(r"_(?=x[0-9A-F]{4}_)", "_x005F_", text)
    escaped = re.sub("[\x00-\x08\x0b-\x1f\ufffe\uffff]", lambda m: f"_x{ord(m[0]):04X}_", escaped)
    body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{html.escape(x, False)}</w:t></w:r></w:p>' for x in escaped.split("\n"))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("word/document.xml", f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="{_WORD_NS[1:-1]}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def booklet_order(pages: int) -> list[tuple[int, int]]:
    """Left and right page of each printed side of a folded booklet of ``pages`` pages (a multiple of four)."""
    sides = []
    for k in range(pages // 2):
        outer, inner = pages - k, k + 1
        sides.append((outer, inner) if k % 2 == 0 else (inner, outer))
    return sides


def llm_answers(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Usable answers, and those with an error or without a cleaned text."""
    df = read_json(spark, folder, schemas.LLM_ANSWER).withColumn("file", F.col("_metadata.file_path"))
    good = F.col("_error").isNull() & F.col("_parse_error").isNull() & F.col("cleaned_markdown").isNotNull()
    return df.where(good), df.where(~good)


def redirects(lines: DataFrame) -> DataFrame:
    """``(pattern, target)`` of lines ``from to 301``; a ``:name`` stands for one segment."""
    parts = F.split(F.trim("value"), r"\s+")
    rows = lines.where(F.col("value").rlike(r"^\s*/\S*\s+\S+\s+30[128]\s*$"))
    return rows.select(F.concat(F.lit("^"), F.regexp_replace(parts[0], r":[a-z]+", "([^/]+)"), F.lit("/?$")).alias("pattern"), F.regexp_replace(parts[1], r":[a-z]+", r"\$1").alias("target"))


def pdf_links(posts: DataFrame, id_col: str, body_col: str) -> DataFrame:
    """``(url, posts)``: every PDF address once, with the sorted ids of the posts that hold it."""
    found = posts.select(F.col(id_col).alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(body_col, F.lit(r"(https?://[^\s)\"'<>]+\.pdf)"), 1))).alias("url"))
    return found.groupBy("url").agg(F.array_sort(F.collect_set("id")).alias("posts"))
