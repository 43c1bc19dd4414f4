"""Queries ``pN_...`` of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import canonical, components, encoding, entities, junk, mixing, names, neardup, scans, survivors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of markdown rows whose bodies are similar."""
    members, links = neardup.near_duplicates(_table(spark, sf_dir, "markdown"), "md_id", "body", threshold=0.6, width=3, least_words=30)
    return neardup.expand(members, links).select(F.col("id_a").alias("md_id_a"), F.col("id_b").alias("md_id_b"))


def plain_path(path: str) -> Column:
    """A path without surrounding blanks, a leading ``markdown/`` and a trailing ``.md``."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.col(path)), "^markdown/", ""), r"\.md$", "")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of each record that is linked to another one."""
    pairs = _table(spark, sf_dir, "mevar_duplicates").select(plain_path("record_id").alias("a"), plain_path("duplicate_of").alias("b"))
    return components.connected_groups(pairs, "a", "b").select(F.col("record").alias("record_id"), F.col("group").alias("group_id"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of spellings of one person or place."""
    m = _table(spark, sf_dir, "markdown")
    persons = m.select(F.explode("persons").alias("x")).unionByName(m.select(F.col("preacher").alias("x")))
    places = m.select(F.explode("places").alias("x"))
    found = names.linked(names.person_entities(names.distinct_names(persons, "x"))).withColumn("kind", F.lit("person"))
    found = found.unionByName(names.linked(names.place_entities(names.distinct_names(places, "x"))).withColumn("kind", F.lit("place")))
    return found.select("kind", "name_a", "name_b")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles and bodies written with other characters than they seem to be."""
    return canonical.disguised(_table(spark, sf_dir, "markdown"), "md_id", ["title", "body"]).select(F.col("id").alias("md_id"), "field")


def p5_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries and the sermons they summarise, with the confidence of each match."""
    m = _table(spark, sf_dir, "markdown")
    fields = ["title", "subtitle", "date", "location", "preacher"]
    sides = [entities.latest(m.where(F.col("source") == s), "path", fields, "ingested_at").withColumnRenamed("date", "day") for s in ("le-scribe", "sermons-en")]
    known = m.where("source = 'le-scribe' and original like 'sermons-en/%'").select(F.col("path").alias("a"), F.col("original").alias("b")).distinct()
    return entities.match(sides[0], sides[1], known)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries and the sermons they summarise."""
    return p5_matches(spark, sf_dir).select("path_a", "path_b")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one best row of each group that has one."""
    standing = survivors.standings(_table(spark, sf_dir, "markdown"), _table(spark, sf_dir, "sources"))
    return survivors.tops(standing).select("group_key", F.col("id").alias("md_id"))


def p6_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record built field by field for each group."""
    fields = ["status", "location", "preacher", "title", "date"]
    built = survivors.golden(_table(spark, sf_dir, "markdown"), _table(spark, sf_dir, "sources"), fields)
    return built.select("group_key", F.col("id").alias("md_id"), *fields)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page furniture, broken words and misread words of scanned bodies."""
    lines, _ = scans.scanned_lines(_table(spark, sf_dir, "markdown"))
    return lines.select(F.col("id").alias("md_id"), "line_no", "kind")


def p7_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned bodies as continuous paragraphs."""
    return scans.repaired(_table(spark, sf_dir, "markdown")).select(F.col("id").alias("md_id"), "text")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return encoding.token_ids(_table(spark, sf_dir, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id"), "ids")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    used, _ = mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))
    return used.withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares that the sources reach in the mix."""
    return mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "mix_targets"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of which more than half of the words are junk."""
    return junk.junk_shares(_table(spark, sf_dir, "documents"), "doc_id", "text", "lang").where("share > 0.5").select(F.col("id").alias("doc_id"))


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p5_found": p5_found,
    "p5_matches": p5_matches,
    "p6_found": p6_found,
    "p6_golden": p6_golden,
    "p7_found": p7_found,
    "p7_text": p7_text,
    "p8_ids": p8_ids,
    "p9_mix": p9_mix,
    "p9_shares": p9_shares,
    "p10_found": p10_found,
}

ORACLES: dict[str, str] = {
    "p1_found": """
        WITH w AS (SELECT md_id, regexp_extract_all(strip_accents(lower(body)), '[a-z0-9]+') AS w FROM markdown WHERE body IS NOT NULL),
        i AS (SELECT DISTINCT md_id, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] AS s
              FROM (SELECT md_id, w, unnest(range(1, len(w) - 1)) AS k FROM w WHERE len(w) >= 30)),
        n AS (SELECT md_id, count(*) AS n FROM i GROUP BY 1),
        p AS (SELECT a.md_id AS md_id_a, b.md_id AS md_id_b, count(*) AS c FROM i a JOIN i b ON a.s = b.s AND a.md_id < b.md_id GROUP BY 1, 2)
        SELECT md_id_a, md_id_b FROM p JOIN n x ON x.md_id = md_id_a JOIN n y ON y.md_id = md_id_b
        WHERE 5 * c >= 3 * (x.n + y.n - c)""",
    "p6_found": """
        WITH r AS (
          SELECT coalesce(m.duplicate_of, m.path) AS group_key, m.md_id,
                 coalesce((length(title) > 0)::INT, 0) + coalesce((length(subtitle) > 0)::INT, 0) + coalesce((length(date) > 0)::INT, 0)
                 + coalesce((length(location) > 0)::INT, 0) + coalesce((length(preacher) > 0)::INT, 0) + coalesce((length(summary) > 0)::INT, 0)
                 + coalesce((len(tags) > 0)::INT, 0) + coalesce((len(persons) > 0)::INT, 0) + coalesce((len(places) > 0)::INT, 0)
                 + coalesce((len(bible_refs) > 0)::INT, 0) AS f,
                 coalesce(editorial_pass, '') AS e, coalesce(s.trust, 2147483647) AS t
          FROM markdown m LEFT JOIN sources s USING (source)),
        b AS (SELECT group_key, max(f) AS f, max(e) AS e, min(t) AS t FROM r GROUP BY 1 HAVING count(*) > 1)
        SELECT r.group_key, min(md_id) AS md_id
        FROM r JOIN b ON r.group_key = b.group_key AND r.f = b.f AND r.e = b.e AND r.t = b.t
        GROUP BY 1 HAVING count(*) = 1""",
    "p2_found": r"""
        WITH RECURSIVE p AS (
          SELECT regexp_replace(regexp_replace(trim(record_id), '^markdown/', ''), '\.md$', '') AS a,
                 regexp_replace(regexp_replace(trim(duplicate_of), '^markdown/', ''), '\.md$', '') AS b FROM mevar_duplicates),
        e AS (SELECT a, b FROM p WHERE a <> b UNION SELECT b, a FROM p WHERE a <> b),
        c(v, w) AS (SELECT a, a FROM e UNION SELECT c.v, e.b FROM c JOIN e ON c.w = e.a)
        SELECT v AS record_id, min(w) AS group_id FROM c GROUP BY 1""",
}
