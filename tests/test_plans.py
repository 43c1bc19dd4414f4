"""What the plans must look like whatever the data: pruned scans, pushed filters, no products of tables."""

import re

import pytest

from scriptorium.plans import catalogue

from .conftest import DATA

# queries that run jobs of their own while they are built
BUSY = {"src_crawl", "join_cooccur_edges", "src_walk_md", "src_bible_xml", "src_csv", "src_llm_cache", "sink_jsonl", "sink_partitioned_by_year"}
# one row beside a table: totals of the whole
SINGLE_ROWS = {"q11_nearest_approximate", "dq_idempotent", "agg_count_all", "q1_totals", "agg_max_global", "s8_bible"}


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    return catalogue.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - BUSY))
def test_no_products(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text
    if name not in SINGLE_ROWS:
        assert text.count("BroadcastNestedLoopJoin") <= 1 and ("BroadcastNestedLoopJoin" not in text or "fts" in name or name in ("q12_ranked", "q13_hybrid", "vec_hybrid"))


@pytest.mark.parametrize("name,pushed", [("filt_eq_null", "EqualTo(year,1965)"), ("filt_acl", "EqualTo(user_id,42)"), ("q24_verse", "EqualTo(book,Jean)"), ("filt_in_list", "In(source, [cmpp,onedrive])"), ("src_db_scan", "EqualTo(source,cmpp)")])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


@pytest.mark.parametrize("name", ["agg_group_expr", "filt_visible", "win_nth", "q14_of_year", "s4_authors", "join_self_ref", "sink_index"])
def test_bodies_are_not_read(spark, name):
    schemas = re.findall(r"ReadSchema: struct<([^\n]*)>", plan(spark, name))
    assert schemas and not any("body:" in s for s in schemas)


# what is made of a whole text, and how often the plan says it (norm.words says its text three times); more often, or
# inside a lambda over the words, it is made for each word
SAID = {"agg_doc_freq": {"[^a-zà-ÿ']+": 1, "lorsqu|puisqu": 1}, "tok_shingles": {"[^a-z0-9]+": 3}, "tok_ngrams": {"lorsqu|puisqu": 1}}


@pytest.mark.parametrize("name", sorted(SAID))
def test_words_are_made_once(spark, name):
    text = plan(spark, name)
    assert {x: text.count(x) for x in SAID[name]} == SAID[name]


def test_phrases_fold_a_text_once(spark):
    """A text that is said again inside an expression over its words is folded again."""
    assert plan(spark, "tok_ngrams").count(r"\p{Mn}+") == 1
