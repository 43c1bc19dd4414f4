"""The ``pN_`` queries over the smallest tables: columns as defined, rows as SQL has them where it can."""

import re

import pytest

from scriptorium.llm import queries as Q

from ..conftest import DATA

COLUMNS = {
    "p1_found": [("md_id_a", "bigint"), ("md_id_b", "bigint")],
    "p2_found": [("record_id", "string"), ("group_id", "string")],
    "p3_found": [("kind", "string"), ("name_a", "string"), ("name_b", "string")],
    "p4_found": [("md_id", "bigint"), ("field", "string")],
    "p5_found": [("path_a", "string"), ("path_b", "string")],
    "p6_found": [("group_key", "string"), ("md_id", "bigint")],
    "p7_found": [("md_id", "bigint"), ("line_no", "int"), ("kind", "string")],
    "p8_ids": [("doc_id", "bigint"), ("ids", "array<int>")],
    "p10_found": [("doc_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, duck, name):
    df = Q.QUERIES[name](spark, DATA)
    rows = [tuple(map(str, r)) for r in df.collect()]
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
        assert len(rows) == len(set(rows)) and rows
    if name in Q.ORACLES:
        assert sorted(rows) == sorted(tuple(map(str, r)) for r in duck.execute(Q.ORACLES[name]).fetchall())
    if name == "p1_found":
        assert all(int(a) < int(b) for a, b in rows)
    if name == "p3_found":
        assert all(a.encode() < b.encode() for _, a, b in rows) and {k for k, _, _ in rows} <= {"person", "place"}
    if name == "p5_found":
        assert all(a.startswith("le-scribe/") and b.startswith("sermons-en/") for a, b in rows)
        assert len({a for a, _ in rows}) == len(rows) == len({b for _, b in rows})
    if name == "p7_found":
        assert {k for _, _, k in rows} <= {"header", "page_no", "break", "misread"}


def test_every_document_has_ids(spark, duck):
    ids = {r.doc_id: r.ids for r in Q.p8_ids(spark, DATA).collect()}
    assert len(ids) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]


def test_survivors_do_not_read_bodies(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = Q.p6_found(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any("body:" in s for s in re.findall(r"ReadSchema: struct<([^\n]*)>", plan))
