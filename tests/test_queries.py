"""Every query of the library's own operators on the smallest tables, against its SQL where there is one."""

import math

import pytest

from scriptorium.plans import catalogue

from .conftest import DATA


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(repr([plain(r[k]) for k in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    got = df.collect()
    assert len(set(df.columns)) == len(df.columns)
    if name in catalogue.ORACLES:
        r = duck.execute(catalogue.ORACLES[name])
        columns = [d[0] for d in r.description]
        assert sorted(columns) == sorted(df.columns)
        assert rows_of(df.columns, got) == rows_of(columns, r.fetchall())


def test_every_oracle_has_a_query():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)
