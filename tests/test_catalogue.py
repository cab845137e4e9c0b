"""Every catalogued query against the SQL that says the same."""

import pytest

from folioforge.plans import QUERIES, SQL


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    clean = lambda x: round(x, 7) + 0.0 if isinstance(x, float) else str(x) if hasattr(x, "isoformat") else x
    return sorted(cols), sorted((tuple(clean(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    found = duck.execute(SQL[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([d[0] for d in found.description], found.fetchall())


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)
