"""Every core query against its SQL on whole tables; the others must at least give rows of a stable schema."""

from __future__ import annotations

import pytest

from rolemill.plans import catalog
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, data, con, name):
    if name in catalog.SQL:
        assert compare(spark, catalog.QUERIES[name], catalog.SQL[name], data, con) == ""
    else:
        df = catalog.QUERIES[name](spark, data)
        assert len(df.columns) == len(set(df.columns)) and df.count() >= 0


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES) and catalog.FLAGSHIP in catalog.QUERIES


def test_entry_without_the_subpackage(monkeypatch):
    import __spark_entry__ as e

    monkeypatch.setattr(e, "_llm", lambda: None)
    assert set(e.queries()) == set(catalog.QUERIES)
    assert set(e.oracle_sql()) == set(catalog.SQL)
