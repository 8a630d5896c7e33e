import pytest
from conftest import SMALL, assert_same

from talespan.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert_same(registry.QUERIES[name](spark, SMALL), duck, registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_gives_rows(spark, name):
    rows = registry.QUERIES[name](spark, SMALL).count()
    assert rows > 0 or name == "topdown_bfs"  # on the smallest tables no narrower concept is matched


def test_flagship(spark):
    rows = registry.flagship(spark, SMALL)
    assert rows.count() > 0 and "matched_concepts" in rows.columns


def test_entry_without_llm(monkeypatch):
    import __spark_entry__ as e

    monkeypatch.setattr(e, "_HAS_LLM", False)
    assert set(e.queries()) == set(registry.QUERIES) and set(e.oracle_sql()) == set(registry.ORACLES)
