"""Every registered query against its SQL on the same tables, value by value."""

import oracle
import pytest

from zonewise.plans import all_queries

QUERIES = {q.name: q for q in all_queries()}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.oracle])
def test_matches_sql(spark, sf_dir, connection, name):
    query = QUERIES[name]
    assert oracle.difference(query.build(spark, sf_dir), connection, query.oracle) is None


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.oracle])
def test_returns_rows(spark, sf_dir, name):
    assert QUERIES[name].build(spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) < set(entry.queries())


def test_plans_have_no_cross_join_and_push_filters(spark, sf_dir):
    for name in ("zone_score_daily", "worker_asof_aqi", "zone_features", "aqi_range_join", "latitude_bins"):
        plan = QUERIES[name].build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "PushedFilters: [" in plan and "PushedFilters: []" not in plan, name
        assert "Python" not in plan, name
