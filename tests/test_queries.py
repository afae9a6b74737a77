"""Every registered query against its SQL twin, and what their plans may contain."""

import pytest
from compare import difference, open_duckdb

from __spark_entry__ import entry, oracle_sql, queries
from registry.learned import LEARNED
from registry.oracle import ORACLE
from registry.queries import QUERIES

# The queries of the llm subpackage have tests of their own.
NAMES = sorted(set(QUERIES) - set(LEARNED))


@pytest.fixture(scope="module")
def duck(sf_dir):
    return open_duckdb(sf_dir)


def test_every_query_has_a_twin():
    assert set(NAMES) == set(ORACLE)
    assert set(NAMES) <= set(queries()) and set(NAMES) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sf_dir, duck, name):
    rows, differs = difference(queries()[name](spark, sf_dir), duck, oracle_sql()[name])
    assert differs is None
    assert rows > 0


def test_entry_returns_rows(spark):
    df = entry(spark)
    assert "published_at_formatted" in df.columns
    assert 0 < df.count() <= 10


EAGER = {"A41_incremental_ingest", "A42_curation_run"}


@pytest.mark.parametrize("name", sorted(LEARNED))
def test_learned_queries_repeat(spark, sf_dir, name):
    first, second = (sorted(QUERIES[name](spark, sf_dir).collect()) for _ in range(2))
    assert first == second and first


@pytest.mark.parametrize("name", [n for n in NAMES if n not in EAGER])
def test_plan_stays_in_the_engine(spark, sf_dir, name):
    """No nested-loop or cartesian join, no Python worker in any registered query."""
    plan = queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert node not in plan


def _plan(spark, sf_dir, name):
    return queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["A06_inserted_sample", "A26_summary_queue", "A27_digest_candidates"])
def test_limits_are_top_k(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in _plan(spark, sf_dir, name)


def test_counts_read_no_text(spark, sf_dir):
    plan = _plan(spark, sf_dir, "A34_relevance_stats")
    assert "text" not in plan


def test_resolving_attempts_needs_one_shuffle(spark, sf_dir):
    plan = _plan(spark, sf_dir, "A38_resolved_attempts")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan
