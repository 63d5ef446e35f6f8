import re

import duckdb
import pytest

import __spark_entry__ as contract
from checks.compare import compare, duck

ORACLES = sorted(set(contract.oracle_sql()) - {"dbscan"})


@pytest.fixture(scope="module")
def con(sf) -> duckdb.DuckDBPyConnection:
    return duck(sf)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, con, sf, name):
    ok, text = compare(spark, con, name, sf)
    assert ok, text


def test_entry(spark):
    assert contract.entry(spark).columns == ["rfm_segment", "customers", "revenue"]


def test_every_sql_belongs_to_a_query():
    from checks.oracle import SQL

    assert set(SQL) <= set(contract.queries())


def plan(spark, sf, name):
    return contract.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["rfm_segments", "abc", "inventory_reco", "churn_enriched", "drift_churn", "weight_sweep"])
def test_plans_have_no_cross_join_or_python(spark, sf, name):
    text = plan(spark, sf, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in text


@pytest.mark.parametrize("name", ["rfm_scores", "abc", "precision_curve", "roc_curve"])
def test_whole_table_orders_never_meet_in_one_task(spark, sf, name):
    """A single-partition window may only see range totals (``_t_`` columns)."""
    lines = plan(spark, sf, name).splitlines()
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line) and not re.search(r"windowspecdefinition\((_range|metric)#", line):
            assert "_t_" in line, line


def test_scans_are_pruned_and_filtered(spark, sf):
    text = plan(spark, sf, "abc")
    assert re.search(r"PushedFilters: \[.*EqualTo\(is_sale,true\)|PushedFilters: \[.*is_sale", text)
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert "description" not in schema and "invoice" not in schema
