"""Physical-plan checks: pruning, pushdown, group limits, no cartesian products."""

from conftest import SF_SMALL

from affinity.operators import build_item_item_graph
from affinity.params import PARAMS_T
from affinity.plans import pipelines
from affinity.sources import signals_tpch, source_items


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_needed_columns(spark):
    p = plan(signals_tpch(spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_returnflag:string>" in p
    assert "l_extendedprice" not in p


def test_filter_pushed_to_scan(spark):
    p = plan(source_items(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(p_size), LessThanOrEqual(p_size,25)]" in p


def test_per_user_cap_uses_partial_group_limit(spark):
    links, _ = build_item_item_graph(signals_tpch(spark, SF_SMALL), 0.5, 0.25, 50)
    p = plan(links)
    assert "WindowGroupLimit" in p
    assert "Partial" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_path_search_reads_staged_graph(spark):
    recs = pipelines.item_item_recs(signals_tpch(spark, SF_SMALL), PARAMS_T.with_(initial_nhood_size=3))
    p = plan(recs)
    assert "nhood_graph" in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
