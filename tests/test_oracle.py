"""Every registered query against its SQL oracle (DuckDB) at sf0.001: exact rows."""

import math

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from affinity.plans.catalog import QUERIES

# The training-data queries have tests of their own in tests/llm.
KEYS = sorted(QUERIES)

# No all-pairs joins and no Python evaluation anywhere in a registered query.
FORBIDDEN_PLAN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        out.append(tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order))
    return sorted(out, key=repr)


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) > 0
    assert _norm(got, df.columns) == _norm(want, rel.columns)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN_PLAN_NODES:
        assert bad not in plan, f"{key}: {bad} in plan"
