"""Integer keys of the signals stay integers until items are numbered, and pruned links are ranked once for the paths."""

import pytest
from pyspark.sql import functions as F

from affinity.operators import adjust_item_item_graph_weight, build_item_item_graph, graph, init_shortest_paths
from affinity.params import RecParams
from affinity.plans import catalog, pipelines
from affinity.session import temporary_stages

from conftest import SF_SMALL

COLS = ["item_A", "item_B", "weight_units", "link_data"]
P = RecParams(max_links_per_user=6, initial_nhood_size=3)


def signals(spark, keys):
    """Of many equal weights, so that the cap's ties decide; -7, 9, 80 and 700 are in another order as strings."""
    i = F.col("id")
    item = F.when(i % 11 == 0, -7).when(i % 5 == 0, 9).when(i % 7 == 0, 80).otherwise(F.pmod(F.hash("id"), F.lit(700)))
    return spark.range(0, 900, 1, 4).select(
        (i % 60).cast(keys).alias("user"),
        F.when(i % 97 > 0, item).cast(keys).alias("item"),
        F.when(i % 13 == 0, None).otherwise(1.0).alias("weight"),
        F.concat(F.lit("t"), (i % 3).cast("string")).alias("signal_type"),
    )


def rows(df):
    if "link_data" in df.columns:
        df = df.withColumn("link_data", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("link_data")))))
    return sorted(map(tuple, df.select(*[c for c in COLS if c in df.columns]).collect()))


@pytest.mark.parametrize("keys", ["bigint", "int"])
def test_integer_keys_have_the_links_of_their_strings(spark, monkeypatch, keys):
    for detail in (False, True):
        want = rows(build_item_item_graph(signals(spark, "string"), 0.5, 0.25, 6, detail, stage=False)[0])
        assert len(want) > 100 and all(isinstance(r[0], str) for r in want)
        plain, _ = build_item_item_graph(signals(spark, keys), 0.5, 0.25, 6, detail, stage=False)
        assert rows(plain) == want
        for recur in (True, False):
            monkeypatch.setattr(graph, "_pairs_recur", lambda *_, r=recur: r)
            with temporary_stages(spark):
                assert rows(build_item_item_graph(signals(spark, keys), 0.5, 0.25, 6, detail, stage_links=True)[0]) == want
        monkeypatch.undo()


def test_outside_items_that_are_no_integers(spark):
    outside = spark.createDataFrame(
        [("9", "007", 50.0), ("007", "9", 1.0), ("x", "80", 1.0), ("80", "x", 1.0), ("7.0", "-7", 2.0)], "item_A string, item_B string, weight double"
    )
    found = []
    for keys in ("string", "bigint"):
        with temporary_stages(spark):
            recs = pipelines.item_item_recs_add_signals(signals(spark, keys), outside, P)
            found.append(sorted(map(tuple, recs.collect())))
    assert found[0] == found[1] and {"007", "x"} <= {r[1] for r in found[0]}


def test_no_string_key_and_no_unused_weight_is_shuffled(spark, monkeypatch):
    plans, staged, types = {}, graph.write_stage, {}

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        types[name] = {f.name: f.dataType.simpleString() for f in df.schema}
        return staged(df, name)

    monkeypatch.setattr(graph, "write_stage", seen)
    monkeypatch.setattr("affinity.session.write_stage", seen)
    # Too few pairs here for stripes otherwise.
    monkeypatch.setattr(graph, "_pairs_recur", lambda *_: False)
    with temporary_stages(spark):
        catalog.q_available_path_recs(spark, SF_SMALL)
    assert types["user_items"] == {"user": "bigint", "item": "bigint", "weight_units": "bigint"}
    lines = plans["link_sums"].split("\n")
    at = next(n for n, line in enumerate(lines) if "Exchange hashpartitioning(user#" in line)
    below = next(line for line in lines[at + 1 :] if "Project [" in line)
    below = below.split("Project [")[1].split("]")[0].split(", ")
    assert sorted(c.split("#")[0] for c in below) == ["item_id", "user", "weight_units"]
    # An item's own weight does not go beside its list: the list has the pairs' weights.
    with temporary_stages(spark):
        capped = spark.createDataFrame([("u", 1, 5), ("u", 2, 3), ("u", 3, 5)], "user string, item_id long, weight_units long")
        stripes = graph.user_item_stripes(capped, 24)
        assert "weight_units" not in stripes.columns
        got = graph.stripe_pairs(stripes, 2).select("item_A", "item_B", "weight_units").collect()
        assert sorted(map(tuple, got)) == [(1, 2, 3), (1, 3, 5), (2, 3, 3)]


def test_paths_rank_the_links_once(spark):
    with temporary_stages(spark) as scope:
        g = pipelines.staged_graph(signals(spark, "string"), P)
        links = adjust_item_item_graph_weight(g.links, g.weights, 4.0)
        dest = spark.createDataFrame([(i,) for i in range(0, 90, 2)], "item long")
        want = [sorted(map(str, df.collect())) for df in init_shortest_paths(links, 3, None, dest)]
        got = init_shortest_paths(links, 3, None, dest, stage_graph=True)
        assert [sorted(map(str, df.collect())) for df in got] == want and len(want[1]) > 50
        assert [p for p in scope.paths if "/nhood_graph-" in p]
        assert "Window" not in got[1]._jdf.queryExecution().optimizedPlan().toString()
