"""Pairs are shuffled as one row an item of a user, and links are joined to their items in one direction."""

import re

from pyspark.sql import functions as F

from affinity.operators import adjust_item_item_graph_weight, build_item_item_graph, graph, id_graph
from affinity.session import temporary_stages, write_rows

COLS = ["item_A", "item_B", "weight_units", "link_data"]


def signals(spark, users=50, each=14, items=90, types=3):
    i = F.col("id")
    return spark.range(0, users * each, 1, 4).select(
        F.concat(F.lit("u"), (i % users).cast("string")).alias("user"),
        # One item that every user has.
        F.when(i < users, "hot").otherwise(F.concat(F.lit("i"), (F.hash("id") % items).cast("string"))).alias("item"),
        F.when(i % 7 == 0, -0.5).otherwise((1 + i % 2).cast("double")).alias("weight"),
        F.concat(F.lit("t"), (i % types).cast("string")).alias("signal_type"),
    )


def rows(df):
    if "link_data" in df.columns:
        df = df.withColumn("link_data", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("link_data")))))
    return sorted(map(tuple, df.select(*[c for c in COLS if c in df.columns]).collect()))


def test_stripes_have_the_links_of_plain_pairs(spark, monkeypatch):
    for detail in (False, True):
        want = rows(build_item_item_graph(signals(spark), 0.5, 0.25, 10, detail, stage=False)[0])
        assert len(want) > 500
        # The last one deals the pairs of every item with 3 or more users to several tasks.
        for recur, per_item in ((True, 1 << 20), (False, 1 << 20), (False, 20)):
            monkeypatch.setattr(graph, "_pairs_recur", lambda *_, r=recur: r)
            monkeypatch.setattr(graph, "PAIRS_PER_ITEM", per_item)
            with temporary_stages(spark):
                assert rows(build_item_item_graph(signals(spark), 0.5, 0.25, 10, detail, stage_links=True)[0]) == want
        monkeypatch.undo()


def test_no_pair_is_shuffled_by_itself(spark, monkeypatch):
    plans = []
    staged = graph.write_stage

    def seen(df, name):
        if name == "link_sums":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, name)

    monkeypatch.setattr(graph, "write_stage", seen)
    with temporary_stages(spark):
        for detail in (False, True):
            ui = write_rows(graph.aggregate_user_items(signals(spark, items=2000), 0.5, detail), "user_items")
            id_graph(ui, 0.25, 10, detail, stage_links=True)
    for plan in plans:
        keys = re.findall(r"hashpartitioning\((.*?), \d+\)", plan)
        assert any(re.match(r"item_A#\d+$", k) for k in keys), keys
        assert not any("item_B" in k or "__pair" in k for k in keys), keys
    assert len(plans) == 2


def test_pairs_that_recur_are_summed_before_the_shuffle(spark):
    ui = signals(spark, users=400, each=40)
    assert graph._pairs_recur(ui, 5, 4, 10) and not graph._pairs_recur(ui, 5000, 4, 10)


def test_named_links_carry_the_weight_of_their_target(spark):
    for detail in (False, True):
        with temporary_stages(spark):
            g = id_graph(graph.aggregate_user_items(signals(spark), 0.5, detail), 0.25, 10, detail, stage_links=True)
            links, weights = graph._decode(g.links, g.items), g.weights.withColumnRenamed("item", "item_id")
            weights = weights.join(g.items, "item_id").drop("item_id")
            want = adjust_item_item_graph_weight(links, weights, 4.0, "SQRT")
            got = adjust_item_item_graph_weight(g.named, None, 4.0, "SQRT")
            assert got.columns == want.columns
            text = lambda df: sorted(str(r) for r in df.drop("link_data").collect())
            assert text(got) == text(want) and got.count() > 500
            # One direction of each link goes through the joins, and no third one follows them.
            plan = got._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("Join ") == 2 and plan.index("Generate ") < plan.index("Join ")


def test_ids_lie_in_as_few_bytes_as_they_need(spark):
    small = [0, 1, 0x7FFF, 0x8000, 0xFFFF, 0x10000, 0x7FFFFF, 0x800000, (1 << 24) - 1]
    for bits, size, ids in ((24, 3, small), (25, 4, [*small, 1 << 24]), (31, 4, [*small, (1 << 31) - 1]), (40, 8, [*small, 1 << 39])):
        capped = spark.createDataFrame([("u", i, 1 + n % 3) for n, i in enumerate(ids)], "user string, item_id long, weight_units long")
        stripes = graph.user_item_stripes(capped, bits)
        lists = [f.dataType.elementType.simpleString() for f in stripes.schema if f.name.endswith("_list")]
        assert sum({"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}[t] for t in lists) == size + 8
        got = graph.stripe_pairs(stripes, 3).select("item_A", "item_B", "weight_units").collect()
        w = {i: 1 + n % 3 for n, i in enumerate(ids)}
        assert sorted(map(tuple, got)) == [(a, b, min(w[a], w[b])) for a in ids for b in ids if a < b]
