"""Hand-worked cases, one per rule (FIXTURES.md section 3). Expected rows computed on paper."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import links_df, signals_df

from affinity.operators import (
    adjust_item_item_graph_weight,
    build_item_item_graph,
    build_user_item_recs,
    diversify_item_item_links,
    add_metadata_to_item_item_links,
    direct_item_recs,
    item_recs_from_graph,
    init_shortest_paths,
    remove_bots,
    scale_user_item_signals,
    sum_item_item_signals,
)


def logistic_units(w, k):
    return math.floor((2.0 / (1.0 + math.exp(-k * w)) - 1.0) * 1e9 + 0.5)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_null_user_item_weight_are_no_evidence(spark):
    s = signals_df(spark, [(None, "a", 1.0), ("u", None, 1.0), ("u", "b", None)])
    assert scale_user_item_signals(s, 0.5).count() == 0


def test_logistic_scaling_is_odd_and_below_one(spark):
    s = signals_df(spark, [("u", "a", 1.0), ("u", "a", 1.0), ("v", "a", -2.0), ("w", "a", 0.0)])
    got = dict((r["user"], r["weight_units"]) for r in scale_user_item_signals(s, 0.5).collect())
    assert got["u"] == logistic_units(2.0, 0.5)
    assert got["v"] == -logistic_units(2.0, 0.5)
    assert got["w"] == 0
    assert all(abs(v) < 1_000_000_000 for v in got.values())


def test_thresholds_are_inclusive(spark):
    s = signals_df(spark, [("u1", "a", 1.0), ("u1", "b", 1.0), ("u2", "a", 1.0), ("u2", "b", 1.0)])
    exact = 2 * logistic_units(1.0, 0.5) / 1e9  # item weight and link weight are both exactly this
    links, iw = build_item_item_graph(s, 0.5, exact, 10)
    assert rows(links, "item_A", "item_B") == [("a", "b"), ("b", "a")]
    assert rows(iw, "item", "overall_weight") == [("a", exact), ("b", exact)]
    above = float(f"{exact + 1e-9:.9f}")
    links2, _ = build_item_item_graph(s, 0.5, above, 10)
    assert links2.count() == 0


def test_links_are_min_of_pair_and_summed_over_users(spark):
    s = signals_df(
        spark,
        [("u1", "a", 1.0), ("u1", "b", 2.0), ("u2", "a", 3.0), ("u2", "b", 1.0), ("u2", "c", 1.0)],
    )
    links, _ = build_item_item_graph(s, 0.5, 0.0, 10)
    got = {(r["item_A"], r["item_B"]): r["weight"] for r in links.collect()}
    w1 = logistic_units(1.0, 0.5)
    assert got[("a", "b")] == got[("b", "a")] == (w1 + w1) / 1e9
    assert got[("b", "c")] == w1 / 1e9
    assert ("a", "a") not in got


def test_cap_keeps_strongest_items_per_user(spark):
    s = signals_df(spark, [("u", "a", 3.0), ("u", "b", 2.0), ("u", "c", 1.0)])
    links, _ = build_item_item_graph(s, 0.5, 0.0, 2)
    assert rows(links, "item_A", "item_B") == [("a", "b"), ("b", "a")]


def test_bot_with_exactly_threshold_rows_is_removed(spark):
    s = signals_df(
        spark,
        [("bot", "a", 1.0), ("bot", "a", 1.0), ("bot", None, 1.0), ("ok", "a", 1.0), ("ok", "b", 1.0),
         (None, "x", 1.0)],
    )
    kept = remove_bots(s, 3)
    assert rows(kept, "user", "item") == [("ok", "a"), ("ok", "b")]


def test_bayes_adjustment_uses_target_popularity(spark):
    links = spark.createDataFrame([("a", "b", 2.0), ("b", "a", 2.0)], "item_A string, item_B string, weight double")
    iw = spark.createDataFrame([("a", 1.0), ("b", 6.0)], "item string, overall_weight double")
    got = {r["item_A"]: (r["weight"], r["raw_weight"]) for r in adjust_item_item_graph_weight(links, iw, 4.0).collect()}
    assert got["a"] == (2.0 / 10.0, 2.0)
    assert got["b"] == (2.0 / 5.0, 2.0)
    boosted = adjust_item_item_graph_weight(links, iw, 4.0, "SQRT")
    got = {r["item_A"]: r["weight"] for r in boosted.collect()}
    assert got["a"] == 2.0 * math.sqrt(6.0) / 10.0


def test_direct_beats_equal_length_two_hop_and_cycles_vanish(spark):
    g = links_df(
        spark,
        [("A", "B", 1.0, 10.0), ("B", "A", 1.0, 10.0), ("B", "C", 1.0, 11.0), ("A", "C", 0.5, 12.0)],
    )
    recs = item_recs_from_graph(g, 3, 10, detail=False)
    a = sorted((r["item_B"], r["weight"], r["raw_weight"], r["rank"]) for r in recs.where("item_A = 'A'").collect())
    assert a == [("B", 1.0, 10.0, 1), ("C", 0.5, 12.0, 2)]


def test_two_hop_weight_and_linking_item(spark):
    g = links_df(spark, [("A", "B", 2.0, 1.0), ("B", "C", 2.0, 1.0)])
    g = g.withColumn("link_data", F.create_map(F.lit("NUM_USERS"), F.lit(1).cast("long")))
    recs = item_recs_from_graph(g, 3, 10, detail=True)
    got = {(r["item_A"], r["item_B"]): r for r in recs.collect()}
    ac = got[("A", "C")]
    assert ac["weight"] == 1.0 / (0.5 + 0.5)
    assert ac["raw_weight"] is None and ac["link_data"] is None and ac["linking_item"] == "B"
    ab = got[("A", "B")]
    assert ab["linking_item"] is None and ab["link_data"] == {"NUM_USERS": 1}


def test_neighbourhood_pruning_bounds_second_hop(spark):
    g = links_df(spark, [("A", "B", 1.0, 1.0), ("A", "X", 0.1, 1.0), ("B", "C", 1.0, 1.0)])
    recs = item_recs_from_graph(g, 1, 10)
    # A keeps only B in its neighbourhood, so X is unreachable and C comes through B
    assert rows(recs.where("item_A = 'A'"), "item_B", "rank") == [("B", 1), ("C", 2)]


def test_direct_recs_rank_by_weight(spark):
    g = links_df(spark, [("A", "B", 0.5, 1.0), ("A", "C", 0.9, 1.0), ("A", "D", 0.5, 1.0)])
    assert rows(direct_item_recs(g, 2), "item_B", "rank") == [("B", 2), ("C", 1)]


def test_middle_item_need_not_be_available(spark):
    g = links_df(spark, [("A", "M", 1.0, 1.0), ("M", "B", 1.0, 1.0)])
    src = spark.createDataFrame([("A",)], "item string")
    dst = spark.createDataFrame([("B",), ("B",)], "item string")
    recs = item_recs_from_graph(g, 3, 10, source_items=src, dest_items=dst)
    assert rows(recs, "item_A", "item_B", "weight", "rank") == [("A", "B", 0.5, 1)]
    graph, paths = init_shortest_paths(g, 3, src, dst)
    assert rows(graph, "item_A", "item_B") == [("A", "M")]
    assert rows(paths, "item_A", "item_B") == [("B", "B"), ("M", "B")]


def test_seen_item_with_negative_weight_is_excluded_and_score_clamped(spark):
    s = signals_df(spark, [("u", "a", 1.0), ("u", "b", -1.0)])
    recs = spark.createDataFrame(
        [("a", "b", 0.5, 1.0, 1), ("b", "c", 0.8, 2.0, 1)],
        "item_A string, item_B string, weight double, raw_weight double, rank int",
    )
    out = build_user_item_recs(s, recs, 10)
    assert rows(out, "user", "item", "weight", "reason_item", "user_reason_item_weight", "rank") == [
        ("u", "c", 0.0, "b", -1.0, 1)
    ]


def test_duplicate_signal_uses_larger_weight_as_reason_weight(spark):
    s = signals_df(spark, [("u", "a", 1.0), ("u", "a", 0.5)])
    recs = spark.createDataFrame(
        [("a", "b", 0.64, 2.0, 1)], "item_A string, item_B string, weight double, raw_weight double, rank int"
    )
    out = build_user_item_recs(s, recs, 10)
    assert rows(out, "item", "weight", "user_reason_item_weight", "item_reason_item_weight") == [
        ("b", 0.8, 1.0, 2.0)
    ]


def test_diversity_halves_first_of_each_reason(spark):
    s = signals_df(spark, [("u", "a", 1.0), ("u", "e", 1.0)])
    recs = spark.createDataFrame(
        [("a", "b", 0.81, 1.0, 1), ("a", "c", 0.64, 1.0, 2), ("a", "d", 0.49, 1.0, 3), ("e", "f", 0.36, 1.0, 1)],
        "item_A string, item_B string, weight double, raw_weight double, rank int",
    )
    plain = build_user_item_recs(s, recs, 10, diversity_adjust=False)
    assert rows(plain, "rank", "item") == [(1, "b"), (2, "c"), (3, "d"), (4, "f")]
    div = build_user_item_recs(s, recs, 10, diversity_adjust=True)
    # adjusted: b 0.9/2, c 0.8/3, d 0.7/4, f 0.6/2 -> b, f, c, d; output weight unadjusted
    assert rows(div, "rank", "item", "weight") == [(1, "b", 0.9), (2, "f", 0.6), (3, "c", 0.8), (4, "d", 0.7)]
    top2 = build_user_item_recs(s, recs, 2, diversity_adjust=True)
    assert rows(top2, "rank", "item") == [(1, "b"), (2, "f")]


def test_user_without_candidates_gets_no_rows(spark):
    s = signals_df(spark, [("u", "z", 1.0)])
    recs = spark.createDataFrame(
        [("a", "b", 0.5, 1.0, 1)], "item_A string, item_B string, weight double, raw_weight double, rank int"
    )
    assert build_user_item_recs(s, recs, 10).count() == 0


def test_diversify_drops_items_without_metadata_and_doubles_two(spark):
    g = links_df(spark, [("A", "B", 1.0, 5.0), ("A", "C", 0.5, 6.0), ("A", "D", 0.25, 7.0)])
    md = spark.createDataFrame([("B", "x"), ("C", "x"), ("C", "y")], "item string, metadata_field string")
    out = diversify_item_item_links(g, md)
    assert rows(out, "item_A", "item_B", "weight", "raw_weight") == [
        ("A", "B", 1.0, 5.0),
        ("A", "C", 0.25, 6.0),
        ("A", "C", 0.5, 6.0),
    ]


def test_add_metadata_needs_both_ends(spark):
    g = spark.createDataFrame([("A", "B", 1.0), ("A", "D", 1.0)], "item_A string, item_B string, weight double")
    md = spark.createDataFrame([("A", "m"), ("B", "x"), ("B", "y")], "item string, metadata_field string")
    out = add_metadata_to_item_item_links(g, md)
    assert rows(out, "item_A", "item_B", "metadata_A", "metadata_B") == [
        ("A", "B", "m", "x"),
        ("A", "B", "m", "y"),
    ]


def test_outside_signals_drop_nonpositive_links_and_clamp_weights(spark):
    links = spark.createDataFrame([("A", "B", 0.5), ("A", "C", 0.25)], "item_A string, item_B string, weight double")
    outside = spark.createDataFrame(
        [("A", "B", -0.5), ("A", "C", -0.5), ("B", "D", 0.25)], "item_A string, item_B string, weight double"
    )
    iw = spark.createDataFrame([("A", 0.3), ("B", 1.0)], "item string, overall_weight double")
    l2, iw2 = sum_item_item_signals(links, outside, iw)
    assert rows(l2, "item_A", "item_B", "weight") == [("B", "D", 0.25)]
    assert rows(iw2, "item", "overall_weight") == [("A", 0.0), ("B", 1.25)]


def test_link_data_sums_types_and_counts_users(spark):
    s = signals_df(
        spark,
        [("u1", "i1", 1.0, "a"), ("u1", "i2", 1.0, "b"), ("u2", "i1", 1.0, "a"), ("u2", "i2", 1.0, "a"),
         ("u2", "i2", 0.0, None)],
        with_type=True,
    )
    links, _ = build_item_item_graph(s, 0.5, 0.1, 10, detail=True)
    got = {(r["item_A"], r["item_B"]): r["link_data"] for r in links.collect()}
    assert got[("i1", "i2")] == {"a": 3, "b": 1, "NUM_USERS": 2}
    assert got[("i2", "i1")] == got[("i1", "i2")]


def test_popularity_boost_rejects_unknown_function(spark):
    links = spark.createDataFrame([("a", "b", 2.0)], "item_A string, item_B string, weight double")
    iw = spark.createDataFrame([("b", 1.0)], "item string, overall_weight double")
    with pytest.raises(ValueError):
        adjust_item_item_graph_weight(links, iw, 4.0, "CUBE")


def test_reserved_signal_type_is_an_error(spark):
    s = signals_df(spark, [("u1", "i1", 1.0, "NUM_USERS")], with_type=True)
    with pytest.raises(Exception, match="reserved"):
        build_item_item_graph(s, 0.5, 0.1, 10, detail=True)


def test_diversify_ranks_weights_of_either_sign(spark):
    g = links_df(spark, [("A", "B", 1.0, 1.0), ("A", "C", -0.5, 1.0), ("A", "D", -4.0, 1.0)])
    md = spark.createDataFrame([(i, "x") for i in "BCD"], "item string, metadata_field string")
    got = diversify_item_item_links(g, md)
    assert rows(got, "item_B", "weight") == [("B", 1.0), ("C", -0.25), ("D", -4.0 / 3.0)]
    # The nearest neighbour has the smallest distance, which a negative weight gives.
    assert rows(item_recs_from_graph(got, 1, 1), "item_B") == [("C",)]


def test_sums_of_weights_that_binary_fractions_cannot_hold_are_exact(spark):
    s = signals_df(spark, [(f"u{i % 3}", f"i{i % 4}", 0.1 + (i % 7) / 10) for i in range(2000)])
    want = None
    for parts in (1, 3, 16):
        links, weights = build_item_item_graph(s.repartition(parts), 0.01, 0.0, 10)
        got = rows(links, "item_A", "item_B", "weight_units"), rows(weights, "item", "overall_units")
        want = want or got
        assert got == want
    total = sum(round((0.1 + (i % 7) / 10) * 1e9) for i in range(2000) if i % 3 == 0 and i % 4 == 0)
    ui = {(r["user"], r["item"]): r["weight_units"] for r in scale_user_item_signals(s, 0.01).collect()}
    assert ui["u0", "i0"] == logistic_units(total / 1e9, 0.01)


def test_outside_signals_are_exact_beyond_double_precision(spark):
    big = (1 << 55) + 1
    links = spark.createDataFrame([("A", "B", 1.0, big)], "item_A string, item_B string, weight double, weight_units long")
    iw = spark.createDataFrame([("A", 1.0, big)], "item string, overall_weight double, overall_units long")
    outside = spark.createDataFrame([("A", "B", 0.000000002)], "item_A string, item_B string, weight double")
    l2, iw2 = sum_item_item_signals(links, outside, iw)
    assert rows(l2, "weight_units") == [(big + 2,)] and rows(iw2, "overall_units") == [(big + 2,)]


def test_users_without_a_name_get_no_recommendations(spark):
    recs = links_df(spark, [("A", "B", 0.5, 1.0)])
    s = signals_df(spark, [(None, "A", 1.0), ("u", "A", 1.0), ("v", None, 1.0)])
    assert rows(build_user_item_recs(s, recs, 5), "user", "item") == [("u", "B")]


def test_neighbourhood_defaults_to_the_number_of_recs(spark):
    from affinity.params import RecParams
    from affinity.plans import pipelines

    assert RecParams(num_recs_per_item=7).nhood == 7 and RecParams(initial_nhood_size=2).nhood == 2
    s = signals_df(spark, [(f"u{i}", x, 1.0) for i in range(4) for x in "abcd"[: 2 + i % 3]])
    p = RecParams(0.5, 0.0, 10, 1.0, 5, 1, 5)
    narrow = {(r["item_A"], r["item_B"]) for r in pipelines.item_item_recs(s, p).collect() if r["raw_weight"] is not None}
    assert len(narrow) == 4  # one direct neighbour each
    wide = pipelines.item_item_recs(s, p.with_(initial_nhood_size=None)).where("raw_weight IS NOT NULL").count()
    assert wide == 12


def test_top_n_beyond_the_group_limit_threshold_keeps_its_partial_limit(spark):
    from affinity.functions import top_n_per_group

    df = spark.range(100_000).select((F.col("id") % 2).alias("g"), "id")
    plan = top_n_per_group(df, ["g"], ["id"], 5000)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_duplicate_outside_rows_stay_separate_links(spark):
    links = spark.createDataFrame([("A", "B", 0.5), ("C", "D", 0.75)], "item_A string, item_B string, weight double")
    outside = spark.createDataFrame(
        [("A", "B", 0.25), ("A", "B", 0.5), ("E", "F", 1.0), ("E", "F", 0.25)],
        "item_A string, item_B string, weight double",
    )
    iw = spark.createDataFrame([("A", 1.0)], "item string, overall_weight double")
    l2, _ = sum_item_item_signals(links, outside, iw)
    assert rows(l2, "item_A", "item_B", "weight") == [
        ("A", "B", 0.75), ("A", "B", 1.0), ("C", "D", 0.75), ("E", "F", 0.25), ("E", "F", 1.0)
    ]


def test_global_sort_rank_equals_row_number_on_skewed_groups(spark):
    from pyspark.sql import Window

    from affinity.functions import rank_by_global_sort

    df = spark.range(30000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("g"),
        (F.col("id") % 13).cast("double").alias("w"),
        F.col("id").cast("string").alias("b"),
    ).repartition(7)
    order = [F.col("w").desc(), F.col("b").asc()]
    got = rank_by_global_sort(df, ["g"], order, "r")
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.select("g", "w", "b", "r").exceptAll(want.select("g", "w", "b", "r")).count() == 0
    assert got.count() == want.count() == 30000
