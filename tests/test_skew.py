"""Hot keys are split: a third of all rows on one key, broadcasts off, low thresholds, many partitions."""

import pytest
from pyspark.sql import functions as F

from affinity.operators import (
    adjust_item_item_graph_weight,
    build_user_item_recs,
    diversify_item_item_links,
    item_recs_from_graph,
    remove_bots,
    sum_pairs_to_links,
)
from affinity.plans import pipelines
from affinity.params import RecParams
from affinity.session import write_stage

ROWS = 240_000
CONF = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def tight(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    df.count()  # the same plan is run and re-planned below
    run = df.select("*")
    run.collect()
    return run._jdf.queryExecution().executedPlan().toString()


def hot(spark, name: str, rows: int = ROWS, keys: int = 5000):
    """``name``: one value on a third of the rows, ``keys`` others."""
    i = F.col("id")
    return spark.range(0, rows, 1, 24).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (i % keys).cast("string"))).alias(name), i
    )


def links(spark, target: str = "item_B"):
    other = "item_A" if target == "item_B" else "item_B"
    return hot(spark, target).select(
        target,
        F.concat(F.lit("s"), F.col("id").cast("string")).alias(other),
        (F.col("id") % 17 + 1).cast("double").alias("weight"),
        F.lit(1.0).alias("raw_weight"),
    )


def test_bot_removal(tight):
    signals = hot(tight, "user").select("user", F.col("id").cast("string").alias("item"), F.lit(1.0).alias("weight"))
    # The one user with a third of all rows is split where the bots are too many to broadcast ...
    assert "skew=true" in final_plan(remove_bots(signals, 10))
    # ... and nothing is joined where there are none.
    assert "Join" not in final_plan(remove_bots(signals, 10**9)).split("== Initial Plan ==")[0]


def test_user_step_on_unstaged_recs(tight):
    signals = hot(tight, "item").select(F.col("id").cast("string").alias("user"), "item", F.lit(1.0).alias("weight"))
    items = signals.select("item").distinct()
    recs = item_recs_from_graph(
        items.select(
            F.col("item").alias("item_A"), F.lit("k1").alias("item_B"), F.lit(1.0).alias("weight"), F.lit(1.0).alias("raw_weight")
        ),
        3,
        3,
    )
    assert "skew=true" in final_plan(pipelines.user_item_recs(signals, recs, RecParams()))


def test_bayes_then_diversify(tight):
    weights = hot(tight, "item").select("item").distinct().select("item", F.lit(2.0).alias("overall_weight"))
    metadata = weights.select("item", F.lit("m").alias("metadata_field"))
    adjusted = adjust_item_item_graph_weight(
        write_stage(links(tight), "links"), write_stage(weights, "weights"), 1.0
    )
    assert "skew=true" in final_plan(adjusted)
    staged = write_stage(adjusted, "adjusted").join(write_stage(metadata, "md").withColumnRenamed("item", "item_B"), "item_B")
    assert "skew=true" in final_plan(staged)
    out = diversify_item_item_links(adjusted, write_stage(metadata, "md"))
    assert out.count() == ROWS


def test_destination_semi_join(tight):
    dest = hot(tight, "item").select("item").distinct()
    graph = links(tight, "item_B").groupBy("item_A", "item_B").agg(F.max("weight").alias("weight"), F.max("raw_weight").alias("raw_weight"))
    recs = item_recs_from_graph(graph, 3, 3, dest_items=write_stage(dest, "dest"))
    assert "skew=true" in final_plan(recs)


def test_hot_pair_of_the_detailed_graph_is_summed_on_every_mapper(tight):
    i = F.col("id")
    pairs = tight.range(0, ROWS, 1, 24).select(
        F.when(i % 3 == 0, 0).otherwise(i % 5000).alias("item_A"),
        F.when(i % 3 == 0, 1).otherwise(i % 5000 + 1).alias("item_B"),
        F.lit(10).cast("long").alias("weight_units"),
        F.array(F.struct(F.lit("x").alias("k"), F.lit(2).cast("long").alias("n"))).alias("link_terms"),
    )
    out = sum_pairs_to_links(pairs, 0.0, detail=True)
    plan = final_plan(out).split("== Initial Plan ==")[0]
    assert plan.count("Generate inline") == 1 and "partial_sum(n" in plan
    got = {r["item_A"]: r for r in out.where("item_A = 0 AND item_B = 1").collect()}[0]
    n = ROWS // 3 + sum(1 for k in range(0, ROWS, 5000) if k % 3)
    assert got["weight_units"] == 10 * n and got["link_data"] == {"x": 2 * n, "NUM_USERS": n}


def test_build_user_item_recs_accepts_staged_recs(tight):
    recs = tight.createDataFrame([("hot", "k1", 1.0, 1.0)], "item_A string, item_B string, weight double, raw_weight double")
    signals = hot(tight, "item").select(F.col("id").cast("string").alias("user"), "item", F.lit(1.0).alias("weight"))
    assert build_user_item_recs(signals, write_stage(recs, "recs"), 2).count() == ROWS // 3


# ----------------------------------------------------------------------------- top-n in two levels


@pytest.fixture
def wide(spark):
    """A session that shuffles to 1,000 partitions and merges the small ones."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, "1000")
    yield spark
    spark.conf.set(key, old)


def bot(spark, partitions=1000, per_partition=300):
    """One user with rows in every partition, beside others; ties in weight."""
    i = F.col("id")
    return spark.range(0, partitions * per_partition, 1, partitions).select(
        F.when(i % 3 == 0, F.lit("bot")).otherwise(F.concat(F.lit("u"), (i % 700).cast("string"))).alias("user"),
        F.concat(F.lit("i"), i.cast("string")).alias("item"),
        (F.xxhash64("id") % 50).alias("weight"),
    )


def order():
    return [F.col("weight").desc(), F.col("item").asc()]


def test_one_user_in_a_thousand_partitions_is_ranked_in_parts(wide):
    from affinity.functions.ranking import first_level_parts, top_n_of_parts, top_n_per_group

    n = 80
    parts = first_level_parts(wide, n)
    assert parts == 32
    df = bot(wide)
    top = top_n_per_group(df, ["user"], order(), n, "rank")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4 and plan.count("hashpartitioning(user") == 2
    # What the tasks of the first level read of the one user, and what the last one reads.
    first = df.withColumn("p", F.spark_partition_id()).where("user = 'bot'")
    sent = first.groupBy("p").count().select((F.col("p") % parts).alias("part"), F.least("count", F.lit(n)).alias("k"))
    assert sent.groupBy("part").agg(F.sum("k").alias("k")).agg(F.max("k")).first()[0] <= n * 32
    last = top_n_of_parts(df, ["user"], order(), n, parts).where("user = 'bot'").count()
    assert last <= n * parts < 80_000 == sent.agg(F.sum("k")).first()[0]
    want = top_n_per_group(df, ["user"], order(), n, "rank", parts=1)
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, want.collect()))


def test_few_partitions_or_small_n_stay_in_one_level(spark):
    from affinity.functions.ranking import first_level_parts

    assert first_level_parts(spark, 50) == 1
    plan = pipelines.item_item_recs(bot(spark, 8, 60), RecParams())._jdf.queryExecution().optimizedPlan().toString()
    assert "__part" not in plan


def test_beyond_sparks_group_limit_the_group_is_split_without_changing_the_session(spark):
    from affinity.functions.ranking import LIMIT_CONF, first_level_parts, top_n_per_group

    old = spark.conf.get(LIMIT_CONF)
    spark.conf.set(LIMIT_CONF, "1000")
    try:
        assert first_level_parts(spark, 2000) >= 8
        df = bot(spark, 16, 900)
        got = top_n_per_group(df, ["user"], order(), 2000, "rank")
        assert "__part" in got._jdf.queryExecution().optimizedPlan().toString()
        want = top_n_per_group(df, ["user"], order(), 2000, "rank", parts=1)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        assert spark.conf.get(LIMIT_CONF) == "1000"
    finally:
        spark.conf.set(LIMIT_CONF, old)


def test_the_whole_recommender_is_the_same_in_two_levels(spark, monkeypatch):
    from affinity.functions import ranking

    signals = bot(spark, 8, 60).select("user", F.concat(F.lit("i"), (F.hash("item") % 40).cast("string")).alias("item"), F.lit(1.0).alias("weight"))
    p = RecParams(0.5, 0.0, 6, 1.0, 5, 4, 5)

    def run():
        return [sorted(map(repr, map(tuple, df.collect()))) for df in pipelines.recommend(signals, p)]

    one = run()
    monkeypatch.setattr(ranking, "GROUP_ROWS", 1)
    assert ranking.first_level_parts(spark, 2) > 1
    assert run() == one and all(one)
