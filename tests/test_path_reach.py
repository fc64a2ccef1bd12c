"""Paths that can lead to no recommendation are dropped before they are shuffled, and no others."""

from pyspark.sql import functions as F

from affinity.operators import item_recs_from_graph, paths
from affinity.session import temporary_stages


def links(spark, n=900, items=40):
    i = F.col("id")
    a, b = F.pmod(F.hash("id"), F.lit(items)), F.pmod(F.xxhash64("id"), F.lit(items))
    # Weights of both signs and equal ones, links to the item itself, and pairs that are there twice.
    return spark.range(0, n, 1, 4).select(
        a.cast("long").alias("item_A"),
        b.cast("long").alias("item_B"),
        F.when(i % 31 == 0, -0.5).otherwise(((i % 9) + 1) / F.lit(8.0)).alias("weight"),
        (i % 5).cast("double").alias("raw_weight"),
        F.create_map(F.lit("NUM_USERS"), i % 3).alias("link_data"),
    )


def rows(df):
    text = df.withColumn("link_data", F.to_json("link_data")) if "link_data" in df.columns else df
    return sorted(str(r) for r in text.collect())


def test_recs_are_those_of_all_paths(spark, monkeypatch):
    kept = []
    plain = lambda g, n: g.withColumn("__reach", F.lit(None).cast("double"))
    with temporary_stages(spark):
        for nhood, n, detail in ((3, 3, False), (6, 2, True), (5, 5, True), (2, 5, False), (30, 4, False)):
            got = rows(item_recs_from_graph(links(spark), nhood, n, detail=detail))
            with monkeypatch.context() as m:
                m.setattr(paths, "_with_reach", plain)
                assert got == rows(item_recs_from_graph(links(spark), nhood, n, detail=detail)) and got
            reach = paths._with_reach(paths.distance_graph(links(spark), nhood), n)
            kept.append(reach.where("__reach IS NOT NULL").count())
    assert kept[0] > 0 and kept[3] == 0


def test_long_paths_are_dropped_before_the_shuffle(spark):
    with temporary_stages(spark):
        for dest, dropped in ((None, True), (spark.range(40).withColumnRenamed("id", "item"), False)):
            plan = item_recs_from_graph(links(spark), 3, 3, dest_items=dest)._jdf.queryExecution().optimizedPlan().toString()
            # The condition lies below the repartitioning of the candidates.
            below = plan[plan.index("RepartitionByExpression") :]
            assert ("__reach" in below) == dropped
