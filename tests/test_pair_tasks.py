"""The pair expansion is dealt out by the number of pairs, and its rows are packed without losing any."""

import glob

from pyspark.sql import functions as F

from affinity import session
from affinity.operators import build_item_item_graph, graph, sum_pairs_to_links
from affinity.session import shuffle_to, temporary_stages, write_stage

CONF = [
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.coalescePartitions.enabled",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.files.maxPartitionBytes",
]


def signals(spark, users=60, each=12, types=3):
    i = F.col("id")
    return spark.range(0, users * each, 1, 4).select(
        F.concat(F.lit("u"), (i % users).cast("string")).alias("user"),
        F.concat(F.lit("i"), (F.hash("id") % 25).cast("string")).alias("item"),
        F.when(i % 7 == 0, -0.5).otherwise(1.0).alias("weight"),
        F.concat(F.lit("t"), (i % types).cast("string")).alias("signal_type"),
    )


def rows(df):
    if "link_data" in df.columns:
        df = df.withColumn("link_data", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("link_data")))))
    return sorted(map(tuple, df.collect()))


def test_tasks_follow_the_pairs_and_links_are_the_same(spark, monkeypatch):
    for detail in (False, True):
        want = rows(build_item_item_graph(signals(spark), 0.5, 0.25, 10, detail)[0])
        monkeypatch.setattr(graph, "PAIRS_PER_TASK", 100)
        before = [spark.conf.get(k) for k in CONF]
        with temporary_stages(spark) as scope:
            links, _ = build_item_item_graph(signals(spark), 0.5, 0.25, 10, detail, stage_links=True)
            [path] = [p for p in scope.paths if "/link_sums-" in p]
            [users] = [p for p in scope.paths if "/user_items-" in p]
            ui = spark.read.parquet(users)
            n = graph.pair_tasks(ui, 10)
            assert n >= 20 and n * 100 >= ui.count() * 9 / 2
            # A file a task: AQE would merge these few rows into one.
            assert len(glob.glob(path.removeprefix("file:") + "/part-*")) > n / 2
            assert rows(links) == want and want
        assert [spark.conf.get(k) for k in CONF] == before
        monkeypatch.undo()


def test_user_items_are_written_by_small_tasks(spark, monkeypatch):
    def files():
        with temporary_stages(spark) as scope:
            table = session.write_rows(graph.aggregate_user_items(signals(spark, 400, 400), 0.5, True), "user_items")
            return len(glob.glob(scope.paths[0].removeprefix("file:") + "/part-*")), table.count()

    merged, rows_ = files()
    monkeypatch.setattr(session, "ROWS_BYTES", "1k")
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    old = spark.conf.get(key)
    spark.conf.set(key, "1k")
    try:
        assert files() == (8, rows_) and merged < 8
    finally:
        spark.conf.set(key, old)


def test_packed_sums_are_those_of_plain_ones(spark):
    big, types = (1 << 31) - 1, ["x", "y", "z"]
    i = F.col("id")
    pairs = spark.range(0, 3000, 1, 6).select(
        F.when(i % 3 == 0, 0).otherwise(big - 2 - i % 5).cast("long").alias("item_A"),
        F.lit(big - 1).cast("long").alias("item_B"),
        F.when(i % 4 == 0, -3).otherwise(1 << 40).cast("long").alias("weight_units"),
        *((i % (k + 2)).alias(f"type_{k}") for k in range(3)),
    )
    for some, detail in ((None, False), (types, True)):
        want = rows(sum_pairs_to_links(pairs, 0.0, detail, some))
        assert len(want) == 12
        for count_bits in (12, 21, 40):
            got = sum_pairs_to_links(pairs, 0.0, detail, some, id_bits=31, count_bits=count_bits)
            assert rows(got) == want
    assert [len(p) for p in graph._places(list("abcd"), 21)] == [3, 1] and len(graph._places(list("abcd"), None)) == 4
    # Ids that do not fit stay two keys.
    assert rows(sum_pairs_to_links(pairs, 0.0, id_bits=32)) == rows(sum_pairs_to_links(pairs, 0.0))


def test_dense_ids_keep_the_order(spark):
    table = spark.range(0, 1000, 1, 7).select((F.col("id") % 991).alias("item")).distinct()
    with shuffle_to(spark, 9):
        written = write_stage(table.orderBy("item").withColumn("item_id", F.monotonically_increasing_id()), "ids")
    assert written.agg(F.max("item_id")).first()[0] > 1 << 33
    dense, n = graph._dense_ids(written)
    assert n == 991 and all(r["item"] == r["item_id"] for r in dense.collect())
    empty, none = graph._dense_ids(written.where("item < 0"))
    assert none == 0 and empty.count() == 0
