"""Semi joins by a bit map: the same rows, no key lost, and fewer rows shuffled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from affinity.operators import key_filter, key_list, remove_bots, semi_join
from affinity.operators.key_filter import bits_for, key_map, rows_that_may_match


@pytest.fixture
def shuffled(spark):
    """Lists are not broadcast."""
    conf = {k: "-1" for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_no_key_is_lost_and_most_others_are_dropped_before_the_join(spark, kind):
    keys = spark.range(0, 300_000, 3).select(F.col("id").cast(kind).alias("k"))
    rows = spark.range(0, 300_000).select(F.col("id").cast(kind).alias("item"), (F.col("id") % 7).alias("w"))
    bits = bits_for(100_000)
    passed = rows_that_may_match(rows, "item", key_map(keys, bits), bits)
    assert passed.columns == rows.columns
    assert keys.join(passed, F.col("k") == F.col("item"), "left_anti").count() == 0
    extra = passed.count() - 100_000
    # One of eight others, at most.
    assert 0 < extra < 200_000 / 7


def test_same_rows_as_a_plain_semi_join(spark):
    keys = spark.createDataFrame([(1,), (1,), (5,), (None,), (-(1 << 62),)], "k long")
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (5, "c"), (None, "d"), (-(1 << 62), "e")], "item long, __bit string")
    want = sorted(map(tuple, rows.join(keys.toDF("item"), "item", "left_semi").select(*rows.columns).collect()))
    for map_from in (None, 1, 4, 5):
        listed = key_list(keys, map_from)
        assert (listed.table is not None) == (map_from in (1, 4))
        rows2 = rows.withColumnRenamed("__bit", "v")
        assert sorted(map(tuple, semi_join(rows2, listed, "item").collect())) == want
    assert semi_join(rows, key_list(keys.limit(0), 1), "item").count() == 0


def test_the_map_is_broadcast_below_the_shuffle(shuffled):
    keys = shuffled.range(0, 50_000, 2).toDF("k")
    rows = shuffled.range(0, 100_000).select(F.col("id").alias("item"))
    got = semi_join(rows, key_list(keys, 1), "item")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("Exchange hashpartitioning") < plan.index("BroadcastHashJoin")
    assert got.count() == 25_000


def test_the_size_of_the_map_is_bounded(spark):
    assert bits_for(1) == key_filter.BUCKET_BITS and bits_for(10**9) == key_filter.MAX_BITS
    bits = bits_for(20_000)
    table = key_map(spark.range(20_000).toDF("k"), bits)
    assert table.count() <= bits // key_filter.BUCKET_BITS
    assert table.agg(F.max(F.octet_length("bits"))).first()[0] == key_filter.BUCKET_BITS // 8


def test_lists_beyond_the_map_are_joined_without_it(spark, monkeypatch):
    monkeypatch.setattr(key_filter, "MAX_BITS", 10)
    assert key_list(spark.range(11).toDF("k"), 1).table is None
    assert key_list(spark.range(10).toDF("k"), 1).table is not None


def test_few_bots_are_joined_away_without_shuffling_the_signals(spark):
    i = F.col("id")
    signals = spark.range(0, 60_000, 1, 12).select(
        F.when(i % 3 == 0, "bot").when(i % 1000 == 1, None).otherwise((i % 9000).cast("string")).alias("user"),
        i.cast("string").alias("item"),
    )
    kept = remove_bots(signals, 50)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "Exchange hashpartitioning" not in plan
    users = {r["user"]: r["count"] for r in signals.groupBy("user").count().collect()}
    want = sum(n for u, n in users.items() if u is not None and n < 50)
    assert kept.count() == want and kept.columns == signals.columns
