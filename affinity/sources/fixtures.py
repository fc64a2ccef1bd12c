"""Signals and side inputs derived from the driver's parquet tables.

Every function reads only the columns it needs (the parquet scan prunes the rest) and
returns keys as strings, like the reference's chararray keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import table_path

# Fixed values of the fixtures (documented in FIXTURES.md).
RETURN_FLAG_WISHLIST = "R"
TPCH_WEIGHT_PURCHASE = 1.0
TPCH_WEIGHT_WISHLIST = 0.5
EVENT_WEIGHTS = {"purchase": 1.0, "click": 0.5, "view": 0.25}
EVENT_WEIGHT_ERROR = -0.5
ITEM_PAIR_WEIGHT = 0.25
BOT_THRESHOLD = 40


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li["l_orderkey"] == od["o_orderkey"])


def signals_tpch(spark: SparkSession, sf_dir: str, keys: str = "string") -> DataFrame:
    """(user = o_custkey, item = l_partkey, weight 0.5 for returned lines else 1.0, signal_type = flag).

    ``keys``: the type of user and item; the item-item graph takes them as "bigint", as they are."""
    j = _orders_lines(spark, sf_dir)
    return j.select(
        F.col("o_custkey").cast(keys).alias("user"),
        F.col("l_partkey").cast(keys).alias("item"),
        F.when(F.col("l_returnflag") == RETURN_FLAG_WISHLIST, F.lit(TPCH_WEIGHT_WISHLIST))
        .otherwise(F.lit(TPCH_WEIGHT_PURCHASE))
        .alias("weight"),
        F.col("l_returnflag").alias("signal_type"),
    )


def signals_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase-like signals (weight 1.0) UNION ALL wishlist-like signals (weight 0.5)."""
    j = _orders_lines(spark, sf_dir)
    base = [F.col("o_custkey").cast("string").alias("user"), F.col("l_partkey").cast("string").alias("item")]
    purchases = j.where(F.col("l_returnflag") != RETURN_FLAG_WISHLIST).select(
        *base, F.lit(TPCH_WEIGHT_PURCHASE).alias("weight")
    )
    wishlist = j.where(F.col("l_returnflag") == RETURN_FLAG_WISHLIST).select(
        *base, F.lit(TPCH_WEIGHT_WISHLIST).alias("weight")
    )
    return purchases.unionByName(wishlist)


def signals_events(spark: SparkSession, sf_dir: str, signed: bool = False) -> DataFrame:
    """Events as signals: purchase/click/view -> 1.0/0.5/0.25 (``signed``: error -> -0.5).
    item = ``$.k`` of the JSON ``props`` column."""
    weights = dict(EVENT_WEIGHTS)
    if signed:
        weights["error"] = EVENT_WEIGHT_ERROR
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_type", "props")
    w = None
    for name, val in weights.items():
        cond = F.col("event_type") == name
        w = F.when(cond, F.lit(val)) if w is None else w.when(cond, F.lit(val))
    return ev.where(F.col("event_type").isin(list(weights))).select(
        F.col("user_id").cast("string").alias("user"),
        F.get_json_object("props", "$.k").alias("item"),
        w.alias("weight"),
        F.col("event_type").alias("signal_type"),
    )


def metadata_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, metadata_field): p_type for p_size <= 45, UNION ALL p_brand for p_size <= 10."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")
    key = F.col("p_partkey").cast("string").alias("item")
    a = p.where(F.col("p_size") <= 45).select(key, F.col("p_type").alias("metadata_field"))
    b = p.where(F.col("p_size") <= 10).select(key, F.col("p_brand").alias("metadata_field"))
    return a.unionByName(b)


def source_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return p.where(F.col("p_size") <= 25).select(F.col("p_partkey").cast("string").alias("item"))


def dest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return p.where(F.col("p_size") % 2 == 0).select(F.col("p_partkey").cast("string").alias("item"))


def item_item_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outside item-item signals: consecutive lines (line n, line n + 1) of one order with
    different parts link both ways with -0.25 if either line was returned, else +0.25;
    summed per (item_A, item_B).

    Built as an equi-join on (order, line number) rather than a per-order window or
    all pairs of an order, so a huge order is spread like any other key.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    # Keys become strings behind the sum: shuffled as they are, rows are shorter.
    returned = (F.col("l_returnflag") == RETURN_FLAG_WISHLIST).alias
    a = li.select(
        F.col("l_orderkey").alias("__o"),
        (F.col("l_linenumber") + F.lit(1)).alias("__n"),
        F.col("l_partkey").alias("item_A"),
        returned("__ra"),
    )
    b = li.select(
        F.col("l_orderkey").alias("__o"),
        F.col("l_linenumber").alias("__n"),
        F.col("l_partkey").alias("item_B"),
        returned("__rb"),
    )
    pair = (
        a.join(b, ["__o", "__n"])
        .where(F.col("item_A") != F.col("item_B"))
        .select(
            "item_A",
            "item_B",
            F.when(F.col("__ra") | F.col("__rb"), F.lit(-ITEM_PAIR_WEIGHT)).otherwise(F.lit(ITEM_PAIR_WEIGHT)).alias("weight"),
        )
    )
    # Both directions in one pass over the join (no second evaluation of the subtree).
    both = pair.select(
        F.explode(
            F.array(
                F.struct(F.col("item_A").alias("a"), F.col("item_B").alias("b")),
                F.struct(F.col("item_B").alias("a"), F.col("item_A").alias("b")),
            )
        ).alias("__d"),
        "weight",
    ).select(F.col("__d.a").alias("item_A"), F.col("__d.b").alias("item_B"), "weight")
    sums = both.groupBy("item_A", "item_B").agg(F.sum("weight").alias("weight"))
    return sums.select(F.col("item_A").cast("string"), F.col("item_B").cast("string"), "weight")
