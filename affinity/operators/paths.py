"""Item-item recommendations from a weighted link graph.

Distance is ``1 / weight``. Each item keeps its ``initial_nhood_size`` nearest direct
neighbours; a recommendation is the best path of one or two hops inside that pruned
graph, i.e. ``direct ∪ (A -> B -> C)``. The reference builds this as a join of the
graph with "paths" (graph edges plus a zero-length self loop per destination); the
union below is the same relation without the self-loop rows.

Ties are broken totally so that every engine returns the same rows:
prune by (dist, item_B); best path by (dist, direct first, linking item);
final rank by (dist, item_B).

Items may be strings or ids in item order; the same rows come out.

Scale notes
-----------
* Pruning is ``row_number() <= nhood`` (partial group limit before the shuffle).
* The two-hop join fans out at most ``nhood`` rows per middle item, so a hot middle
  item only makes the *other* side large; AQE splits that skewed partition.
* Where an item has ``num_recs`` direct neighbours and no dest list may drop them, paths that are longer than
  all of those are dropped before they are shuffled.
* Candidates are shuffled once by ``item_A``; both later windows (best path per pair,
  top-N per item) reuse that partitioning -- at most ``nhood * (nhood + 1)`` rows per
  item, so no group is unbounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from affinity.functions import reciprocal, top_n_per_group
from affinity.operators.graph import LINK_DATA_TYPE, _require
from affinity.operators.key_filter import KeyList, key_list, semi_join
from affinity.session import write_stage


def _items(df: DataFrame, map_from: int | None) -> KeyList:
    """An item list (repeats do no harm, and without an aggregate Spark can split a hot item)."""
    return key_list(df.select("item" if "item" in df.columns else df.columns[0]), map_from)


def distance_graph(ii_links: DataFrame, initial_nhood_size: int, detail: bool = False) -> DataFrame:
    """M04 graph: per item_A the ``initial_nhood_size`` smallest distances.

    Links whose distance is undefined (zero or NULL weight) are not traversable.
    """
    _require(ii_links, ["item_A", "item_B", "weight", "raw_weight"] + (["link_data"] if detail else []), "ii_links")
    extra = ["link_data"] if detail else []
    dm = ii_links.select(
        "item_A", "item_B", reciprocal("weight").alias("dist"), F.col("raw_weight").cast(DoubleType()), *extra
    ).where(F.col("dist").isNotNull())
    return top_n_per_group(dm, ["item_A"], [F.col("dist").asc(), F.col("item_B").asc()], initial_nhood_size)


def init_shortest_paths(
    ii_links: DataFrame,
    initial_nhood_size: int,
    source_items: DataFrame | None = None,
    dest_items: DataFrame | None = None,
    detail: bool = False,
    map_lists_from: int | None = None,
    stage_graph: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Return ``(graph, paths)`` as the reference defines them.

    graph: pruned links (restricted to source items when given);
    paths: the *unfiltered* pruned links with ``raw_weight`` (and ``link_data``) nulled,
           plus a zero-distance self loop per distinct destination, restricted to dest
           items when given.
    ``map_lists_from``: as in ``item_recs_from_graph``. The paths read the pruned links twice; with ``stage_graph`` they are
    written first, else all links are ranked for each.
    """
    g = distance_graph(ii_links, initial_nhood_size, detail)
    if stage_graph:
        g = write_stage(g, "nhood_graph")
    graph = g if source_items is None else semi_join(g, _items(source_items, map_lists_from), "item_A")
    nulls = [F.lit(None).cast(DoubleType()).alias("raw_weight")]
    if detail:
        nulls.append(F.lit(None).cast(LINK_DATA_TYPE).alias("link_data"))
    copy = g.select("item_A", "item_B", "dist", *nulls)
    loops = (
        g.select(F.col("item_B").alias("item_A")).distinct()
        .select("item_A", F.col("item_A").alias("item_B"), F.lit(0.0).alias("dist"), *nulls)
    )
    paths = copy.unionByName(loops)
    if dest_items is not None:
        paths = semi_join(paths, _items(dest_items, map_lists_from), "item_B")
    return graph, paths


def _with_reach(graph: DataFrame, num_recs: int) -> DataFrame:
    """``__reach``: the greatest distance of an item with ``num_recs`` direct neighbours (NULL: it has fewer).

    A path beyond that leads to no rec: so many others are nearer. The rows lie together by item already."""
    item = Window.partitionBy("item_A")
    other = F.when(F.col("item_A") != F.col("item_B"), F.col("item_B"))
    full = F.size(F.collect_set(other).over(item)) >= int(num_recs)
    return graph.withColumn("__reach", F.when(full, F.max("dist").over(item)))


def item_recs_from_graph(
    ii_links: DataFrame,
    initial_nhood_size: int,
    num_recs: int,
    source_items: DataFrame | None = None,
    dest_items: DataFrame | None = None,
    detail: bool = False,
    stage_graph: bool = True,
    map_lists_from: int | None = None,
) -> DataFrame:
    """Best <=2-hop path per (item_A, item_B); top ``num_recs`` per item_A.

    Output (item_A, item_B, weight = 1/dist, raw_weight, rank int
    [, link_data, linking_item]). ``raw_weight``/``link_data`` are NULL for indirect
    recs, ``linking_item`` (the middle item) is NULL for direct ones. With source/dest
    items only sources get recs and only dests are recommended; any item may still be
    the middle hop.

    The pruned graph (at most ``initial_nhood_size`` rows per item) is read by three
    branches; with ``stage_graph`` it is written once to the shared checkpoint folder
    instead of being recomputed from the links by each branch. Item lists with at
    least ``map_lists_from`` items filter the graph by a bit map before it is shuffled to them
    (``operators.key_filter``; None: they do not).
    """
    g = distance_graph(ii_links, initial_nhood_size, detail)
    bounded = dest_items is None and initial_nhood_size >= num_recs
    if bounded:
        g = _with_reach(g, num_recs)
    if stage_graph:
        g = write_stage(g, "nhood_graph")
    src = g if source_items is None else semi_join(g, _items(source_items, map_lists_from), "item_A")

    direct_cols = [
        "item_A",
        "item_B",
        "dist",
        "raw_weight",
        F.lit(0).alias("__hop"),
        F.lit(None).cast(g.schema["item_B"].dataType).alias("linking_item"),
    ]
    if detail:
        direct_cols.append("link_data")
    direct = src.select(*direct_cols)

    second = g.select(F.col("item_A").alias("__mid"), F.col("item_B").alias("__to"), F.col("dist").alias("__d2"))
    if dest_items is not None:
        dest = _items(dest_items, map_lists_from)
        direct, second = semi_join(direct, dest, "item_B"), semi_join(second, dest, "__to")

    hop_cols = [
        F.col("item_A"),
        F.col("__to").alias("item_B"),
        (F.col("dist") + F.col("__d2")).alias("dist"),
        F.lit(None).cast(DoubleType()).alias("raw_weight"),
        F.lit(1).alias("__hop"),
        F.col("item_B").alias("linking_item"),
    ]
    if detail:
        hop_cols.append(F.lit(None).cast(LINK_DATA_TYPE).alias("link_data"))
    two_hop = src.join(second, src["item_B"] == second["__mid"])
    if bounded:
        two_hop = two_hop.where(F.col("__reach").isNull() | (F.col("dist") + F.col("__d2") <= F.col("__reach")))
    two_hop = two_hop.select(*hop_cols)

    cand = (
        direct.select(*direct.columns)
        .unionByName(two_hop)
        .where(F.col("item_A") != F.col("item_B"))
        .repartition("item_A")
    )
    best = top_n_per_group(
        cand,
        ["item_A", "item_B"],
        [F.col("dist").asc(), F.col("__hop").asc(), F.col("linking_item").asc(), F.col("raw_weight").desc()],
        1,
        parts=1,
    )
    top = top_n_per_group(best, ["item_A"], [F.col("dist").asc(), F.col("item_B").asc()], num_recs, "rank", parts=1)
    out = ["item_A", "item_B", reciprocal("dist").alias("weight"), "raw_weight", "rank"]
    if detail:
        out += ["link_data", "linking_item"]
    return top.select(*out)


def direct_item_recs(ii_links: DataFrame, num_recs: int) -> DataFrame:
    """Direct neighbours only, top ``num_recs`` per item_A by weight (desc)."""
    _require(ii_links, ["item_A", "item_B", "weight", "raw_weight"], "ii_links")
    top = top_n_per_group(
        ii_links.where(F.col("weight").isNotNull()),
        ["item_A"],
        [F.col("weight").desc(), F.col("item_B").asc()],
        num_recs,
        "rank",
    )
    return top.select("item_A", "item_B", "weight", "raw_weight", "rank")
