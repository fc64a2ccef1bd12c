"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Fixtures and parameter sets are described in FIXTURES.md; the matching SQL is in
``affinity.plans.oracle``. Output columns are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from affinity.functions import to_double, units_to_double
from affinity.operators import (
    add_metadata_to_item_item_links,
    adjust_item_item_graph_weight,
    build_item_item_graph,
    cap_links_per_user,
    decode_recs,
    direct_item_recs,
    diversify_item_item_links,
    init_shortest_paths,
    item_popularity,
    item_recs_from_graph,
    remove_bots,
    scale_user_item_signals,
    sum_item_item_signals,
)
from affinity.params import PARAMS_E, PARAMS_T, PATH_NHOOD, RecParams
from affinity.plans import pipelines
from affinity.plans.job import run_job
from affinity.session import scratch_path
from affinity.sources import (
    BOT_THRESHOLD,
    Quarantine,
    dest_items,
    item_item_signals,
    load_inventory,
    load_purchases,
    load_text,
    load_wishlists,
    metadata_tpch,
    purchase_signals,
    read_table,
    signals_events,
    signals_tpch,
    signals_union,
    source_items,
    store_parquet,
    store_text,
    wishlist_signals,
)
from affinity.sources.json_io import inventory_in_stock, inventory_metadata

Query = Callable[[SparkSession, str], DataFrame]

REC_COLS = ["item_A", "item_B", "weight", "raw_weight", "rank"]

def _schema(*fields: str) -> StructType:
    out = StructType()
    for f in fields:
        out = out.add(*f.split(" "))
    return out


ITEM_REC_SCHEMA = _schema("item_A string", "item_B string", "weight double", "raw_weight double", "rank integer")
USER_REC_SCHEMA = _schema(
    "user string", "item string", "weight double", "reason_item string", "user_reason_item_weight double",
    "item_reason_item_weight double", "rank integer",
)

T, E = PARAMS_T, PARAMS_E
N = T.num_recs_per_item
NH = PATH_NHOOD


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[to_double(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    """The signals of the item-item graph, which returns no users: keys become strings where items are numbered."""
    return signals_tpch(spark, sf, "bigint")


def _graph(spark: SparkSession, sf: str, p: RecParams = T, detail: bool = False):
    return build_item_item_graph(
        _signals(spark, sf), p.logistic_param, p.min_link_weight, p.max_links_per_user, detail=detail, stage_links=True
    )


def _id_graph(spark: SparkSession, sf: str, p: RecParams = T, detail: bool = False):
    return pipelines.staged_graph(_signals(spark, sf), p, detail)


def _bayes(spark: SparkSession, sf: str, p: RecParams = T, detail: bool = False, **options) -> DataFrame:
    """Adjusted links on item strings; the weights of their targets come with the strings."""
    return adjust_item_item_graph_weight(_id_graph(spark, sf, p, detail).named, None, p.bayesian_prior, **options)


def _on_ids(spark: SparkSession, sf: str, step, lists=(), detail: bool = False) -> DataFrame:
    """``step`` of the adjusted links and the item lists, all on ids; what it returns on item strings."""
    g = _id_graph(spark, sf, T, detail)
    adjusted = adjust_item_item_graph_weight(g.links, g.weights, T.bayesian_prior)
    return decode_recs(step(adjusted, *(pipelines.list_ids(g.items, some) for some in lists)), g.items)


def _path_recs(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.item_item_recs(_signals(spark, sf), T.with_(initial_nhood_size=NH))


def _explode_link_data(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.explode("link_data").alias("signal_type", "n"))


# ----------------------------------------------------------------------------- sources

def q_signals_union(spark, sf):
    return signals_union(spark, sf)


def q_json_signals(spark, sf):
    """Write purchase/wishlist records as JSON lines, read back with declared schemas."""
    p_path, w_path = _json_signals(spark, sf)
    return purchase_signals(load_purchases(spark, p_path)).unionByName(
        wishlist_signals(load_wishlists(spark, w_path))
    )


def q_json_signals_quarantined(spark, sf):
    """The same lines with every one of l_linenumber 7 broken: stored and counted, the others are signals."""
    p_path, w_path = _json_signals(spark, sf)
    broken = {1: F.lit("{"), 2: F.lit("no json"), 3: F.lit("[1]"), 0: F.lit('{"row_id": "seven"}')}
    paths, quarantine = [], Quarantine(scratch_path(spark, "quarantine"), max_lines=1 << 40, max_share=0.5)
    for path in (p_path, w_path):
        lines = spark.read.text(path)
        kind = F.pmod(F.hash("value"), F.lit(4))
        wrong = F.when(kind == 0, broken[0]).when(kind == 1, broken[1]).when(kind == 2, broken[2]).otherwise(broken[3])
        seventh = F.get_json_object("value", "$.row_id") == "7"
        paths.append(scratch_path(spark, "broken"))
        lines.select(F.when(seventh, wrong).otherwise(F.col("value")).alias("value")).write.text(paths[-1])
    good = purchase_signals(load_purchases(spark, paths[0], quarantine)).unionByName(
        wishlist_signals(load_wishlists(spark, paths[1], quarantine))
    )
    bad = [
        spark.read.parquet(f"{quarantine.path}/{n}").groupBy(F.lit(f"bad {n}").alias("user")).agg(F.count(F.lit(1)).cast("double").alias("weight"))
        for n in ("purchases", "wishlists")
    ]
    counts = bad[0].unionByName(bad[1]).select("user", F.lit(None).cast("string").alias("item"), "weight")
    return good.unionByName(counts)


def q_explode_metadata(spark, sf):
    """Inventory-shaped JSON (genres array) written from ``part``, read with its schema, exploded."""
    part = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    path = scratch_path(spark, "inventory")
    part.select(
        F.split("p_name", " ").alias("genres"),
        F.col("p_partkey").cast("string").alias("movie_title"),
        F.col("p_size").cast("long").alias("stock"),
    ).write.mode("overwrite").json(path)
    return inventory_metadata(load_inventory(spark, path))


def awkward_titles(item):
    """Item strings with leading and trailing blanks, quotes, tabs, line ends, backslashes, empty and NULL."""
    n = item.cast("long") % 8
    titles = [
        F.concat(F.lit("  "), item, F.lit(" ")),
        F.concat(F.lit('"'), item, F.lit('" \'x\'')),
        F.concat(item, F.lit("\t"), item),
        F.concat(item, F.lit("\n"), item, F.lit("\r")),
        F.concat(F.lit("\\t\\N\\"), item),
        F.lit(""),
        F.lit(None).cast("string"),
    ]
    out = item
    for k, t in enumerate(titles):
        out = F.when(n == k, t).otherwise(out)
    return out


def q_text_sink_roundtrip(spark, sf):
    """Store item recs with awkward titles as Parquet and tab text (twice, overwriting), read the text back."""
    recs = pipelines.item_item_recs(_signals(spark, sf), T)
    recs = recs.withColumns({"title_A": awkward_titles(F.col("item_A")), "title_B": awkward_titles(F.col("item_B"))})
    staged = scratch_path(spark, "ii_recs_parquet")
    store_parquet(recs, staged)
    store_parquet(recs, staged)
    table = spark.read.parquet(staged)
    text = scratch_path(spark, "ii_recs_text")
    store_text(table, text)
    store_text(table, text)
    return load_text(spark, text, table.schema)


def _json_signals(spark, sf) -> tuple[str, str]:
    """Purchase and wishlist records as JSON lines in the scratch folder; returns the two paths."""
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    od = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    j = li.join(od, li["l_orderkey"] == od["o_orderkey"])
    rec = [
        F.col("l_linenumber").cast("int").alias("row_id"),
        F.col("l_partkey").cast("string").alias("movie_id"),
        F.col("l_partkey").cast("string").alias("movie_name"),
        F.col("o_custkey").cast("string").alias("user_id"),
    ]
    p_path, w_path = scratch_path(spark, "purchases"), scratch_path(spark, "wishlists")
    bought = j.where(F.col("l_returnflag") != "R").select(*rec, F.col("l_quantity").cast("int").alias("purchase_price"))
    bought.write.mode("overwrite").json(p_path)
    j.where(F.col("l_returnflag") == "R").select(*rec).write.mode("overwrite").json(w_path)
    return p_path, w_path


def q_example_job(spark, sf):
    """The whole job: JSON in, both recommendations stored as text, read back."""
    return _job_rows(spark, run_job(spark, *_json_signals(spark, sf), scratch_path(spark, "example_job"), T))


class _Killed(Exception):
    pass


def q_example_job_resumed(spark, sf):
    """The same after a run that ended behind the pair sums: its tables are taken up, the pairs not expanded again."""
    inputs, out = _json_signals(spark, sf), scratch_path(spark, "resumed_job")

    def killed(name: str, reused: bool) -> None:
        if name == "link_sums":
            raise _Killed

    def resumed(name: str, reused: bool) -> None:
        if reused != (name in ("user_items", "item_popularity", "link_sums")):
            raise RuntimeError(f"step {name} of the resumed job: reused is {reused}")

    try:
        run_job(spark, *inputs, out, T, on_step=killed)
    except _Killed:
        pass
    return _job_rows(spark, run_job(spark, *inputs, out, T, on_step=resumed))


def _job_rows(spark, paths: dict[str, str]) -> DataFrame:
    """Both stored outputs of the job as one table."""
    ii = load_text(spark, paths["item_item_recommendation"], ITEM_REC_SCHEMA)
    ui = load_text(spark, paths["user_item_recommendation"], USER_REC_SCHEMA)
    null = F.lit(None).cast("double").alias("reason_weight")
    return ii.select(
        F.lit("item").alias("kind"), F.col("item_A").alias("key"), F.col("item_B").alias("item"), "weight",
        F.lit(None).cast("string").alias("reason"), null, "raw_weight", "rank",
    ).unionByName(
        ui.select(
            F.lit("user").alias("kind"), F.col("user").alias("key"), "item", "weight", F.col("reason_item").alias("reason"),
            F.col("user_reason_item_weight").alias("reason_weight"),
            F.col("item_reason_item_weight").alias("raw_weight"), "rank",
        )
    )


# ----------------------------------------------------------------------------- graph

def q_remove_bots(spark, sf):
    return remove_bots(signals_tpch(spark, sf), BOT_THRESHOLD).select("user", "item", "weight")


def q_ui_scaled(spark, sf):
    ui = scale_user_item_signals(signals_tpch(spark, sf), T.logistic_param)
    return ui.select("user", "item", units_to_double("weight_units").alias("weight"))


def q_item_weights(spark, sf):
    return _graph(spark, sf)[1].select("item", "overall_weight")


def q_top_links_per_user(spark, sf):
    ui = scale_user_item_signals(signals_tpch(spark, sf), T.logistic_param)
    cap = cap_links_per_user(ui, item_popularity(ui), T.min_link_weight, T.max_links_per_user)
    return cap.select("user", "item", units_to_double("weight_units").alias("weight"))


def q_item_item_links(spark, sf):
    return _graph(spark, sf)[0].select("item_A", "item_B", "weight")


def q_bayes_links(spark, sf):
    return _bayes(spark, sf)


def _boost(func):
    def q(spark, sf):
        return _bayes(spark, sf, pop_boost_func=func)

    return q


def q_links_metadata(spark, sf):
    links, _ = _graph(spark, sf)
    return _dbl(add_metadata_to_item_item_links(links, metadata_tpch(spark, sf)), "weight")


def q_diversified_links(spark, sf):
    return diversify_item_item_links(_bayes(spark, sf), metadata_tpch(spark, sf))


def _summed(spark, sf):
    links, iw = _graph(spark, sf)
    return sum_item_item_signals(links, item_item_signals(spark, sf), iw)


def q_sum_item_item_links(spark, sf):
    return _summed(spark, sf)[0].select("item_A", "item_B", "weight")


def q_sum_item_item_weights(spark, sf):
    return _summed(spark, sf)[1].select("item", "overall_weight")


def q_direct_recs(spark, sf):
    return _on_ids(spark, sf, lambda links: direct_item_recs(links, N))


def q_graph_pruned(spark, sf):
    return _on_ids(spark, sf, lambda links: init_shortest_paths(links, NH)[0])


def q_paths_seed(spark, sf):
    return _on_ids(spark, sf, lambda links: init_shortest_paths(links, NH, stage_graph=True)[1])


def q_path_recs(spark, sf):
    return _path_recs(spark, sf)


def _lists(spark, sf):
    return source_items(spark, sf), dest_items(spark, sf)


def q_available_graph(spark, sf):
    return _on_ids(spark, sf, lambda links, *lists: init_shortest_paths(links, NH, *lists)[0], _lists(spark, sf))


def q_available_paths(spark, sf):
    return _on_ids(spark, sf, lambda links, *lists: init_shortest_paths(links, NH, *lists, stage_graph=True)[1], _lists(spark, sf))


def q_available_path_recs(spark, sf):
    return _on_ids(spark, sf, lambda links, *lists: item_recs_from_graph(links, NH, N, *lists), _lists(spark, sf))


# ----------------------------------------------------------------------------- detailed

def _link_data_text(c: str = "link_data"):
    """A map's entries as ``key=count``, by key."""
    entries = F.array_sort(F.map_entries(c))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")


def q_detailed_links(spark, sf):
    links, _ = _graph(spark, sf, T, detail=True)
    return links.select("item_A", "item_B", to_double("weight").alias("weight"), _link_data_text().alias("link_data"))


def q_detailed_bayes_links(spark, sf):
    return _explode_link_data(_bayes(spark, sf, detail=True), ["item_A", "item_B", "weight", "raw_weight"])


def q_detailed_graph(spark, sf):
    g = _on_ids(spark, sf, lambda links: init_shortest_paths(links, NH, detail=True)[0], detail=True)
    return _explode_link_data(g, ["item_A", "item_B", "dist", "raw_weight"])


def q_detailed_path_recs(spark, sf):
    r = _on_ids(spark, sf, lambda links: item_recs_from_graph(links, NH, N, detail=True), detail=True)
    return r.select(*REC_COLS, "linking_item")


def q_detailed_path_recs_data(spark, sf):
    r = _on_ids(spark, sf, lambda links: item_recs_from_graph(links, NH, N, detail=True), detail=True)
    return _explode_link_data(r, ["item_A", "item_B", "rank"])


def q_item_item_recs_detailed(spark, sf):
    r = pipelines.item_item_recs_detailed(_signals(spark, sf), T)
    return r.select(*REC_COLS, "linking_item", F.col("link_data")["NUM_USERS"].alias("num_users"))


# ----------------------------------------------------------------------------- composed

def q_item_item_recs(spark, sf):
    return pipelines.item_item_recs(_signals(spark, sf), T)


def q_item_item_recs_add_signals(spark, sf):
    return pipelines.item_item_recs_add_signals(_signals(spark, sf), item_item_signals(spark, sf), T)


def q_item_item_recs_diversified(spark, sf):
    return pipelines.item_item_recs_diversified(_signals(spark, sf), metadata_tpch(spark, sf), T)


def q_item_item_recs_available(spark, sf):
    return pipelines.item_item_recs_available(
        _signals(spark, sf), source_items(spark, sf), dest_items(spark, sf), T
    )


def q_available_recs_mapped_lists(spark, sf):
    """Source and dest lists filter the graph by a bit map of their keys before it is shuffled to them."""
    recs = lambda links, *lists: item_recs_from_graph(links, NH, N, *lists, map_lists_from=1)
    return _on_ids(spark, sf, recs, _lists(spark, sf))


def q_item_item_recs_in_stock(spark, sf):
    """Only items in stock are recommended; the stock comes from an inventory in JSON lines."""
    part = read_table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    path = scratch_path(spark, "inventory")
    part.select(
        F.split("p_name", " ").alias("genres"),
        F.col("p_partkey").cast("string").alias("movie_title"),
        (F.col("p_size") % 4).cast("long").alias("stock"),
    ).write.mode("overwrite").json(path)
    in_stock = inventory_in_stock(load_inventory(spark, path))
    return pipelines.item_item_recs_available(_signals(spark, sf), None, in_stock, T)


def q_item_item_recs_pop_boost(spark, sf):
    return pipelines.item_item_recs_pop_boost(_signals(spark, sf), T, "SQRT")


def q_item_item_recs_events(spark, sf):
    return pipelines.item_item_recs(signals_events(spark, sf), E)


# ----------------------------------------------------------------------------- user recs

def _refine(diverse: bool) -> Query:
    def q(spark, sf):
        sig = signals_tpch(spark, sf)
        return pipelines.user_item_recs(sig, _path_recs(spark, sf), T.with_(diversity_adjust=diverse))

    return q


def q_user_item_recs(spark, sf):
    return pipelines.recommend(signals_tpch(spark, sf), T)[1]


def q_user_item_recs_signed(spark, sf):
    return pipelines.recommend(signals_events(spark, sf, signed=True), E)[1]


QUERIES: dict[str, Query] = {
    "signals_union": q_signals_union,
    "json_signals": q_json_signals,
    "json_signals_quarantined": q_json_signals_quarantined,
    "explode_metadata": q_explode_metadata,
    "text_sink_roundtrip": q_text_sink_roundtrip,
    "remove_bots": q_remove_bots,
    "ui_scaled": q_ui_scaled,
    "item_weights": q_item_weights,
    "top_links_per_user": q_top_links_per_user,
    "item_item_links": q_item_item_links,
    "bayes_links": q_bayes_links,
    "pop_boost_sqrt": _boost("SQRT"),
    "pop_boost_log": _boost("LOG"),
    "pop_boost_linear": _boost(""),
    "links_metadata": q_links_metadata,
    "diversified_links": q_diversified_links,
    "sum_item_item_links": q_sum_item_item_links,
    "sum_item_item_weights": q_sum_item_item_weights,
    "direct_recs": q_direct_recs,
    "graph_pruned": q_graph_pruned,
    "paths_seed": q_paths_seed,
    "path_recs": q_path_recs,
    "available_graph": q_available_graph,
    "available_paths": q_available_paths,
    "available_path_recs": q_available_path_recs,
    "available_recs_mapped_lists": q_available_recs_mapped_lists,
    "detailed_links": q_detailed_links,
    "detailed_bayes_links": q_detailed_bayes_links,
    "detailed_graph": q_detailed_graph,
    "detailed_path_recs": q_detailed_path_recs,
    "detailed_path_recs_data": q_detailed_path_recs_data,
    "item_item_recs": q_item_item_recs,
    "item_item_recs_detailed": q_item_item_recs_detailed,
    "item_item_recs_add_signals": q_item_item_recs_add_signals,
    "item_item_recs_diversified": q_item_item_recs_diversified,
    "item_item_recs_available": q_item_item_recs_available,
    "item_item_recs_in_stock": q_item_item_recs_in_stock,
    "item_item_recs_pop_boost": q_item_item_recs_pop_boost,
    "item_item_recs_events": q_item_item_recs_events,
    "refine_user_recs": _refine(False),
    "refine_user_recs_diverse": _refine(True),
    "user_item_recs_signed": q_user_item_recs_signed,
    "user_item_recs": q_user_item_recs,
    "example_job": q_example_job,
    "example_job_resumed": q_example_job_resumed,
}
