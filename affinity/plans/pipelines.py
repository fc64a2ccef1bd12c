"""End-to-end recommenders composed from the operators (the reference's public macros).

They run on item ids from the pair expansion to the ranked recommendations; only what they
return is mapped back to item strings. The neighbourhood is ``initial_nhood_size``, or the
number of recs where that is None, as the reference passes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.operators import (
    IdGraph,
    adjust_item_item_graph_weight,
    aggregate_user_items,
    build_user_item_recs,
    decode_recs,
    diversify_item_item_links,
    encode_pairs,
    id_graph,
    item_recs_from_graph,
    scaled_pairs,
    sum_item_item_signals,
)
from affinity.params import RecParams
from affinity.session import write_rows, write_stage


def staged_graph(signals: DataFrame, p: RecParams, detail: bool = False, more_items: DataFrame | None = None) -> IdGraph:
    user_items = write_rows(scaled_pairs(aggregate_user_items(signals, p.logistic_param, detail)), "user_items")
    return id_graph(user_items, p.min_link_weight, p.max_links_per_user, detail, more_items, stage_links=True)


def _recs(adjusted: DataFrame, items: DataFrame, p: RecParams, **options) -> DataFrame:
    return decode_recs(item_recs_from_graph(adjusted, p.nhood, p.num_recs_per_item, **options), items)


def list_ids(items: DataFrame, some: DataFrame | None) -> DataFrame | None:
    """The ids of an item list (null and unknown items have none)."""
    if some is None:
        return None
    col = "item" if "item" in some.columns else some.columns[0]
    return some.select(F.col(col).alias("item")).join(items, "item").select(F.col("item_id").alias("item"))


def item_item_recs(signals: DataFrame, p: RecParams) -> DataFrame:
    """Graph -> Bayes adjustment -> best <=2-hop paths."""
    g = staged_graph(signals, p)
    return _recs(adjust_item_item_graph_weight(g.links, g.weights, p.bayesian_prior), g.items, p)


def user_item_recs(signals: DataFrame, item_recs: DataFrame, p: RecParams) -> DataFrame:
    """User recs from signals and item-item recs. The recs are staged: what comes out of
    a ranking is partitioned by item already, and Spark could not split a hot item there. So are the
    signals' greatest weights, which are read twice."""
    staged = write_stage(item_recs, "item_recs")
    return build_user_item_recs(signals, staged, p.num_recs_per_user, p.diversity_adjust, stage=True)


def item_item_recs_detailed(signals: DataFrame, p: RecParams) -> DataFrame:
    """Detailed graph (signal-type counts per link) -> adjustment -> paths."""
    g = staged_graph(signals, p, detail=True)
    return _recs(adjust_item_item_graph_weight(g.links, g.weights, p.bayesian_prior), g.items, p, detail=True)


def item_item_recs_add_signals(signals: DataFrame, item_item_signals: DataFrame, p: RecParams) -> DataFrame:
    """Add outside item-item signals before the adjustment; drop incomplete rows."""
    outside = write_stage(item_item_signals.select("item_A", "item_B", "weight"), "outside_signals")
    named = outside.select(F.explode(F.array("item_A", "item_B")).alias("item"))
    g = staged_graph(signals, p, more_items=named)
    links, weights = sum_item_item_signals(g.links, encode_pairs(outside, g.items), g.weights)
    recs = _recs(adjust_item_item_graph_weight(links, weights, p.bayesian_prior), g.items, p)
    return recs.dropna(subset=["item_A", "item_B", "weight", "rank"])


def item_item_recs_diversified(signals: DataFrame, metadata: DataFrame, p: RecParams) -> DataFrame:
    """Diversify links by target metadata before the path search."""
    g = staged_graph(signals, p)
    adjusted = adjust_item_item_graph_weight(g.links, g.weights, p.bayesian_prior)
    fields = metadata.join(g.items, "item").select(F.col("item_id").alias("item"), "metadata_field")
    return _recs(diversify_item_item_links(adjusted, fields), g.items, p)


def item_item_recs_available(
    signals: DataFrame,
    source_items: DataFrame | None,
    dest_items: DataFrame | None,
    p: RecParams,
    map_lists_from: int | None = None,
) -> DataFrame:
    """Only source items get recs, only dest items are recommended (None: all).

    Lists of at least ``map_lists_from`` items filter the graph by a bit map (``operators.key_filter``)."""
    g = staged_graph(signals, p)
    adjusted = adjust_item_item_graph_weight(g.links, g.weights, p.bayesian_prior)
    return _recs(
        adjusted,
        g.items,
        p,
        source_items=list_ids(g.items, source_items),
        dest_items=list_ids(g.items, dest_items),
        map_lists_from=map_lists_from,
    )


def item_item_recs_pop_boost(signals: DataFrame, p: RecParams, func: str = "SQRT") -> DataFrame:
    """Popularity-boosted adjustment (SQRT by default)."""
    g = staged_graph(signals, p)
    adjusted = adjust_item_item_graph_weight(g.links, g.weights, p.bayesian_prior, pop_boost_func=func)
    return _recs(adjusted, g.items, p)


def recommend(signals: DataFrame, p: RecParams, stage_links: bool = False) -> tuple[DataFrame, DataFrame]:
    """M23 + M24 as one job: ``(item_recs, user_recs)``.

    The raw signals are scanned and aggregated once: the staged user-item table feeds
    both the graph build and the user step (its ``max_weight`` column), and the item
    recs are staged before the user step reads them. ``stage_links`` also stages the summed
    links.
    """
    user_items = write_rows(aggregate_user_items(signals, p.logistic_param), "user_items")
    g = id_graph(user_items, p.min_link_weight, p.max_links_per_user, stage_links=stage_links)
    adjusted = adjust_item_item_graph_weight(g.links, g.weights, p.bayesian_prior)
    item_recs = write_stage(_recs(adjusted, g.items, p), "item_recs")
    user_recs = build_user_item_recs(user_items, item_recs, p.num_recs_per_user, p.diversity_adjust)
    return item_recs, user_recs
