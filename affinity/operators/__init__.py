"""DataFrame -> DataFrame operators of the recommender."""

from affinity.operators.graph import (
    NUM_USERS_KEY,
    aggregate_user_items,
    IdGraph,
    decode_recs,
    encode_pairs,
    graph_from_user_items,
    id_graph,
    scaled_pairs,
    add_metadata_to_item_item_links,
    adjust_item_item_graph_weight,
    build_item_item_graph,
    cap_links_per_user,
    diversify_item_item_links,
    item_popularity,
    remove_bots,
    scale_user_item_signals,
    sum_item_item_signals,
    sum_pairs_to_links,
    user_item_pairs,
)
from affinity.operators.key_filter import KeyList, key_list, semi_join
from affinity.operators.paths import (
    direct_item_recs,
    distance_graph,
    init_shortest_paths,
    item_recs_from_graph,
)
from affinity.operators.user_recs import USER_REC_COLUMNS, build_user_item_recs

__all__ = [
    "NUM_USERS_KEY",
    "aggregate_user_items",
    "IdGraph",
    "decode_recs",
    "encode_pairs",
    "graph_from_user_items",
    "id_graph",
    "scaled_pairs",
    "add_metadata_to_item_item_links",
    "adjust_item_item_graph_weight",
    "build_item_item_graph",
    "cap_links_per_user",
    "diversify_item_item_links",
    "item_popularity",
    "remove_bots",
    "scale_user_item_signals",
    "sum_item_item_signals",
    "sum_pairs_to_links",
    "user_item_pairs",
    "KeyList",
    "key_list",
    "semi_join",
    "direct_item_recs",
    "distance_graph",
    "init_shortest_paths",
    "item_recs_from_graph",
    "USER_REC_COLUMNS",
    "build_user_item_recs",
]
