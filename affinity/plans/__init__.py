"""Composed recommenders, the example job, and the query catalogue."""

from affinity.plans.pipelines import (
    item_item_recs,
    item_item_recs_add_signals,
    item_item_recs_available,
    item_item_recs_detailed,
    item_item_recs_diversified,
    item_item_recs_pop_boost,
    recommend,
    user_item_recs,
)
