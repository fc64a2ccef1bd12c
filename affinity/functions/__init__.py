"""Column expressions shared by the operators (all JVM-side, no Python UDF)."""

from affinity.functions.columns import (
    UNITS_PER_WEIGHT,
    WEIGHT_TYPE,
    clamp_at_zero,
    logistic_scale,
    pop_boost,
    reciprocal,
    ratio,
    to_double,
    to_units,
    units_lit,
    units_to_double,
)
from affinity.functions.ranking import rank_by_global_sort, rank_within, sum_before, top_n_per_group

__all__ = [
    "UNITS_PER_WEIGHT",
    "WEIGHT_TYPE",
    "clamp_at_zero",
    "to_units",
    "units_lit",
    "units_to_double",
    "logistic_scale",
    "pop_boost",
    "reciprocal",
    "ratio",
    "to_double",
    "top_n_per_group",
    "rank_by_global_sort",
    "rank_within",
    "sum_before",
]
