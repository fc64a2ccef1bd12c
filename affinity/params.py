"""Job parameters (the reference's ``%default`` / ``$NAME`` values)."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class RecParams:
    """Knobs of the recommender.

    logistic_param      steepness of the diminishing-returns scaling of user-item weights
    min_link_weight     items and item-item links below this summed weight are dropped (inclusive keep)
    max_links_per_user  only a user's strongest items are paired (bounds pair expansion to k*(k-1))
    bayesian_prior      pseudo-count added to the target item's popularity
    num_recs_per_item   item-item recs kept per source item
    initial_nhood_size  direct neighbours kept per item before the two-hop search (None: num_recs_per_item)
    num_recs_per_user   user-item recs kept per user
    diversity_adjust    spread a user's recs over different reason items
    """

    logistic_param: float = 0.5
    min_link_weight: float = 0.25
    max_links_per_user: int = 50
    bayesian_prior: float = 4.0
    num_recs_per_item: int = 10
    initial_nhood_size: int | None = None
    num_recs_per_user: int = 10
    diversity_adjust: bool = False

    def __post_init__(self) -> None:
        for name in ("max_links_per_user", "num_recs_per_item", "initial_nhood_size", "num_recs_per_user"):
            if getattr(self, name) is not None and int(getattr(self, name)) < 1:
                raise ValueError(f"{name} must be >= 1")

    @property
    def nhood(self) -> int:
        return self.num_recs_per_item if self.initial_nhood_size is None else self.initial_nhood_size

    def with_(self, **kw) -> "RecParams":
        return replace(self, **kw)


# Fixed parameter sets used by the test fixtures and the benchmark.
PARAMS_T = RecParams(0.5, 0.25, 50, 4.0, 10, None, 10)  # tpch default
PARAMS_E = RecParams(0.5, 0.5, 20, 4.0, 10, 3, 10)  # events
PARAMS_B = RecParams(0.5, 0.25, 50, 4.0, 10, None, 10)  # benchmark, tpch sf0.1
# Neighbourhood of the keys that run the path operators by themselves.
PATH_NHOOD = 3
