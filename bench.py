"""Benchmark: headline recommender jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}. Each query is
run to completion with the ``noop`` sink (all rows computed, nothing collected).
Session start-up and one warm-up run of the item-item job on the sf0.001 tables
(JVM and code generation) are excluded from the per-query times and reported separately.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from affinity.operators import (  # noqa: E402
    adjust_item_item_graph_weight,
    aggregate_user_items,
    distance_graph,
    id_graph,
)
from affinity.params import PARAMS_B, PARAMS_E  # noqa: E402
from affinity.plans import pipelines  # noqa: E402
from affinity.session import local_session, temporary_stages, write_stage  # noqa: E402
from affinity.sources import (  # noqa: E402
    dest_items,
    item_item_signals,
    metadata_tpch,
    signals_events,
    signals_tpch,
    source_items,
)


def _run(df) -> int:
    """Compute all rows and return their number, counted on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return seen.get["rows"]


def _shape(spark, sf_dir: str, p) -> dict[str, int]:
    """Rows of each step of the item-item job (not timed)."""
    user_items = write_stage(aggregate_user_items(signals_tpch(spark, sf_dir), p.logistic_param), "user_items")
    g = id_graph(user_items, p.min_link_weight, p.max_links_per_user)
    links = write_stage(adjust_item_item_graph_weight(g.links, g.weights, p.bayesian_prior), "links")
    return {
        "user_items": user_items.count(),
        "items": g.items.count(),
        "links": links.count(),
        "pruned_graph": distance_graph(links, p.nhood).count(),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    t0 = time.time()
    spark = local_session(
        cores=cpus,
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        app="affinity-bench",
        event_log_dir=os.environ.get("BENCH_EVENT_LOG_DIR") or None,
    )
    startup = time.time() - t0

    P = PARAMS_B

    # JVM / code-generation warm-up on the smallest tables, reported separately.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    t0 = time.time()
    if os.path.isdir(warm_dir):
        _run(pipelines.item_item_recs(signals_tpch(spark, warm_dir), P))
    else:
        _run(signals_tpch(spark, sf_dir).groupBy("user").count())
    warmup = time.time() - t0

    def item_item_recs():
        return _run(pipelines.item_item_recs(signals_tpch(spark, sf_dir), P))

    def user_item_recs():
        # The whole job: one pass over the signals, item recs staged, user recs from them.
        return _run(pipelines.recommend(signals_tpch(spark, sf_dir), P)[1])

    def user_item_recs_diverse():
        return _run(pipelines.recommend(signals_tpch(spark, sf_dir), P.with_(diversity_adjust=True))[1])

    def item_item_recs_events():
        return _run(pipelines.item_item_recs(signals_events(spark, sf_dir), PARAMS_E))

    def item_item_recs_diversified():
        return _run(pipelines.item_item_recs_diversified(signals_tpch(spark, sf_dir), metadata_tpch(spark, sf_dir), P))

    def item_item_recs_available():
        return _run(
            pipelines.item_item_recs_available(
                signals_tpch(spark, sf_dir), source_items(spark, sf_dir), dest_items(spark, sf_dir), P
            )
        )

    def item_item_recs_add_signals():
        return _run(pipelines.item_item_recs_add_signals(signals_tpch(spark, sf_dir), item_item_signals(spark, sf_dir), P))

    def item_item_recs_pop_boost():
        return _run(pipelines.item_item_recs_pop_boost(signals_tpch(spark, sf_dir), P, "SQRT"))

    def item_item_recs_detailed():
        return _run(pipelines.item_item_recs_detailed(signals_tpch(spark, sf_dir), P))

    jobs = [
        item_item_recs,
        user_item_recs,
        user_item_recs_diverse,
        item_item_recs_events,
        item_item_recs_diversified,
        item_item_recs_available,
        item_item_recs_add_signals,
        item_item_recs_pop_boost,
        item_item_recs_detailed,
    ]
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for job in jobs:
        with temporary_stages(spark):
            t0 = time.time()
            rows[job.__name__] = job()
            times[job.__name__] = round(time.time() - t0, 3)
    with temporary_stages(spark):
        shape = _shape(spark, sf_dir, P)
        indirect = pipelines.item_item_recs(signals_tpch(spark, sf_dir), P).where("raw_weight IS NULL").count()

    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "params": "B: logistic 0.5, min link 0.25, cap 50, prior 4.0, nhood 10, 10 recs per item and user",
        "rows": rows,
        "steps": {**shape, "indirect_recs": indirect},
        "startup_sec": round(startup, 3),
        "warmup_sec": round(warmup, 3),
        "warmup": f"one item_item_recs run on {warm_dir}, excluded from value",
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
