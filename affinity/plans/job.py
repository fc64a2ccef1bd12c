"""The example job (M25): JSON signals -> item recs -> user recs -> stored output.

The signals are read and aggregated once (``pipelines.recommend``). Every staged table is a restart
point: a run that was killed is taken up by the next one with the same inputs and parameters at the step
that was not complete (``affinity.resume``). Both outputs are written before either replaces its old one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import SparkSession

from affinity.params import RecParams
from affinity.plans.pipelines import recommend
from affinity.resume import input_fingerprint, replace_outputs, resumable_stages
from affinity.sources import (
    Quarantine,
    load_purchases,
    load_wishlists,
    purchase_signals,
    wishlist_signals,
    write_parquet,
    write_text,
)


def run_job(
    spark: SparkSession,
    purchases_path: str,
    wishlists_path: str,
    output_path: str,
    params: RecParams = RecParams(),
    fmt: str = "text",
    job_id: str | None = None,
    on_step: Callable[[str, bool], None] | None = None,
    quarantine: Quarantine | None = None,
) -> dict[str, str]:
    """Returns the two output paths. ``fmt`` is ``text`` (tab-delimited) or ``parquet``.

    ``job_id`` names the job whose earlier run may be taken up (default: by the output path);
    ``on_step(name, reused)`` is told of each staged table. With a ``quarantine`` bad input lines are stored
    there, and only too many of them end the job.
    """
    if fmt not in ("text", "parquet"):
        raise ValueError("fmt must be 'text' or 'parquet'")
    job = job_id or f"example-{hashlib.sha256(output_path.encode()).hexdigest()[:16]}"
    inputs = [input_fingerprint(spark, p) for p in (purchases_path, wishlists_path)]
    write = write_text if fmt == "text" else write_parquet
    with resumable_stages(spark, job, repr((inputs, params, quarantine is None)), on_step):
        signals = purchase_signals(load_purchases(spark, purchases_path, quarantine)).unionByName(
            wishlist_signals(load_wishlists(spark, wishlists_path, quarantine))
        )
        item_recs, user_recs = recommend(signals, params, stage_links=True)
        return replace_outputs(
            spark,
            output_path,
            {
                "item_item_recommendation": lambda p: write(item_recs, p),
                "user_item_recommendation": lambda p: write(user_recs, p),
            },
        )
