"""User-item recommendations from item-item recommendations.

For every signal (user, item) and every rec (item -> item_B) of that item, a candidate
(user, item_B) scores ``sqrt(max(signal weight, 0) * rec weight)`` with the signal's
item as the reason. Items the user already has any signal on are removed, the best
reason per (user, item) wins, an optional diversity adjustment divides the r-th
candidate of one reason by (r + 1), and the top N per user are ranked. The output
weight is the unadjusted score.

Signals are first reduced to the greatest weight per (user, item): the score is
monotone in the signal weight, so this keeps the same winner (ties of clamped scores
go to the greatest signal weight) while the join input shrinks to distinct pairs.

Signals without a user or item are dropped: a recommendation for no one cannot be shown.

Scale notes
-----------
* Candidate generation joins signals to at most ``num_recs`` recs per item; a hot item
  makes a skewed join partition that AQE splits (or the rec side is broadcast when its
  measured size is small).
* Best-reason and seen filter both run on (user, item) partitions, so a hot user is
  spread over its items; the diversity rank runs per (user, reason), which holds at
  most ``num_recs_per_item`` candidates; the final top-N per user uses a partial group
  limit before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions import clamp_at_zero, rank_within, to_double, top_n_per_group
from affinity.operators.graph import _require
from affinity.session import write_stage

USER_REC_COLUMNS = [
    "user",
    "item",
    "weight",
    "reason_item",
    "user_reason_item_weight",
    "item_reason_item_weight",
    "rank",
]


def build_user_item_recs(
    signals: DataFrame,
    item_recs: DataFrame,
    num_recs: int,
    diversity_adjust: bool = False,
    stage: bool = False,
) -> DataFrame:
    """User recs from raw signals ``(user, item, weight)`` or from the user-item table
    of ``aggregate_user_items`` (``max_weight`` column), which a job that already built
    its graph passes to avoid a second pass over the raw signals. ``stage`` writes the greatest weight of each
    user and item of raw signals once, for the candidates and for the seen filter."""
    _require(item_recs, ["item_A", "item_B", "weight", "raw_weight"], "item_recs")
    if "max_weight" in signals.columns:
        seen = signals.select("user", "item", F.col("max_weight").alias("__sw"))
    else:
        _require(signals, ["user", "item", "weight"], "signals")
        seen = (
            signals.where(F.col("user").isNotNull() & F.col("item").isNotNull())
            .groupBy("user", "item")
            .agg(F.max(to_double("weight")).alias("__sw"))
        )
        seen = write_stage(seen, "seen_items") if stage else seen
    recs = item_recs.select(
        F.col("item_A").alias("item"),
        F.col("item_B").alias("__rec"),
        to_double("weight").alias("__rw"),
        to_double("raw_weight").alias("__raw"),
    )
    cand = seen.join(recs, "item").select(
        "user",
        F.col("__rec").alias("item"),
        F.sqrt(clamp_at_zero("__sw") * F.col("__rw")).alias("weight"),
        F.col("item").alias("reason_item"),
        F.col("__sw").alias("user_reason_item_weight"),
        F.col("__raw").alias("item_reason_item_weight"),
    )
    best = top_n_per_group(
        cand, ["user", "item"], [F.col("weight").desc(), F.col("reason_item").asc()], 1, parts=1
    )
    unseen = best.join(seen.select("user", "item"), ["user", "item"], "left_anti")
    if diversity_adjust:
        ranked = rank_within(
            unseen, ["user", "reason_item"], [F.col("weight").desc(), F.col("item").asc()], "__rr"
        )
        scored = ranked.withColumn("__adj", F.col("weight") / (F.col("__rr") + F.lit(1)).cast("double"))
    else:
        scored = unseen.withColumn("__adj", F.col("weight"))
    top = top_n_per_group(
        scored, ["user"], [F.col("__adj").desc(), F.col("item").asc()], num_recs, "rank"
    )
    return top.select(*USER_REC_COLUMNS)
