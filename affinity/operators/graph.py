"""Item-item graph construction and link re-weighting.

Inputs are signal DataFrames ``(user string, item string, weight double[, signal_type string])``; users and items may
be integers where the result has no users and items are numbered (``id_graph``), which makes the rows shorter.
Inside the graph build, weights are exact LONG counts of 1e-9 units (``weight_units``);
the public results carry DOUBLE ``weight`` = units / 1e9.

Scale notes
-----------
* The (user, item) sum is a hash aggregate with a map-side partial step.
* Raw weights become units before the first sum, so every sum of the graph is an integer
  sum: exact, and the same for any partitioning.
* The aggregated user-item table and the popularity table are staged in the shared
  checkpoint folder (restart points; exact sizes for the planner). Popularity is a
  plain ``groupBy(item)`` (partial aggregation, so a hot item is pre-summed on every
  mapper); weak items are removed with a join against it that is broadcast only when
  the staged table is small, and otherwise shuffled with AQE splitting a hot item.
* The per-user cap is ``row_number() <= k``: Spark adds a partial group limit before
  the shuffle, so a bot user with a third of all rows ships at most k rows per map
  partition. The pair expansion then emits at most k*(k-1)/2 unordered pairs per
  user -- this cap is the reference's own ``max_links_per_user`` knob.
* Each unordered pair is emitted once (``item_A < item_B``) on item ids from the staged popularity
  table, summed and mirrored after the threshold. The largest shuffle of the job carries one row for each item of
  a user, with the lists of the user's items of greater id: about one short id per pair, once. Where a task would expand most
  pairs several times (few items), it sums them first and shuffles the sums. Ids follow the order of the items, so ties
  by id are ties by item, and the recommenders adjust, prune and search on ids; only what
  they return is mapped back to item strings.
* The outside-signal merge avoids a full outer join (which AQE cannot split).
"""

from __future__ import annotations

from contextlib import nullcontext
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, MapType, StringType

from affinity.session import shuffle_to, write_rows, write_stage
from affinity.functions import (
    logistic_scale,
    pop_boost,
    rank_by_global_sort,
    ratio,
    to_double,
    to_units,
    top_n_per_group,
    units_lit,
    units_to_double,
)

# Fixed value: the link-data key that counts the users behind a link.
NUM_USERS_KEY = "NUM_USERS"

# More signal types than this are summed as rows, not as columns.
MAX_TYPE_COLUMNS = 16

# Rows of the pair expansion that a task sums at most (some 100 bytes each), and at least where cores are idle.
PAIRS_PER_TASK, LEAST_PAIRS_PER_TASK = 5_000_000, 250_000
# Pairs of one item, those with greater ids, that are left to one task at most.
PAIRS_PER_ITEM = 1_000_000
# So many times the tasks sum the pairs of stripes: Spark sums what lies together already in two steps, both held at once.
STRIPE_TASKS = 2

LINK_DATA_TYPE = MapType(StringType(), LongType())


def _require(df: DataFrame, cols: list[str], what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} is missing columns {missing}; has {df.columns}")


# --------------------------------------------------------------------------- signals

def aggregate_user_items(signals: DataFrame, logistic_param: float, detail: bool = False) -> DataFrame:
    """The user-item table: one row per (user, item) with non-NULL keys.

    Columns: ``weight_units`` (LONG, logistic scaling of the summed weight; NULL when every
    weight of the pair is NULL), ``max_weight`` (greatest raw weight, used by the
    user-item step) and, with ``detail``, ``signal_types``: an array of (k, n) entries
    counting rows per signal type (a type named ``NUM_USERS`` is an error: that key is
    reserved for links). Weights are summed in units, rounded at the 9th place before the
    sum; a weight or sum beyond 2^63 units is an error. Both the graph build and the user step read this one table,
    so raw signals are scanned and aggregated once per job. Keys keep their type: integers make shorter rows than their
    digits, and ``id_graph`` takes them too.
    """
    _require(signals, ["user", "item", "weight"] + (["signal_type"] if detail else []), "signals")
    s = signals.where(F.col("user").isNotNull() & F.col("item").isNotNull())
    w, u = to_double("weight"), to_units("weight")
    if not detail:
        agg = s.groupBy("user", "item").agg(F.sum(u).alias("__u"), F.max(w).alias("max_weight"))
        extra = []
    else:
        reserved = F.concat(F.lit("signal type "), F.lit(NUM_USERS_KEY), F.lit(" is reserved for links"))
        kind = F.when(F.col("signal_type") == NUM_USERS_KEY, F.raise_error(reserved).cast("string")).otherwise(
            F.col("signal_type")
        )
        per_type = s.select("user", "item", kind.alias("signal_type"), "weight").groupBy("user", "item", "signal_type").agg(
            F.sum(u).alias("__ut"), F.max(w).alias("__mx"), F.count(F.lit(1)).alias("__n")
        )
        agg = per_type.groupBy("user", "item").agg(
            F.sum("__ut").alias("__u"),
            F.max("__mx").alias("max_weight"),
            F.collect_list(
                F.when(
                    F.col("signal_type").isNotNull(), F.struct(F.col("signal_type").alias("k"), F.col("__n").alias("n"))
                )
            ).alias("signal_types"),
        )
        extra = ["signal_types"]
    scaled = logistic_scale(units_to_double("__u"), logistic_param)
    return agg.select("user", "item", scaled.alias("weight_units"), "max_weight", *extra)


def scale_user_item_signals(signals: DataFrame, logistic_param: float, detail: bool = False) -> DataFrame:
    """Sum signals per (user, item) and apply the logistic scaling -> ``weight_units`` (LONG).

    Rows with a NULL user or item are dropped; NULL weights count as no evidence
    (SUM skips them; a pair with only NULL weights has no weight and is dropped).
    """
    return scaled_pairs(aggregate_user_items(signals, logistic_param, detail))


def scaled_pairs(user_items: DataFrame) -> DataFrame:
    """The rows of the user-item table that carry a weight (input of the graph build)."""
    cols = ["user", "item", "weight_units"] + (["signal_types"] if "signal_types" in user_items.columns else [])
    return user_items.where(F.col("weight_units").isNotNull()).select(*cols)


def item_popularity(ui_scaled: DataFrame) -> DataFrame:
    """``overall_units`` per item: the exact sum of its scaled user weights (all items)."""
    return ui_scaled.groupBy("item").agg(F.sum("weight_units").alias("overall_units"))


def cap_links_per_user(
    ui_scaled: DataFrame, item_weights: DataFrame, min_link_weight: float, max_links_per_user: int
) -> DataFrame:
    """Drop weak items (``overall_weight >= min`` is kept), then keep each user's top-k items.

    When the popularity table carries an ``item_id`` (see ``graph_from_user_items``) the
    id rides along, so the pair expansion can key on it."""
    keep = ["item"] + [c for c in ("item_id", "parts") if c in item_weights.columns]
    # Ids follow the order of the items, so ties are broken alike, and no item is shuffled beside its id.
    tie = "item_id" if "item_id" in keep else "item"
    strong = item_weights.where(F.col("overall_units") >= units_lit(min_link_weight)).select(*keep)
    ui_filt = ui_scaled.join(strong, "item", "inner" if len(keep) > 1 else "left_semi")
    return top_n_per_group(
        ui_filt, ["user"], [F.col("weight_units").desc(), F.col(tie).asc()], max_links_per_user
    )


def few_signal_types(ui_scaled: DataFrame, most: int = MAX_TYPE_COLUMNS) -> list[str] | None:
    """The signal types of a user-item table in order, or None if there are more than ``most``."""
    kinds = ui_scaled.select(F.explode("signal_types").alias("t")).select("t.k").distinct().limit(most + 1).collect()
    return sorted(r["k"] for r in kinds) if len(kinds) <= most else None


def _count_of(kind: str) -> Column:
    """A user-item row's count of a signal type."""
    own = F.filter("signal_types", lambda e: e["k"] == kind)
    return F.coalesce(F.get(own, F.lit(0))["n"], F.lit(0).cast("long"))


def user_item_pairs(capped: DataFrame, detail: bool = False, types: list[str] | None = None) -> DataFrame:
    """Each unordered pair of a user's items once: ``item_A < item_B``, weight ``least(w_A, w_B)``.

    Keys are the 64-bit ``item_id`` when present (8 bytes per key in the largest
    shuffle of the job, cheap to hash and sort), otherwise the item strings. With ``detail``
    a pair also has both items' counts of each signal type: a column for each of ``types``
    (``type_0``, ...), or one array ``link_terms`` where they are not given."""
    key = "item_id" if "item_id" in capped.columns else "item"

    def side(item: str, tag: str) -> DataFrame:
        extra = []
        if detail and types is None:
            extra = [F.col("signal_types").alias(f"__m{tag}")]
        elif detail:
            for i, t in enumerate(types):
                extra.append(_count_of(t).alias(f"__{tag}{i}"))
        return capped.select("user", F.col(key).alias(item), F.col("weight_units").alias(f"__w{tag}"), *extra)

    p = side("item_A", "A").join(side("item_B", "B"), "user").where(F.col("item_A") < F.col("item_B"))
    cols = [F.col("item_A"), F.col("item_B"), F.least("__wA", "__wB").alias("weight_units")]
    if detail and types is None:
        cols.append(F.concat("__mA", "__mB").alias("link_terms"))
    elif detail:
        cols += [(F.col(f"__A{i}") + F.col(f"__B{i}")).alias(f"type_{i}") for i in range(len(types))]
    return p.select(*cols)


def pair_tasks(ui_scaled: DataFrame, max_links_per_user: int, detail: bool = False, types: list[str] | None = None) -> int:
    """How many tasks are to expand and to sum the pairs, so that none holds over ``PAIRS_PER_TASK`` of them.

    A user with n items left has n * (n - 1) / 2 pairs, so all have at most (max_links_per_user - 1) / 2 a row.
    Where types are summed as rows, a pair has one for each type of both its items and one for its weight.
    """
    rows, kinds = F.count(F.lit(1)), F.lit(0)
    if detail and types is None:
        kinds = F.coalesce(F.sum(F.size("signal_types")), F.lit(0))
    rows, kinds = ui_scaled.agg(rows, kinds).first()
    pairs = rows * (max_links_per_user - 1) / 2 * (1 + 2 * kinds / max(rows, 1))
    least = min(ui_scaled.sparkSession.sparkContext.defaultParallelism, ceil(pairs / LEAST_PAIRS_PER_TASK))
    return max(ceil(pairs / PAIRS_PER_TASK), least, 1)


def _id_pieces(item: str, id_bits: int) -> dict[str, Column]:
    """An id as it lies in a list: ids of up to 24 bits as a SHORT and a BYTE, from their least value on."""
    if id_bits > 24:
        return {"id": F.col(item).cast("int" if id_bits <= 31 else "long")}
    low, high = F.col(item).bitwiseAND(F.lit(0xFFFF)), F.shiftright(item, 16)
    return {"low": (low - 0x8000).cast("short"), "high": (high - 0x80).cast("byte")}


def user_item_stripes(capped: DataFrame, id_bits: int, counts: dict[str, Column] | None = None) -> DataFrame:
    """Each user's pairs as one row an item: ``item_A`` with the ids, weights and ``counts`` of the user's items of greater id.

    A pair costs little more than one id here (3 bytes where they suffice for all), where a row of its own holds both
    and a header. Weights are the pairs', the lesser of both. Lists are in the order of the values, which are few, so that they
    lie in runs. An item with several ``parts`` has a row for each, with its share of the ids."""
    counts = counts or {}
    values = ["weight_units", *counts]
    pieces = _id_pieces("item_A", id_bits)
    id_type = "int" if id_bits <= 31 else "long"
    owner = ["item_A"] + (["parts"] if "parts" in capped.columns else [])
    rows = capped.withColumns({"item_A": F.col("item_id").cast(id_type), **counts}).select("user", *owner, *values)
    whole = Window.partitionBy("user").orderBy(*values, "item_A").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    entry = F.struct("item_A", *values, *(c.alias(k) for k, c in pieces.items()))
    rows = rows.withColumn("__all", F.collect_list(entry).over(whole))
    rows = rows.withColumn("__rest", F.filter("__all", lambda e: e["item_A"] > F.col("item_A")))
    if "parts" in owner:
        rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        share = F.filter("__rest", lambda e: F.pmod(F.xxhash64(e["item_A"]), F.col("parts")) == F.col("part"))
        rows = rows.withColumn("__rest", F.when(F.col("parts") > 1, share).otherwise(F.col("__rest")))
    lists = [F.col(f"__rest.{c}").alias(f"__{c}_list") for c in (*pieces, *counts)]
    least = F.transform("__rest", lambda e: F.least(e["weight_units"], F.col("weight_units")))
    part = ["part"] if "parts" in owner else []
    return rows.select("item_A", *part, *counts, *lists, least.alias("__weight_units_list"))


def stripe_pairs(stripes: DataFrame, tasks: int) -> DataFrame:
    """The pairs of ``user_item_stripes``, those of an item (and part) in one of so many tasks: their sum is not shuffled again."""
    owner = [c for c in ("item_A", "part") if c in stripes.columns]
    counts = [c for c in stripes.columns if c.startswith("__counts") and not c.endswith("_list")]
    dealt = stripes.repartition(tasks, *owner)
    other = lambda c: F.get(f"__{c}_list", F.col("__at"))
    if "__id_list" in stripes.columns:
        rows = dealt.select("*", F.posexplode("__id_list").alias("__at", "item_B"))
    else:
        rows = dealt.select("*", F.posexplode("__low_list").alias("__at", "__low"))
        high = F.shiftleft(other("high").cast("int") + 0x80, 16)
        rows = rows.withColumn("item_B", high + F.col("__low").cast("int") + 0x8000)
    # The first place of the first counts is the users': a row is one.
    sums = [(F.col(c) + other(c) + F.lit(int(i == 0))).alias(c) for i, c in enumerate(counts)]
    return rows.select(*owner, "item_B", other("weight_units").alias("weight_units"), *sums)


def _mirror(links: DataFrame) -> DataFrame:
    """Emit every row in both directions in one pass (no second scan of the input plan)."""
    rest = [c for c in links.columns if c not in ("item_A", "item_B")]
    both = F.explode(
        F.array(
            F.struct(F.col("item_A").alias("a"), F.col("item_B").alias("b")),
            F.struct(F.col("item_B").alias("a"), F.col("item_A").alias("b")),
        )
    ).alias("__d")
    return links.select(both, *rest).select(
        F.col("__d.a").alias("item_A"), F.col("__d.b").alias("item_B"), *rest
    )


def _decode(links: DataFrame, items: DataFrame) -> DataFrame:
    """Replace id keys by item strings."""
    rest = [c for c in links.columns if c not in ("item_A", "item_B")]
    a = items.select(F.col("item_id").alias("item_A"), F.col("item").alias("__a"))
    b = items.select(F.col("item_id").alias("item_B"), F.col("item").alias("__b"))
    return links.join(a, "item_A").join(b, "item_B").select(
        F.col("__a").alias("item_A"), F.col("__b").alias("item_B"), *rest
    )


def sum_pairs_to_links(
    pairs: DataFrame,
    min_link_weight: float,
    detail: bool = False,
    types: list[str] | None = None,
    stage: bool = False,
    id_bits: int | None = None,
    count_bits: int | None = None,
) -> DataFrame:
    """Sum pair weights per (item_A, item_B), keep ``>= min`` (inclusive), emit both
    directions with exact ``weight_units`` and DOUBLE ``weight``.

    With ``detail`` and few ``types`` the counts are columns of the one sum by pair.
    Otherwise the pairs are expanded once: each pair's type counts and, with k NULL,
    its weight are rows of one sum by (item_A, item_B, k), pre-aggregated before the
    shuffle, so a pair that many users share is summed on every mapper. The rows with k
    NULL also count the users. The few rows left of each pair are folded into its weight
    and its map. ``stage`` writes the sums first, one direction of each link: a restart point
    behind the pair expansion.

    Where ids have at most ``id_bits`` bits (31 or fewer), both of a pair are one LONG key; where no count of a link
    needs more than ``count_bits``, the counts are summed side by side in as few LONGs as hold them. Pairs from
    ``stripe_pairs`` have them so already, and lie together by ``item_A`` (and ``part``), which stay keys of their own.
    """
    return _links_from_sums(_sum_pairs(pairs, min_link_weight, detail, types, stage, id_bits, count_bits), types, count_bits)


def _sum_pairs(
    pairs: DataFrame,
    min_link_weight: float,
    detail: bool = False,
    types: list[str] | None = None,
    stage: bool = False,
    id_bits: int | None = None,
    count_bits: int | None = None,
) -> DataFrame:
    """The sums of ``sum_pairs_to_links``, one direction of each link, its counts as they were summed."""
    key = [c for c in ("item_A", "part", "item_B") if c in pairs.columns]
    if packed := id_bits is not None and id_bits <= 31:
        key = ["__pair"]
        rest = [c for c in pairs.columns if c not in ("item_A", "item_B")]
        pairs = pairs.select(F.shiftleft("item_A", id_bits).bitwiseOR(F.col("item_B")).alias("__pair"), *rest)
    if not detail:
        half = pairs.groupBy(*key).agg(F.sum("weight_units").alias("weight_units"))
        extra = []
    elif types is not None:
        if "__counts0" not in pairs.columns:
            counts = {"users": F.lit(1).cast("long"), **{f"type_{i}": F.col(f"type_{i}") for i in range(len(types))}}
            pairs = pairs.withColumns(_packed_counts(counts, count_bits))
        extra = [c for c in pairs.columns if c.startswith("__counts")]
        half = pairs.groupBy(*key).agg(F.sum("weight_units").alias("weight_units"), *(F.sum(c).alias(c) for c in extra))
    else:
        weight = F.array(F.struct(F.lit(None).cast("string").alias("k"), F.col("weight_units").alias("n")))
        terms = pairs.select(*key, F.inline(F.concat("link_terms", weight)))
        per_key = terms.groupBy(*key, "k").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
        total = F.col("k").isNull()
        half = per_key.groupBy(*key).agg(
            F.sum(F.when(total, F.col("n"))).alias("weight_units"),
            F.sum(F.when(total, F.col("rows"))).alias("users"),
            F.collect_list(F.when(~total, F.struct("k", "n"))).alias("types"),
        )
        users = F.array(F.struct(F.lit(NUM_USERS_KEY).alias("k"), F.col("users").alias("n")))
        half = half.withColumn("link_data", F.map_from_entries(F.concat("types", users)))
        extra = ["link_data"]
    if packed:
        pair = F.col("__pair")
        ids = [F.shiftright(pair, id_bits).alias("item_A"), pair.bitwiseAND(F.lit((1 << id_bits) - 1)).alias("item_B")]
    else:
        short = pairs.schema["item_A"].dataType == IntegerType()
        ids = [F.col(c).cast("long").alias(c) if short else c for c in ("item_A", "item_B")]
    kept = half.where(F.col("weight_units") >= units_lit(min_link_weight)).select(*ids, "weight_units", *extra)
    return write_stage(kept, "link_sums") if stage else kept


def _links_from_sums(sums: DataFrame, types: list[str] | None, count_bits: int | None) -> DataFrame:
    """Both directions of ``_sum_pairs``, with DOUBLE weights and the counts as ``link_data``."""
    extra = [c for c in sums.columns if c == "link_data"]
    if "__counts0" in sums.columns:
        found = {}
        for at, names in enumerate(_places(["users", *(f"type_{i}" for i in range(len(types)))], count_bits)):
            for i, c in enumerate(names):
                found[c] = F.col(f"__counts{at}")
                if len(names) > 1:
                    found[c] = F.shiftright(found[c], i * count_bits).bitwiseAND(F.lit((1 << count_bits) - 1))
        entry = lambda k, n: F.struct(F.lit(k).alias("k"), found[n].alias("n"))
        entries = F.array(entry(NUM_USERS_KEY, "users"), *(entry(t, f"type_{i}") for i, t in enumerate(types)))
        sums = sums.withColumn("link_data", F.map_from_entries(F.filter(entries, lambda e: e["n"] > 0)))
        extra = ["link_data"]
    return _mirror(
        sums.select("item_A", "item_B", units_to_double("weight_units").alias("weight"), "weight_units", *extra)
    )


def _places(names: list[str], bits: int | None) -> list[list[str]]:
    """Which counts share a LONG: as many as have room, each of its own where ``bits`` is None."""
    each = 1 if bits is None else max(63 // max(bits, 1), 1)
    return [names[i : i + each] for i in range(0, len(names), each)]


def _packed_counts(counts: dict[str, Column], bits: int | None) -> dict[str, Column]:
    """The counts side by side as ``__counts0``, ..."""
    out = {}
    for at, names in enumerate(_places(list(counts), bits)):
        total = counts[names[0]]
        for i, c in enumerate(names[1:], 1):
            total = total + F.shiftleft(counts[c], i * bits)
        out[f"__counts{at}"] = total
    return out


# --------------------------------------------------------------------------- M01 / M12

def build_item_item_graph(
    signals: DataFrame,
    logistic_param: float,
    min_link_weight: float,
    max_links_per_user: int,
    detail: bool = False,
    stage: bool = True,
    stage_links: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Contract the bipartite user-item graph into item-item links.

    Returns ``(ii_links, item_weights)``:
      ii_links      (item_A, item_B, weight double, weight_units[, link_data map<string,bigint>])
      item_weights  (item, overall_weight double, overall_units), for every item before pruning.
    Both weights are exact sums of 9-decimal scaled weights, rounded once to DOUBLE; the
    units are the exact integers, for operators that go on summing.
    ``link_data`` (detail mode) holds, per signal type, the rows of both items summed over
    the users behind the link, plus ``NUM_USERS``.
    """
    user_items = scaled_pairs(aggregate_user_items(signals, logistic_param, detail))
    if stage:
        user_items = write_rows(user_items, "user_items")
    return graph_from_user_items(user_items, min_link_weight, max_links_per_user, detail, stage, stage_links)


class IdGraph(NamedTuple):
    """A graph keyed by 64-bit item ids that follow the order of the items.

    links    (item_A, item_B, weight, weight_units[, link_data]) on ids, both directions
    named    the same on item strings, with ``target_weight``, the DOUBLE overall weight of item_B
    weights  (item = id, overall_weight, overall_units)
    items    (item string, item_id)
    """

    links: DataFrame
    weights: DataFrame
    items: DataFrame
    named: DataFrame


def id_graph(
    user_items: DataFrame,
    min_link_weight: float,
    max_links_per_user: int,
    detail: bool = False,
    more_items: DataFrame | None = None,
    stage_links: bool = False,
) -> IdGraph:
    """The graph of an (already staged) user-item table, keyed by item ids.

    The item popularity table is written once to the shared checkpoint folder, sorted by
    item, which fixes the ids in item order. Each branch then starts from a table instead
    of replaying the signal scan and aggregation, the job can restart after its largest
    shuffle, and the planner sees the popularity table's real size: it is broadcast to the
    weak-item filter and the Bayes join only when it is small
    (``spark.sql.autoBroadcastJoinThreshold``), and shuffled otherwise. ``more_items``
    (item) get ids too; without signals they have no weight. ``stage_links`` also writes the
    summed links, for jobs that are to restart behind the pair expansion. Users and items may be integers; items are
    ordered and returned as strings all the same.
    """
    ui = scaled_pairs(user_items)
    key_type = ui.schema["item"].dataType
    # In detail mode also how many rows an item has, which bounds the counts of its links.
    popularity = _popularity_and_rows(ui, detail).withColumn("item", F.col("item").cast("string"))
    if more_items is not None:
        named = more_items.select("item").where(F.col("item").isNotNull()).distinct()
        popularity = popularity.join(named, "item", "full_outer")
    table = write_stage(
        popularity.orderBy("item").withColumn("item_id", F.monotonically_increasing_id()), "item_popularity"
    )
    table, n_items = _dense_ids(table)
    types = few_signal_types(ui) if detail else None
    most = table.agg(F.max("users"), F.max("rows" if detail else "users")).first()
    id_bits, count_bits = max(n_items - 1, 1).bit_length(), None
    if types is not None:
        count_bits = int(2 * (most[1] or 0)).bit_length()
    tasks = pair_tasks(ui, max_links_per_user, detail, types)
    striped = (types is not None or not detail) and not _pairs_recur(ui, n_items, tasks, max_links_per_user)
    # An item of so many users that its pairs would fill a task by themselves is dealt to several.
    parts = F.ceil(F.col("users") * (max_links_per_user - 1) / F.lit(PAIRS_PER_ITEM)).cast("int")
    # Items without signals, which may be no integers, are not among the strong ones.
    strong = table if key_type == StringType() else table.withColumn("item", F.col("item").try_cast(key_type))
    if striped and (most[0] or 0) * (max_links_per_user - 1) > PAIRS_PER_ITEM:
        strong = strong.withColumn("parts", parts)
    with shuffle_to(ui.sparkSession, tasks) if stage_links else nullcontext():
        capped = cap_links_per_user(ui, strong, min_link_weight, max_links_per_user)
        if striped:
            counts = {}
            if types is not None:
                counts = {"users": F.lit(0).cast("long"), **{f"type_{i}": _count_of(t) for i, t in enumerate(types)}}
                counts = _packed_counts(counts, count_bits)
            pairs = stripe_pairs(
                user_item_stripes(capped, id_bits, counts), STRIPE_TASKS * tasks
            )
        else:
            pairs = user_item_pairs(capped, detail, types)
        sums = _sum_pairs(pairs, min_link_weight, detail, types, stage_links, None if striped else id_bits, count_bits)
    weights = table.where(F.col("overall_units").isNotNull()).select(
        F.col("item_id").alias("item"), units_to_double("overall_units").alias("overall_weight"), "overall_units"
    )
    return IdGraph(
        _links_from_sums(sums, types, count_bits),
        weights,
        table.select("item", "item_id"),
        _named_links(sums, types, count_bits, table),
    )


def _pairs_recur(ui_scaled: DataFrame, n_items: int, tasks: int, max_links_per_user: int) -> bool:
    """Whether a task surely expands most pairs several times, so that it had better sum them before they are shuffled."""
    pairs = ui_scaled.count() * (max_links_per_user - 1) / 2
    return pairs / tasks > 4 * n_items * (n_items - 1) / 2


def _named_links(sums: DataFrame, types: list[str] | None, count_bits: int | None, table: DataFrame) -> DataFrame:
    """Links on item strings. One direction of each is joined to its items, and their weights come along."""
    own = [F.col("item"), units_to_double("overall_units").alias("__w")]
    a = table.select(F.col("item_id").alias("item_A"), F.struct(*own).alias("__a"))
    b = table.select(F.col("item_id").alias("item_B"), F.struct(*own).alias("__b"))
    rest = [c for c in sums.columns if c not in ("item_A", "item_B")]
    both = sums.join(a, "item_A").join(b, "item_B").select(F.col("__a").alias("item_A"), F.col("__b").alias("item_B"), *rest)
    links = _links_from_sums(both, types, count_bits)
    rest = [c for c in links.columns if c not in ("item_A", "item_B")]
    return links.select(
        F.col("item_A.item").alias("item_A"), F.col("item_B.item").alias("item_B"), *rest, F.col("item_B.__w").alias("target_weight")
    )


def _popularity_and_rows(ui_scaled: DataFrame, detail: bool) -> DataFrame:
    """``item_popularity`` with the number of an item's ``users`` and, with ``detail``, ``rows``: those and its rows of any
    signal type together."""
    sums = [F.sum("weight_units").alias("overall_units"), F.count(F.lit(1)).alias("users")]
    if detail:
        n = F.aggregate("signal_types", F.lit(1).cast("long"), lambda total, e: total + e["n"])
        sums.append(F.sum(n).alias("rows"))
    return ui_scaled.groupBy("item").agg(*sums)


def _dense_ids(table: DataFrame) -> tuple[DataFrame, int]:
    """``item_id`` without the gaps between partitions, in the same order, and the number of items.

    One number per partition of the written table is gathered; ids as short as they can be make short pairs."""
    part, row = F.shiftright("item_id", 33), F.col("item_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["p"]: r["n"] for r in table.groupBy(part.cast("int").alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for p in range(max(sizes, default=0) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    first = F.element_at(F.array(*(F.lit(n).cast("long") for n in before)), part.cast("int") + 1)
    return table.withColumn("item_id", row + first), total


def graph_from_user_items(
    user_items: DataFrame,
    min_link_weight: float,
    max_links_per_user: int,
    detail: bool = False,
    stage: bool = True,
    stage_links: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``build_item_item_graph`` from an (already staged) user-item table. Without ``stage``
    nothing is written and the pairs are keyed by the item strings."""
    if stage:
        g = id_graph(user_items, min_link_weight, max_links_per_user, detail, stage_links=stage_links)
        weights = g.weights.withColumnRenamed("item", "item_id").join(g.items, "item_id")
        return g.named.drop("target_weight"), weights.select("item", "overall_weight", "overall_units")
    ui = scaled_pairs(user_items).withColumn("item", F.col("item").cast("string"))
    popularity = item_popularity(ui)
    capped = cap_links_per_user(ui, popularity, min_link_weight, max_links_per_user)
    links = sum_pairs_to_links(user_item_pairs(capped, detail), min_link_weight, detail)
    return links, popularity.select("item", units_to_double("overall_units").alias("overall_weight"), "overall_units")


def encode_pairs(pairs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_A, item_B, ...) strings -> ids; rows that name an unknown item vanish."""
    rest = [c for c in pairs.columns if c not in ("item_A", "item_B")]
    a = items.select(F.col("item").alias("item_A"), F.col("item_id").alias("__a"))
    b = items.select(F.col("item").alias("item_B"), F.col("item_id").alias("__b"))
    return pairs.join(a, "item_A").join(b, "item_B").select(
        F.col("__a").alias("item_A"), F.col("__b").alias("item_B"), *rest
    )


def decode_recs(recs: DataFrame, items: DataFrame) -> DataFrame:
    """Recommendations on ids -> on item strings (``linking_item`` too, where there is one)."""
    out = _decode(recs, items)
    if "linking_item" in recs.columns:
        mid = items.select(F.col("item_id").alias("linking_item"), F.col("item").alias("__mid"))
        out = out.join(mid, "linking_item", "left").withColumn("linking_item", F.col("__mid"))
    return out.select(*recs.columns)


# --------------------------------------------------------------------------- M02 / M06 / M13

def adjust_item_item_graph_weight(
    ii_links: DataFrame,
    item_weights: DataFrame | None,
    prior: float,
    pop_boost_func: str | None = None,
) -> DataFrame:
    """Bayes adjustment by the popularity of the *target* item.

    weight = w / (overall_weight(item_B) + prior), or with a popularity boost
    f in {SQRT, LOG, ''}: w * f(ow) / (ow + prior). ``raw_weight`` keeps w. Any extra
    column of ``ii_links`` (e.g. ``link_data``) is carried. Links whose target has no
    weight row vanish (inner join). Division by zero gives NULL, not an error.
    Links that have the weight of their target already (``target_weight`` of ``IdGraph.named``) need no ``item_weights``.
    """
    _require(ii_links, ["item_A", "item_B", "weight"], "ii_links")
    if "target_weight" in ii_links.columns:
        j = ii_links.withColumnRenamed("target_weight", "__ow").where(F.col("__ow").isNotNull())
    else:
        iw = item_weights.select(
            F.col("item").alias("item_B"), to_double("overall_weight").alias("__ow")
        )
        j = ii_links.join(iw, "item_B")
    w = to_double("weight")
    ow = F.col("__ow")
    num = w if pop_boost_func is None else w * pop_boost(ow, pop_boost_func)
    extra = [c for c in ii_links.columns if c not in ("item_A", "item_B", "weight", "weight_units", "raw_weight", "target_weight")]
    return j.select(
        "item_A",
        "item_B",
        ratio(num, ow + F.lit(float(prior))).alias("weight"),
        w.alias("raw_weight"),
        *extra,
    )


# --------------------------------------------------------------------------- M10

def sum_item_item_signals(
    ii_links_weighted: DataFrame, ii_links_not_weighted: DataFrame, item_weights: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Add outside item-item signals (may be negative) into links and popularity.

    * popularity: outside weights summed per item_A, FULL join with item_weights,
      missing side 0, negative totals clamped to 0;
    * links: FULL join on (item_A, item_B), missing side 0, keep strictly positive.
    Outside rows are not de-duplicated (as in the reference). Sums are exact: the
    ``weight_units`` / ``overall_units`` of ``build_item_item_graph`` are used where there
    are any, other weights become units. Results carry units and DOUBLE weights.
    Returns ``(ii_links_combined, item_weights_combined)``.
    """
    exact = lambda df, unit, weight: F.col(unit) if unit in df.columns else to_units(weight)
    outside = ii_links_not_weighted.select(
        "item_A", "item_B", exact(ii_links_not_weighted, "weight_units", "weight").alias("__o")
    )
    extra = outside.groupBy(F.col("item_A").alias("item")).agg(F.sum("__o").alias("__ox"))
    iw = item_weights.select("item", exact(item_weights, "overall_units", "overall_weight").alias("__ow"))
    zero = F.lit(0).cast(LongType())
    total = F.coalesce(F.col("__ow"), zero) + F.coalesce(F.col("__ox"), zero)
    item_weights_combined = (
        iw.join(extra, "item", "full_outer")
        .select("item", F.greatest(total, zero).alias("overall_units"))
        .select("item", units_to_double("overall_units").alias("overall_weight"), "overall_units")
    )
    lw = ii_links_weighted.select(
        "item_A", "item_B", exact(ii_links_weighted, "weight_units", "weight").alias("__lw")
    )
    # FULL OUTER JOIN on (item_A, item_B), written as two joins AQE can split when one
    # outside pair is hot (it cannot split a full outer join): every outside row with
    # its link weight (left outer, outside on the streamed side), plus the links that
    # no outside row names (anti join; repeated outside keys do no harm there).
    with_outside = outside.join(lw, ["item_A", "item_B"], "left")
    links_alone = lw.join(outside.select("item_A", "item_B"), ["item_A", "item_B"], "left_anti").withColumn(
        "__o", F.lit(None).cast(LongType())
    )
    lsum = F.coalesce(F.col("__lw"), zero) + F.coalesce(F.col("__o"), zero)
    links_combined = (
        with_outside.unionByName(links_alone)
        .select("item_A", "item_B", lsum.alias("weight_units"))
        .where(F.col("weight_units") > zero)
        .select("item_A", "item_B", units_to_double("weight_units").alias("weight"), "weight_units")
    )
    return links_combined, item_weights_combined


# --------------------------------------------------------------------------- M11

def diversify_item_item_links(ii_links: DataFrame, metadata: DataFrame, stage: bool = True) -> DataFrame:
    """Divide each link's weight by its rank among item_A's links whose target shares a
    metadata value. Links to items without metadata are dropped; an item with two
    metadata rows yields two links. ``raw_weight`` is unchanged. Every rank counts, of
    weights of either sign, and no group is ranked in one task (``rank_by_global_sort``).

    ``stage`` writes the links first: what comes out of a join on the target item, as the
    Bayes adjustment does, would be joined again on the same partitioning, which Spark
    cannot split when one target is hot. A written table is dealt out anew.
    """
    _require(metadata, ["item", "metadata_field"], "metadata")
    md = metadata.select(F.col("item").alias("item_B"), "metadata_field")
    links = write_stage(ii_links, "links_to_diversify") if stage else ii_links
    j = links.join(md, "item_B")
    order = [F.col("weight").desc(), F.col("item_B").asc()]
    r = rank_by_global_sort(j, ["item_A", "metadata_field"], order, "__fr")
    return r.select(
        "item_A",
        "item_B",
        ratio(to_double("weight"), F.col("__fr").cast("double")).alias("weight"),
        "raw_weight",
    )


# --------------------------------------------------------------------------- M21

def add_metadata_to_item_item_links(ii_links: DataFrame, metadata: DataFrame) -> DataFrame:
    """Attach the metadata of both ends (inner joins; weights untouched)."""
    _require(metadata, ["item", "metadata_field"], "metadata")
    ma = metadata.select(F.col("item").alias("item_A"), F.col("metadata_field").alias("metadata_A"))
    mb = metadata.select(F.col("item").alias("item_B"), F.col("metadata_field").alias("metadata_B"))
    return (
        ii_links.select("item_A", "item_B", "weight")
        .join(ma, "item_A")
        .join(mb, "item_B")
        .select("item_A", "item_B", "weight", "metadata_A", "metadata_B")
    )


# --------------------------------------------------------------------------- M22

def remove_bots(signals: DataFrame, threshold: int) -> DataFrame:
    """Keep the signals of users with fewer than ``threshold`` signal rows (strict).

    Rows are counted as they are (duplicates and NULL items included). The count is a
    partially aggregated ``groupBy(user)``. The bots are few where the normal users are many, so it is they
    that are written and joined away: a list that Spark broadcasts while it is small, so that no signal is
    shuffled. Beyond that both sides are plain tables and Spark can split a hot user's rows. Every
    input column is kept; rows without a user go.
    """
    counts = signals.groupBy("user").agg(F.count(F.lit(1)).alias("__n"))
    bots = counts.where(F.col("user").isNotNull() & (F.col("__n") >= F.lit(int(threshold)))).select("user")
    named = signals.where(F.col("user").isNotNull())
    return named.join(write_stage(bots, "bots"), "user", "left_anti").select(*signals.columns)


__all__ = [
    "NUM_USERS_KEY",
    "aggregate_user_items",
    "scaled_pairs",
    "graph_from_user_items",
    "IdGraph",
    "id_graph",
    "encode_pairs",
    "decode_recs",
    "LINK_DATA_TYPE",
    "scale_user_item_signals",
    "item_popularity",
    "cap_links_per_user",
    "user_item_pairs",
    "sum_pairs_to_links",
    "build_item_item_graph",
    "adjust_item_item_graph_weight",
    "sum_item_item_signals",
    "diversify_item_item_links",
    "add_metadata_to_item_item_links",
    "remove_bots",
]
