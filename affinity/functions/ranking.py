"""Ranking helpers on windows.

``row_number() <= n`` over a window is planned by Spark with a partial
``WindowGroupLimit`` before the shuffle, so a hot group sends at most ``n`` rows per
map partition to the final window. With very many map partitions that is still much for one
task: 20,000 partitions with 1,000 rows each. ``top_n_per_group`` then ranks in two
levels: map partitions are dealt to about the square root of their number of parts, the first
level keeps ``n`` rows of each group and part, and the second ranks what is left.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one group that a ranking task may be sent before the ranking takes two levels.
GROUP_ROWS = 1 << 16
#: Spark's setting (and its default) of the greatest ``n`` for which it limits groups before the shuffle.
LIMIT_CONF, LIMIT_DEFAULT = "spark.sql.optimizer.windowGroupLimitThreshold", "1000"


def _cols(cols: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def first_level_parts(spark: SparkSession, n: int) -> int:
    """Parts of the first level of a top ``n`` (1: one level is enough).

    Rows come from as many map partitions as the session shuffles to. Where ``n`` is beyond Spark's group
    limit, whole groups are sent, and the parts share them.
    """
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    limit = int(spark.conf.get(LIMIT_CONF, LIMIT_DEFAULT))
    if 0 <= limit < n:
        return partitions
    return 1 if n * partitions <= GROUP_ROWS else isqrt(partitions - 1) + 1


def top_n_per_group(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[Column | str],
    n: int,
    rank_col: str | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Keep the first ``n`` rows of each group in ``order_cols`` order (1-based rank).

    With over one of ``parts`` (default: ``first_level_parts``) a group is ranked in parts first, so that no task
    is sent more than ``n`` rows from each part, or from each map partition of a part. Rows that already lie
    together by group, in groups with a bound, are better ranked with ``parts=1``: no shuffle is added.
    """
    n = int(n)
    parts = first_level_parts(df.sparkSession, n) if parts is None else parts
    if parts > 1:
        df = top_n_of_parts(df, group_cols, order_cols, n, parts).drop("__part")
    name = rank_col or "__rn"
    w = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def top_n_of_parts(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str], n: int, parts: int
) -> DataFrame:
    """The first level: the first ``n`` rows of each group and part, with ``__part``."""
    w = Window.partitionBy(*group_cols, "__part").orderBy(*_cols(order_cols))
    dealt = df.withColumn("__part", F.pmod(F.spark_partition_id(), F.lit(parts)))
    return dealt.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def rank_within(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str], rank_col: str
) -> DataFrame:
    """Append a 1-based ``row_number`` inside each group (no limit)."""
    w = Window.partitionBy(*group_cols).orderBy(*_cols(order_cols))
    return df.withColumn(rank_col, F.row_number().over(w))


def rank_by_global_sort(
    df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str], rank_col: str
) -> DataFrame:
    """Exact 1-based ``row_number`` per group without putting a group in one task.

    A window sends every row of a group to one task; when one group may hold a third of
    the data this ranks it without that:

    1. a global sort on (group, order) range-partitions the rows, so a hot group is split
       over many partitions; the sorted table is written to the shared checkpoint folder with each
       row's partition and a number that grows by one from row to row of a partition;
    2. per-partition row counts (one row per partition: a table bounded by the partition
       count, not by the data) and their running sums turn (partition, number) into a row number of the
       whole table;
    3. the group's smallest row number (a partially aggregated minimum, written) is subtracted.

    Smallest numbers are a written table: Spark broadcasts it only where its files are small, and
    can split a hot group's rows where they are not. Groups with a NULL key have no rank and vanish.
    """
    from affinity.session import write_stage

    keys = [F.col(c) for c in group_cols] + _cols(order_cols)
    numbered = df.orderBy(*keys).withColumns({"__p": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    staged = write_stage(numbered, "global_rank")
    counts = staged.groupBy("__p").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__p", (sum_before("__n", ["__p"]) - F.col("__first")).alias("__off"))
    rows = staged.join(offsets, "__p").withColumn("__g", F.col("__at") + F.col("__off"))
    first = write_stage(rows.groupBy(*group_cols).agg(F.min("__g").alias("__g0")), "global_rank_first")
    out = rows.join(first, list(group_cols)).withColumn(
        rank_col, (F.col("__g") - F.col("__g0") + F.lit(1)).cast("int")
    )
    return out.drop("__p", "__at", "__off", "__g", "__g0")


def sum_before(value: str, order_cols: Sequence[Column | str], group_cols: Sequence[str] = ()) -> Column:
    """The sum of ``value`` over the rows before a row (0 for the first); for small tables, as of partitions' totals."""
    w = Window.partitionBy(*group_cols) if group_cols else Window
    before = w.orderBy(*_cols(order_cols)).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))
