"""Helpers shared by the operators: tables, staging, Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import write_stage

#: Rows of a batch that a Python task holds at once; texts are handled one by one inside it.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_names(taken: list[str], wanted: list[str]) -> list[str]:
    """The wanted column names, with as many underscores behind as set them apart from those taken."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that memory follows the longest texts only."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def lists(values: np.ndarray, lengths: np.ndarray | list[int], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Elements of a block of a list that is folded block by block.
BLOCK = 256


def in_blocks(items: Column) -> Column:
    """A list with at least one element as lists of ``BLOCK`` of them: lists that grow by an element at a time are
    copied each time, so long ones are made of blocks."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
        lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)),
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class Forest:
    """Union-find over 0..n-1 with whole arrays of links at a time; the root is the smallest member."""

    def __init__(self, n: int):
        self.parent = np.arange(n, dtype=np.int64)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while True:
            up = self.parent[r]
            if np.array_equal(up, r):
                return r
            r = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            open_ = ra != rb
            if not open_.any():
                return
            a, b = ra[open_], rb[open_]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))

    def labels(self) -> np.ndarray:
        self.parent = self.roots(np.arange(len(self.parent)))
        return self.parent


def connected_components(edges: DataFrame) -> DataFrame:
    """``(a long, b long)`` links -> ``(node, root)`` for every node of a link; root: the smallest node.

    Alternating large-star and small-star steps over staged tables: every step is an
    aggregate (a minimum, pre-aggregated before the shuffle) and a join of two staged
    tables, which Spark can split when one node has a large share of the links.
    Self links and repeated links are harmless; null ends are dropped.
    """
    e = write_stage(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "cc_edges",
    )
    seen = None
    while True:
        sign = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign[0] == 0 or sign == seen:
            # Every link now joins a node to its root.
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = sign
        # Large star: each neighbour larger than u is linked to the smallest of u and its neighbours.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = write_stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc_min")
        # e holds (u > v): the larger end u is a neighbour of v.
        up = e.select(F.col("v").alias("c"), F.col("u").alias("x"))
        large = (
            up.join(low, up.c == low.u)
            .select(F.col("x").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        e = write_stage(large, "cc_edges")
        # Small star: u and its smaller neighbours are linked to the smallest of them.
        low = write_stage(e.groupBy("u").agg(F.min("v").alias("m")), "cc_min")
        joined = e.join(low.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = write_stage(small, "cc_edges")
