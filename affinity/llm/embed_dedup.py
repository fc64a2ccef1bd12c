"""Embedding near-duplicates: spherical k-means cells and blocked cosine products.

1. Equal vectors of a label become one, with their number and smallest id.
2. Spherical k-means, fitted for each label on a bounded sample, gives cells; every vector's
   home is the cell of the nearest centre. Cells grow with the table: beyond ``MAX_CENTRES`` of a
   label they are made in two levels, the nearest of the upper centres first, then the nearest of its own.
3. No link may be lost at the cells' borders. Two vectors within angle ``a`` lie on either
   side of the plane that parts their cells, so each is within ``a`` of it. A vector is
   therefore a guest in every later cell whose parting plane is within the angle of the
   threshold; pairs of different cells are compared once, guest against residents. A guest of an
   upper cell visits the lower cells that its nearest centre there parts by such a plane.
4. The vectors of a cell are dealt by hash into blocks of at most about ``block_rows``; two
   blocks meet in one task as one matrix product. A hot cell is thus many tasks; a cell of one
   block and its guests, as most are, are one, and no row is sent twice.
5. Each task gives the number of links of its vectors and a spanning forest of them, never
   pairs. The components' smallest vector ids are the representatives that are kept.

Cosines are in double precision; one within 1e-9 of the threshold is computed anew as the
plain quotient of the dot product and the norms.

Cases: a vector that is null, zero or holds a null or a component that is not finite, or
whose label is null, links with nothing and is its own component; vectors of different
lengths are not compared; repeated rows link with each other; a null id takes no part in the
smallest id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import Forest, connected_components, slices
from affinity.session import write_stage

THRESHOLD = 0.93
#: Vectors that k-means is fitted on, over all labels: those with the smallest hashes.
SAMPLE_ROWS = 20_000
#: The most components that the sample has.
SAMPLE_VALUES = 4_000_000
#: Wanted residents of a cell, and most centres of one level.
CELL_ROWS = 3_000
MAX_CENTRES = 64
BLOCK_ROWS = 4_096


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of unit rows; starts far from each other, ends after ``rounds`` or when nothing changes."""
    rng = np.random.default_rng(42)
    centres = [x[rng.integers(len(x))]]
    closest = x @ centres[0]
    for _ in range(1, k):
        far = np.maximum(1 - closest, 0) ** 2
        pick = rng.choice(len(x), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(x))
        centres.append(x[pick])
        closest = np.maximum(closest, x @ x[pick])
    c, before = np.array(centres), None
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        if before is not None and np.array_equal(own, before):
            break
        before = own
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
    # Centres this close would part their vectors by a plane that rounding can move.
    kept: list[np.ndarray] = []
    for row in c:
        if all(np.linalg.norm(row - k) > 1e-3 for k in kept):
            kept.append(row)
    return np.array(kept)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_group(batch: pa.RecordBatch) -> Iterator[tuple[tuple, np.ndarray]]:
    groups = defaultdict(list)
    for i, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist())):
        groups[key].append(i)
    for key, rows in groups.items():
        yield key, np.array(rows)


def _visits(x: np.ndarray, c: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each row, and which cells lie behind a plane within the angle (the own one too)."""
    near = x @ c.T
    home = near.argmax(axis=1)
    # The sine of the angle between a vector and the plane between two centres.
    apart = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
    sine = (near[np.arange(len(x)), home][:, None] - near) / np.maximum(apart[home], 1e-300)
    return home, sine <= np.sin(angle) + 1e-9


class Cells:
    """The centres of a label: one level, or upper centres with the lower ones of each."""

    def __init__(self, upper: np.ndarray, lower: list[np.ndarray] | None = None):
        self.upper, self.lower = upper, lower

    def __len__(self) -> int:
        return len(self.upper) if self.lower is None else sum(map(len, self.lower))

    def place(self, x: np.ndarray, angle: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, guest): each unit row at home and in every cell that it must visit."""
        rows = np.arange(len(x))
        home, near = _visits(x, self.upper, angle)
        who, where = np.nonzero(near & (np.arange(len(self.upper))[None, :] > home[:, None]))
        row = np.concatenate((rows, who))
        cell = np.concatenate((home, where))
        guest = np.concatenate((np.zeros(len(rows), dtype=bool), np.ones(len(who), dtype=bool)))
        if self.lower is None:
            return row, cell, guest
        first = np.cumsum([0, *map(len, self.lower)])
        out = []
        for k in np.unique(cell).tolist():
            at = np.flatnonzero(cell == k)
            inner, near = _visits(x[row[at]], self.lower[k], angle)
            own = ~guest[at]
            out.append((row[at[own]], inner[own], np.zeros(own.sum(), dtype=bool), k))
            # Residents are guests in later cells only; a guest from outside meets residents of any.
            near &= guest[at][:, None] | (np.arange(near.shape[1])[None, :] > inner[:, None])
            who, where = np.nonzero(near)
            out.append((row[at[who]], where, np.ones(len(who), dtype=bool), k))
        return (
            np.concatenate([r for r, _, _, _ in out]),
            np.concatenate([c + first[k] for _, c, _, k in out]),
            np.concatenate([g for _, _, g, _ in out]),
        )


def _cells(batches: Iterator[pa.RecordBatch], centres: dict, angle: float, schema: pa.Schema):
    """(node, label, dims, vector) -> a row (node, label, dims, cell, guest) at home and for each cell visited."""
    for batch in slices(batches, 1024):
        node = batch.column("node").to_numpy(zero_copy_only=False)
        out = []
        for key, rows in _by_group(batch):
            c = centres.get(key)
            if c is None or len(c) == 1:
                out.append((rows, np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=bool)))
                continue
            row, cell, guest = c.place(_unit(_matrix(batch.column("vector").take(pa.array(rows)))), angle)
            out.append((rows[row], cell, guest))
        if out:
            rows, cell, guest = (np.concatenate(p) for p in zip(*out))
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[rows], pa.int64()),
                    *(batch.column(c).take(at) for c in ("label", "dims")),
                    pa.array(cell, pa.int32()),
                    pa.array(guest, pa.bool_()),
                    batch.column("n").take(at),
                    batch.column("vector").take(at),
                ],
                schema=schema,
            )


def _compare(table: pa.Table, threshold: float, schema: pa.Schema) -> pa.Table:
    """Two blocks of a cell, or one with itself -> (node, links, root) of the vectors that link.

    A block that meets itself also meets the guests who came with it (their block is -1).
    """
    table = table.combine_chunks()
    if not table.num_rows:
        return schema.empty_table()
    block = table.column("block").to_numpy()
    first, other = table.column("first")[0].as_py(), table.column("other")[0].as_py()
    x = _matrix(table.column("vector").combine_chunks())
    u = _unit(x)
    n, node = table.column("n").to_numpy(), table.column("node").to_numpy()
    b = np.flatnonzero(block == other)
    a = np.flatnonzero((block == first) | (block < 0)) if first == other else np.flatnonzero(block == first)
    links, forest = np.zeros(len(x), dtype=np.int64), Forest(len(x))
    for lo in range(0, len(a), 512):
        rows = a[lo : lo + 512]
        cosine = u[rows] @ u[b].T
        i, j = np.nonzero(cosine >= threshold - 1e-9)
        i, j, c = rows[i], b[j], cosine[i, j]
        if first == other:
            up = (i < j) | (block[i] < 0)
            i, j, c = i[up], j[up], c[up]
        close = np.abs(c - threshold) <= 1e-9
        if close.any():
            p, q = x[i[close]], x[j[close]]
            c[close] = (p * q).sum(axis=1) / (np.sqrt((p * p).sum(axis=1)) * np.sqrt((q * q).sum(axis=1)))
        good = c >= threshold
        i, j = i[good], j[good]
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        forest.link(i, j)
    root = forest.labels()
    hit = np.flatnonzero(links > 0)
    return pa.table([pa.array(node[hit]), pa.array(links[hit]), pa.array(node[root[hit]])], schema=schema)


def fit_cells(x: np.ndarray, k: int, most: int = MAX_CENTRES) -> Cells:
    """About ``k`` cells of unit rows, in two levels beyond ``most`` of them."""
    if k <= most:
        return Cells(spherical_kmeans(x, k))
    upper = spherical_kmeans(x, min(most, isqrt(k - 1) + 1))
    home = (x @ upper.T).argmax(axis=1)
    lower = []
    for c in range(len(upper)):
        own = x[home == c]
        part = min(len(own), -(-k * len(own) // len(x)))
        lower.append(spherical_kmeans(own, part) if part > 1 else upper[c : c + 1])
    return Cells(upper, lower)


def _fit(distinct: DataFrame, sample_rows: int, cell_rows: int, max_centres: int) -> dict[tuple, Cells]:
    """Centres of each (label, dims) that has more than one cell; all together, at most ``sample_rows``.

    Of more labels than there are sampled rows the largest are cut into cells; any other is one cell.
    """
    large = distinct.groupBy("label", "dims").count().where(F.col("count") > cell_rows)
    sizes = {(r["label"], r["dims"]): r["count"] for r in large.orderBy(F.desc("count")).limit(sample_rows).collect()}
    if not sizes:
        return {}
    sample_rows = max(1, min(sample_rows, SAMPLE_VALUES // max(dims for _, dims in sizes)))
    # Only what is to be cut is sampled.
    cut = distinct.where(F.col("dims") <= max(dims for _, dims in sizes))
    sample = cut.orderBy(F.xxhash64("vector", "label")).limit(sample_rows).select("label", "dims", "vector").toArrow()
    cells = {}
    for batch in [sample.combine_chunks().to_batches()[0]] if sample.num_rows else []:
        for key, rows in _by_group(batch):
            k = min(-(-sizes.get(key, 0) // cell_rows), len(rows))
            if k > 1:
                cells[key] = fit_cells(_unit(_matrix(batch.column("vector").take(pa.array(rows)))), k, max_centres)
    return cells


def embedding_components(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
    cell_rows: int = CELL_ROWS,
    max_centres: int = MAX_CENTRES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row with vec_id, embedding, label."""
    v = vectors.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.coalesce(
        F.col("label").isNotNull()
        & (F.size("vector") > 0)
        & F.forall("vector", finite)
        & F.exists("vector", lambda x: x != 0.0),
        F.lit(False),
    )
    v = write_stage(v.withColumn("usable", usable).withColumn("same", F.xxhash64("vector", "label")), "embed_rows")
    distinct = (
        v.where("usable")
        .groupBy("label", "vector")
        .agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low"), F.first("same").alias("same"))
        .withColumn("dims", F.size("vector"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    distinct = write_stage(distinct, "embed_distinct")
    centres = _fit(distinct, sample_rows, cell_rows, max_centres)
    angle = float(np.arccos(threshold))
    cell_schema = pa.schema(
        [("node", pa.int64()), ("label", pa.string()), ("dims", pa.int32()), ("cell", pa.int32()), ("guest", pa.bool_())]
        + [("n", pa.int64()), ("vector", pa.list_(pa.float64()))]
    )
    placed = distinct.select("node", "label", "dims", "n", "vector").mapInArrow(
        lambda it: _cells(it, centres, angle, cell_schema),
        "node long, label string, dims int, cell int, guest boolean, n long, vector array<double>",
    )
    placed = write_stage(placed, "embed_cells")
    cell = ["label", "dims", "cell"]
    counts = placed.groupBy(*cell).agg(
        F.ceil(F.sum(F.when(~F.col("guest"), 1).otherwise(0)) / block_rows).cast("int").alias("homes"),
        F.ceil(F.sum(F.when(F.col("guest"), 1).otherwise(0)) / block_rows).cast("int").alias("guests"),
    )
    counts = write_stage(counts.where("homes > 0"), "embed_counts")
    dealt = placed.join(counts, cell)
    # Residents' blocks are 0, 1, ...; guests' are -1, -2, ... Guests meet residents only, and one block of guests
    # goes along where there is one block of residents.
    alone = (F.col("homes") == 1) & (F.col("guests") <= 1)
    block = F.when(F.col("guest"), -1 - F.pmod(F.xxhash64("node"), F.col("guests"))).otherwise(
        F.pmod(F.xxhash64("node"), F.col("homes"))
    )
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    dealt = dealt.withColumn("block", block.cast("int"))
    mine = F.col("block")
    one = F.array(F.struct(F.lit(0).alias("first"), F.lit(0).alias("other")))
    meets = F.when(alone, one).when(
        F.col("guest"), F.transform(upto(F.col("homes")), lambda k: F.struct(mine.alias("first"), k.alias("other")))
    ).otherwise(
        F.concat(
            F.transform(
                upto(F.col("homes")),
                lambda k: F.struct(F.least(mine, k).alias("first"), F.greatest(mine, k).alias("other")),
            ),
            F.transform(upto(F.col("guests")), lambda k: F.struct((-1 - k).alias("first"), mine.alias("other"))),
        )
    )
    dealt = dealt.withColumn("meet", F.explode(meets)).select(
        *cell, "block", F.col("meet.first").alias("first"), F.col("meet.other").alias("other"), "node", "n", "vector"
    )
    out = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])
    found = dealt.groupBy(*cell, "first", "other").applyInArrow(
        lambda t: _compare(t, threshold, out), "node long, links long, root long"
    )
    found = write_stage(found, "embed_links")
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = write_stage(roots, "embed_roots")
    links = write_stage(found.groupBy("node").agg(F.sum("links").alias("links")), "embed_sums")
    named = (
        distinct.select("label", "vector", "same", "node", "n", "low")
        .join(links, "node", "left")
        .join(roots.withColumnRenamed("root", "top"), "node", "left")
        .withColumn("top", F.coalesce("top", "node"))
    )
    named = write_stage(named, "embed_named")
    low = write_stage(named.groupBy("top").agg(F.min("low").alias("component_id")), "embed_low")
    named = write_stage(
        named.join(low, "top").select(
            "same", "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
        ),
        "embed_components",
    )
    linked = v.where("usable").join(named, ["same", "label", "vector"]).select("vec_id", "n_links", "component_id")
    single = v.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.unionByName(single)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
