"""Hard-negative mining by Fagin's threshold algorithm.

Vectors become integers (``floor(scale * x)``), a score is the integer inner product with the anchor, and of
equal scores the smaller id comes first. An anchor's positives are its best other rows of the same label. For
each positive there is a window of scores, ``low * p <= 100 * s <= high * p``, and its hard negatives are the
best rows of other labels inside.

Rows are dealt to blocks by their row number. A block keeps, for each dimension, the list of its rows sorted by
that component. A search reads the lists from the end that the anchor's sign makes the larger products (sorted
access), scores each row met by its whole vector (random access), and has the threshold: the sum over dimensions
of the anchor's component times the last value read. No row that was not met can score more. A search stops in a
block once the threshold is strictly below what every window still needs (its last wanted score, or its lower
end), so that equal scores with smaller ids are never missed. Depths grow in steps; an anchor reads on to the
first step whose threshold could end the search at all, and where the lists' heads hold most of the block they
are read to the end, for many anchors at once.

The blocks of a span stream through one task for a block of anchors and carry the scores found, so later blocks stop
earlier, often before the first row. A task holds one block of rows and one of anchors; nothing is keyed by label, so a
label with any share of the rows is spread like the others. Spans' results are merged by rank. Queries against all rows
in blocks are what the contract asks for: each anchor block's rows are sent once for every span, and each row once for
every anchor block.

Cases: a row with a null label or vector, or with a null or non-finite component, takes no part; a row with a null id is
no anchor, but can be found, and comes last of equal scores; repeated rows are separate rows, and each is another
row to the others; shorter vectors count as filled up with zeros; an anchor without positives, or a positive
whose window is empty, gives no rows; an empty table gives no rows; other columns are ignored. A component or
score that no 64-bit integer holds is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.functions import top_n_per_group
from affinity.session import write_stage

BLOCK_ROWS = 4096
ANCHOR_ROWS = 4096
#: Blocks that stream through a task for one block of anchors, where there are enough tasks without splitting further.
SPAN_BLOCKS = 16
#: Anchors whose scores with a whole block are held at once.
SCORE_ROWS = 256
#: Depths of the lists at which a search looks whether it can stop.
DEPTHS = (8, 64, 512)
#: Stands for a null id when equal scores are ordered.
LAST = np.iinfo(np.int64).max


# ------------------------------------------------------------------------------------ a block


def score_type(queries: np.ndarray, vectors: np.ndarray) -> type:
    """Doubles where every inner product is exact in them, else Python's integers."""
    largest = [max(-int(x.min()), int(x.max()), 1) if x.size else 1 for x in (queries, vectors)]
    return np.float64 if largest[0] * largest[1] * max(1, vectors.shape[1]) < 1 << 53 else object


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))


def threshold_search(queries: np.ndarray, vectors: np.ndarray, search) -> None:
    """Threshold algorithm of all queries over one block of rows.

    ``search.needs()`` gives per query the least score that could still matter, ``search.can_need()`` the most that
    it can become; ``search.visit(query, rows, scores)`` takes every row of the block that the query has met so
    far. A query stops when its threshold is strictly below its need.
    """
    queries, vectors = same_width(queries, vectors)
    kind = score_type(queries, vectors)
    n, dims = vectors.shape
    lists = np.argsort(vectors, axis=0, kind="stable")
    values = np.take_along_axis(vectors, lists, axis=0).astype(kind)
    q, v = queries.astype(kind), vectors.astype(kind)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    # Before any access the first entries bound every row.
    bound = up @ values[n - 1] + down @ values[0]
    open_ = np.flatnonzero(bound >= search.needs())
    for depth in (*DEPTHS, n):
        if not len(open_):
            return
        last = depth >= n or 2 * dims * depth >= n
        bound = up @ values[n - min(depth, n)] + down @ values[min(depth, n) - 1]
        # Where this depth cannot end a search, it reads on without stopping here.
        reads = open_ if last else open_[bound[open_] < search.can_need()[open_]]
        if last:
            for lo in range(0, len(reads), SCORE_ROWS):
                some = reads[lo : lo + SCORE_ROWS]
                every = np.arange(n)
                for i, scores in zip(some.tolist(), q[some] @ v.T):
                    search.visit(i, every, scores)
            return
        for i in reads.tolist():
            heads = np.concatenate([lists[n - depth :, queries[i] > 0].ravel(), lists[:depth, queries[i] < 0].ravel()])
            met = np.unique(heads)
            search.visit(i, met, v[met] @ q[i])
        done = np.zeros(len(queries), dtype=bool)
        done[reads] = bound[reads] < search.needs()[reads]
        open_ = open_[~done[open_]]


def whole(scores: np.ndarray) -> np.ndarray:
    return scores if scores.dtype == object else scores.astype(np.int64)


def best_first(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions by descending score, then ascending id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(rows)), key=lambda k: (-scores[k], ids[rows[k]])), dtype=np.int64)
    return np.lexsort((ids[rows], -scores))


def exact(scores: list) -> np.ndarray:
    """An array of integers and infinities that loses nothing."""
    large = any(type(x) is int and abs(x) >= 1 << 53 for x in scores)
    return np.array(scores, dtype=object if large else np.float64)


class Positives:
    """The best ``k`` other rows of the same label, over the blocks seen so far."""

    def __init__(self, anchors: "Rows", k: int):
        self.anchors, self.k = anchors, k
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(len(anchors))]

    def begin(self, block: "Rows", chosen: np.ndarray, mine: np.ndarray) -> None:
        """The rows ``mine`` of a block, all of one label, and the anchors ``chosen`` of that label."""
        self.block, self.chosen, self.mine = block, chosen, mine
        self.before = [self.found[i] for i in chosen.tolist()]

    def needs(self) -> np.ndarray:
        kth = [self.found[i][-1][0] if len(self.found[i]) == self.k else -np.inf for i in self.chosen.tolist()]
        return exact(kth)

    def can_need(self) -> np.ndarray:
        return np.full(len(self.chosen), np.inf)

    def visit(self, query: int, met: np.ndarray, scores: np.ndarray) -> None:
        anchor, before = int(self.chosen[query]), self.before[query]
        rows, scores = self.mine[met], whole(scores)
        wanted = self.block.rows[rows] != self.anchors.rows[anchor]
        if len(before) == self.k:
            wanted &= scores >= before[-1][0]
        rows, scores = rows[wanted], scores[wanted]
        if len(rows) > 4 * self.k and scores.dtype != object:
            # Ties with the last wanted score stay.
            high = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            rows, scores = rows[high], scores[high]
        best = best_first(rows, scores, self.block.ids)[: self.k]
        new = [(int(scores[b]), int(self.block.ids[rows[b]])) for b in best]
        self.found[anchor] = sorted(before + new, key=lambda x: (-x[0], x[1]))[: self.k]

    def result(self) -> Iterator[tuple]:
        for i, found in enumerate(self.found):
            for score, j in found:
                yield int(self.anchors.rows[i]), int(self.anchors.ids[i]), None if j == LAST else j, score


class Windows:
    """The best ``k`` rows of other labels in each window of each anchor, over the blocks seen so far."""

    def __init__(self, anchors: "Rows", k: int, low: int, high: int):
        self.anchors, self.k, self.low, self.high = anchors, k, low, high
        # No score fits the window of a negative positive score.
        self.windows = [
            {p: [] for p in {s for _, s in found} if low * p <= high * p} for found in anchors.positives
        ]
        self.least = [min(low * p for p in w) if w else 0 for w in self.windows]
        self.most = [max(high * p for p in w) if w else -1 for w in self.windows]

    def begin(self, block: "Rows") -> None:
        self.block = block
        self.before = [dict(w) for w in self.windows]
        codes = {label: k for k, label in enumerate(sorted({*block.labels, *self.anchors.labels}))}
        self.of_block = np.array([codes[x] for x in block.labels])
        self.of_anchor = [codes[x] for x in self.anchors.labels]

    def needs(self) -> np.ndarray:
        out = []
        for windows in self.windows:
            # What lies below a window's lower end is of no use either.
            least = [max(-(-self.low * p // 100), f[-1][0] if len(f) == self.k else -np.inf) for p, f in windows.items()]
            out.append(min(least, default=np.inf))
        return exact(out)

    def can_need(self) -> np.ndarray:
        return exact([min((self.high * p // 100 for p in w), default=np.inf) for w in self.windows])

    def visit(self, query: int, met: np.ndarray, scores: np.ndarray) -> None:
        scores = whole(scores)
        fits = (100 * scores >= self.least[query]) & (100 * scores <= self.most[query])
        rows, scores = met[fits], scores[fits]
        other = self.of_block[rows] != self.of_anchor[query]
        rows, scores = rows[other], scores[other]
        order = best_first(rows, scores, self.block.ids)
        scores, ids = scores[order], self.block.ids[rows[order]]
        for p, before in self.before[query].items():
            inside = np.flatnonzero((100 * scores <= self.high * p) & (100 * scores >= self.low * p))[: self.k]
            new = [(int(scores[b]), int(ids[b])) for b in inside]
            if new:
                self.windows[query][p] = sorted(before + new, key=lambda x: (-x[0], x[1]))[: self.k]

    def result(self) -> Iterator[tuple]:
        for i, found in enumerate(self.anchors.positives):
            for place, (positive, p) in enumerate(found):
                for score, j in self.windows[i].get(p, ()):
                    yield int(self.anchors.rows[i]), int(self.anchors.ids[i]), place, positive, p, None if j == LAST else j, score


# ----------------------------------------------------------------------------------- a stream


class Rows:
    """Rows of a block, or anchors, in arrays."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches)
        self.rows = table.column("row").to_numpy()
        self.ids = table.column("id").fill_null(LAST).to_numpy()
        self.labels = table.column("label").to_pylist()
        lists = table.column("v").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        values = lists.flatten().to_numpy()
        self.vectors = np.zeros((len(sizes), int(sizes.max(initial=0))), dtype=np.int64)
        at = np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.vectors[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - at] = values
        self.positives = [[(x["id"], x["score"]) for x in found or ()] for found in table.column("positives").to_pylist()]

    def __len__(self) -> int:
        return len(self.rows)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, bool, list[pa.RecordBatch]]]:
    """Runs of rows of one (anchor block, span, block): whether a new unit begins, whether they are anchors, and the rows."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy() for c in ("a", "span", "block")]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            here = tuple(int(c[lo]) for c in columns)
            if here != key and held:
                yield key, held
                held = []
            key = here
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield key, held


def _search(batches: Iterator[pa.RecordBatch], make, schema: pa.Schema):
    """Anchors come before the blocks of their unit (block -1)."""

    def rows(search):
        found = list(search.result()) if search else []
        for lo in range(0, len(found), 10_000):
            columns = list(zip(*found[lo : lo + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    unit, search = None, None
    for (a, span, block), held in _units(batches):
        if (a, span) != unit:
            yield from rows(search)
            unit, search = (a, span), None
        if block < 0:
            search = make(Rows(held))
        elif search:
            scan(search, Rows(held))
    yield from rows(search)


def scan(search: Positives | Windows, block: Rows) -> None:
    """One block of rows for one block of anchors."""
    anchors = search.anchors
    if isinstance(search, Windows):
        search.begin(block)
        threshold_search(anchors.vectors, block.vectors, search)
        return
    of_block, of_anchor = {}, {}
    for groups, labels in ((of_block, block.labels), (of_anchor, anchors.labels)):
        for k, label in enumerate(labels):
            groups.setdefault(label, []).append(k)
    for label in of_anchor.keys() & of_block.keys():
        chosen, mine = np.array(of_anchor[label]), np.array(of_block[label])
        search.begin(block, chosen, mine)
        threshold_search(anchors.vectors[chosen], block.vectors[mine], search)


def _quantise(batches: Iterator[pa.RecordBatch], scale: int, schema: pa.Schema):
    for batch in batches:
        keep, vectors = [], []
        for k, (label, x) in enumerate(zip(batch.column("label"), batch.column("embedding"))):
            if not label.is_valid or not x.is_valid or x.values.null_count:
                continue
            x = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64))
            if np.isfinite(x).all():
                if len(x) and np.abs(x).max() >= 1 << 62:
                    raise OverflowError("a component is beyond 64-bit integers")
                keep.append(k)
                vectors.append(x.astype(np.int64))
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(c).take(at) for c in ("id", "label", "anchor")]
            + [pa.array(vectors, pa.list_(pa.int64()))],
            schema=schema,
        )


POSITIVES = "array<struct<id:bigint,score:bigint>>"


def _streams(rows: DataFrame, anchors: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """Rows and anchors of every (anchor block, span), sorted so that a unit's anchors come first, then block by block."""
    blocks, anchor_blocks, spans = shape
    block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    searched = rows.withColumn("block", block).withColumn("span", F.pmod("block", F.lit(spans)))
    searched = searched.withColumn("a", every(anchor_blocks)).withColumn("positives", F.lit(None).cast(POSITIVES))
    asked = anchors.withColumn("block", F.lit(-1)).withColumn("span", every(spans))
    asked = asked.withColumn("a", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(anchor_blocks)).cast("int"))
    columns = ["a", "span", "block", "row", "id", "label", "v", "positives"]
    both = asked.select(*columns).unionByName(searched.select(*columns))
    return both.repartition("a", "span").sortWithinPartitions("a", "span", "block")


def mine_hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``(vec_id, label, embedding)`` rows -> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows are anchors; ``low`` and ``high`` are hundredths of the positive's score.
    """
    spark = vectors.sparkSession
    named = vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("string").alias("label"),
        (anchor & F.col("vec_id").isNotNull()).alias("anchor"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    fields = [("id", pa.int64()), ("label", pa.string()), ("anchor", pa.bool_()), ("v", pa.list_(pa.int64()))]
    schema = pa.schema(fields)
    whole_rows = named.mapInArrow(
        lambda it: _quantise(it, scale, schema), "id long, label string, anchor boolean, v array<long>"
    )
    # The written table fixes the row numbers.
    rows = write_stage(whole_rows.withColumn("row", F.monotonically_increasing_id()), "negatives_rows")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors")).first()
    blocks = max(1, -(-size["n"] // block_rows))
    anchor_blocks = max(1, -(-size["anchors"] // anchor_rows))
    tasks = -(-2 * spark.sparkContext.defaultParallelism // anchor_blocks)
    shape = blocks, anchor_blocks, max(-(-blocks // SPAN_BLOCKS), min(blocks, tasks))

    best = [F.desc("score"), F.asc_nulls_last("id")]
    asked = rows.where("anchor").withColumn("positives", F.lit(None).cast(POSITIVES))
    near = pa.schema([(c, pa.int64()) for c in ("anchor", "anchor_id", "id", "score")])
    found = _streams(rows, asked, shape).mapInArrow(
        lambda it: _search(it, lambda anchors: Positives(anchors, positives), near),
        "anchor long, anchor_id long, id long, score long",
    )
    found = write_stage(found, "negatives_positives")
    first = top_n_per_group(found, ["anchor"], best, positives, "place")
    # At most ``positives`` of an anchor are left.
    listed = F.array_sort(F.collect_list(F.struct("place", F.col("id"), F.col("score"))))
    kept = first.groupBy("anchor").agg(F.transform(listed, lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score"))).alias("positives"))
    asked = rows.where("anchor").drop("anchor").join(kept.withColumnRenamed("anchor", "row"), "row")

    far = pa.schema([(c, pa.int64()) for c in ("anchor", "anchor_id", "place", "positive_id", "positive_score", "id", "score")])
    mined = _streams(rows, asked, shape).mapInArrow(
        lambda it: _search(it, lambda anchors: Windows(anchors, negatives, low, high), far),
        "anchor long, anchor_id long, place long, positive_id long, positive_score long, id long, score long",
    )
    mined = write_stage(mined, "negatives_found")
    return top_n_per_group(mined, ["anchor", "place"], best, negatives, "rank").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
