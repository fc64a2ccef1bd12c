"""Best-fit packing: bound-certified repacking over partitions.

Documents are tokenised, closed by an end id, and cut into pieces of a sequence's size where they
are longer (the first piece takes what is over). A piece of full size is a sequence by itself; the
others are items of a bin packing problem, spread over partitions by hash:

1. Every partition packs its items by best-fit decreasing: the longest first, each into the fullest
   sequence that has room for it.
2. Every partition bounds from below what any packing of its items needs, by dual feasible
   functions: item sizes are mapped so that no sequence can hold mapped sizes of over one sequence,
   hence their sum is a bound. A partition that needs no more than its bound is certified: no
   packing of its items is better.
3. Partitions with a gap between the two exchange documents: those of their sequences with free
   room, and of a tenth of their full ones, go into one pool that is dealt to new partitions (fewer, as
   the pool is smaller), each of which packs and certifies again. The result is taken where the pool
   needs fewer sequences than before, so no round is a loss; rounds end when nothing is open, when a
   round gains nothing, or after ``rounds``.

A partition holds about ``part_items`` rows of three numbers, whatever the table's size or how its
sources and keys are distributed. Tokens are staged once and meet their places at the end.

Cases: a null text counts as empty and is the end id alone; a null or repeated id is carried as it
is, and repeated rows are separate documents; a document longer than ``window_tokens`` has full
pieces behind the first; equal lengths are placed in row order; an empty table gives no rows; all
other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructType

from affinity.llm.common import slices
from affinity.llm.packing import WordIds, default_tokenizer_path
from affinity.session import write_stage

#: Items of a partition, on average.
PART_ITEMS = 1 << 15
#: Exchanges at most.
ROUNDS = 3
#: One full sequence of so many goes into the exchange.
FULL_SHARE = 10
#: Largest parameter of the rounding dual feasible functions.
MAX_K = 32


def piece_lengths(n: int, window: int) -> list[int]:
    """The lengths of a document's pieces: what is over first, then full ones."""
    over = n % window
    return ([over] if over else []) + [window] * (n // window)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Sequences that any packing of items of these sizes needs, by dual feasible functions.

    ``u_k`` rounds a size down to a multiple of ``1/k`` of the capacity where it is no multiple of
    ``1/(k+1)`` of it. ``f_t`` drops sizes below ``t`` and lifts those above ``capacity - t`` to the capacity.
    Every ``u_k`` after every ``f_t`` is tried, and every ``f_t`` by itself (``f_0`` gives the sum).
    """
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    t = np.arange(capacity // 2 + 1)
    number = np.concatenate(([0], np.cumsum(count)))
    lifted = number[-1] - number[capacity - t + 1]
    best = 0
    for k in range(MAX_K + 1):
        if k == 0:
            value, full = x, capacity
        else:
            value = np.where((k + 1) * x % capacity == 0, k * x, (k + 1) * x // capacity * capacity)
            full = k * capacity
        total = np.concatenate(([0], np.cumsum(count * value)))
        mapped = total[capacity - t + 1] - total[t] + full * lifted
        best = max(best, int((-(-mapped // full)).max()))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each item its sequence and its offset there; the free room of each sequence."""
    bins, offsets = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    # Sequences by their free room, and the bit set of rooms that some sequence has.
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, free = 0, []
    order = np.argsort(-sizes, kind="stable")
    for i, n in zip(order.tolist(), sizes[order].tolist()):
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - room
        free[b] = left = room - n
        if left:
            with_room[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(free, dtype=np.int64)


def _tokenise(batches: Iterator[pa.RecordBatch], tokenizer_json: str, end_id: int, window: int, schema: pa.Schema):
    encoder = WordIds(tokenizer_json)
    end = array("H", [end_id]).tobytes()
    keep = "ids" in schema.names
    for batch in slices(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        doc, piece, start, length, crc, pieces = [], [], [], [], [], []
        for d, ids in enumerate(encoder.encode(texts)):
            # Checked ids are unsigned 32-bit.
            wide = np.frombuffer(ids + end, dtype="<u2").astype("<u4").tobytes()
            lo = 0
            for k, n in enumerate(piece_lengths(len(wide) // 4, window)):
                part = wide[4 * lo : 4 * (lo + n)]
                doc.append(d)
                piece.append(k)
                start.append(lo)
                length.append(n)
                crc.append(zlib.crc32(part))
                if keep:
                    pieces.append(part)
                lo += n
        ints = [pa.array(piece, pa.int32())] + [pa.array(c, pa.int64()) for c in (start, length, crc)]
        own = [pa.array(pieces, pa.binary())] if keep else []
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(doc, pa.int64())), *ints, *own], schema=schema
        )


PLACED = "part int, row long, length long, bin long, offset long, room long, gap long"


def _pack(table: pa.Table, window: int, round_number: int) -> pa.Table:
    first_bin = round_number << 56
    part = table.column("part")[0].as_py()
    table = table.sort_by("row")
    sizes = table.column("length").to_numpy()
    bins, offsets, free = best_fit_decreasing(sizes, window)
    gap = len(free) - lower_bound(sizes, window)
    columns = {
        "part": table.column("part"),
        "row": table.column("row"),
        "length": table.column("length"),
        "bin": pa.array(bins + first_bin + (part << 32)),
        "offset": pa.array(offsets),
        "room": pa.array(free[bins]),
        "gap": pa.array(np.full(len(bins), gap)),
    }
    return pa.table(columns, schema=pa.schema([("part", pa.int32())] + [(c, pa.int64()) for c in list(columns)[1:]]))


def _packer(window: int, round_number: int):
    return lambda table: _pack(table, window, round_number)


def place_items(items: DataFrame, window: int, part_items: int = PART_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """``(row long, length long)`` items, shorter than ``window`` -> row, bin, offset, room, gap.

    ``bin`` numbers the sequences, ``room`` is what stays free there, and ``gap`` is what its partition needs
    over its bound (0: certified).
    """
    placed, parts = None, max(1, -(-items.count() // part_items))
    pool, before = items, None
    for n in range(rounds + 1):
        dealt = pool.select(F.pmod(F.xxhash64("row", F.lit(n)), F.lit(parts)).cast("int").alias("part"), "row", "length")
        packed = dealt.groupBy("part").applyInArrow(_packer(window, n), PLACED)
        packed = write_stage(packed, "best_fit_bins")
        if placed is None:
            placed = packed
        else:
            if packed.where("offset = 0").count() >= before:
                break
            placed = write_stage(placed.where(~chosen).unionByName(packed), "best_fit_bins")
        chosen = (F.col("gap") > 0) & ((F.col("room") > 0) | (F.pmod(F.xxhash64("bin", F.lit(n)), F.lit(FULL_SHARE)) == 0))
        pool = placed.where(chosen)
        size = pool.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).first()
        if not size["n"]:
            break
        parts, before = max(1, -(-size["n"] // part_items)), size["bins"]
    return placed.drop("part", "length")


def pack_best_fit(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    window_tokens: int = 1024,
    end_id: int = 2,
    part_items: int = PART_ITEMS,
    rounds: int = ROUNDS,
    keep_ids: bool = True,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset: one row a piece.

    ``ids`` are the piece's ids as little-endian unsigned 32-bit numbers.
    """
    tokenizer_json = Path(tokenizer_path or default_tokenizer_path()).read_text(encoding="utf-8")
    out = StructType([docs.schema["doc_id"]]).add("piece", IntegerType())
    for name in ("start", "length", "ids_crc32"):
        out = out.add(name, LongType())
    out = out.add("ids", BinaryType()) if keep_ids else out
    schema = to_arrow_schema(out)
    cut = docs.select("doc_id", "text").mapInArrow(
        lambda it: _tokenise(it, tokenizer_json, end_id, window_tokens, schema), out
    )
    # The written table fixes the row numbers.
    pieces = write_stage(cut.withColumn("row", F.monotonically_increasing_id()), "best_fit_pieces")
    short, full = F.col("length") < window_tokens, F.col("length") == window_tokens
    bins = place_items(pieces.where(short).select("row", "length"), window_tokens, part_items, rounds)
    named = bins.select("row", F.col("bin").alias("sequence_id"), "offset")
    alone = pieces.where(full).select(
        *out.names, (-F.col("row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return pieces.where(short).join(named, "row").select(*out.names, "sequence_id", "offset").unionByName(alone)
