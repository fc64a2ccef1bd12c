"""Best-fit packing: exact round trip, certified bounds, and exchanges that never lose."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from affinity.llm import best_fit, packing
from affinity.llm.best_fit import best_fit_decreasing, lower_bound, pack_best_fit, piece_lengths, place_items
from affinity.llm.catalog import LLM_QUERIES
from affinity.llm.common import read_table

SF = "/root/testdata/sf0.001"


def fewest(sizes, capacity):
    """The least number of sequences, by trying every place of every item."""
    best = len(sizes)

    def place(k, free):
        nonlocal best
        if len(free) >= best:
            return
        if k == len(sizes):
            best = len(free)
            return
        for i in range(len(free)):
            if free[i] >= sizes[k] and free[i] not in free[:i]:
                place(k + 1, free[:i] + [free[i] - sizes[k]] + free[i + 1 :])
        place(k + 1, free + [capacity - sizes[k]])

    place(0, [])
    return best


@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
@settings(max_examples=150, deadline=None)
def test_bound_is_below_and_best_fit_above_the_least_number(sizes):
    sizes = np.array(sorted(sizes, reverse=True))
    least = fewest(sizes.tolist(), 20)
    bins, offsets, free = best_fit_decreasing(sizes, 20)
    assert lower_bound(sizes, 20) <= least <= len(free)
    for b in range(len(free)):
        mine = np.flatnonzero(bins == b)
        ends = sorted(zip(offsets[mine], sizes[mine]))
        assert [o for o, _ in ends] == np.cumsum([0] + [n for _, n in ends]).tolist()[:-1]
        assert sum(n for _, n in ends) + free[b] == 20 and free[b] >= 0


def test_bounds_beyond_the_sum():
    assert lower_bound(np.array([11] * 5), 20) == 5
    assert lower_bound(np.array([7] * 6), 20) == 3
    assert lower_bound(np.array([6] * 7), 20) == 3
    assert lower_bound(np.array([20, 1]), 20) == 2


def test_best_fit_takes_the_fullest_sequence_with_room():
    bins, _, free = best_fit_decreasing(np.array([12, 14, 6, 8]), 20)
    assert bins.tolist() == [1, 0, 0, 1] and free.tolist() == [0, 0]


def test_piece_lengths():
    assert piece_lengths(1, 4) == [1] and piece_lengths(4, 4) == [4]
    assert piece_lengths(9, 4) == [1, 4, 4] and piece_lengths(8, 4) == [4, 4]


def check_pieces(rows, docs, window, end_id=2):
    """Pieces give every document's ids in turn, and sequences are gapless and not overfull."""
    tokenizer = Tokenizer.from_file(packing.default_tokenizer_path())
    want = defaultdict(list)
    for i, text in docs:
        want[i].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == want.keys()
    for i, ids in want.items():
        found = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i])
        expected = []
        for x in ids:
            lo = 0
            for k, n in enumerate(piece_lengths(len(x), window)):
                expected.append((k, lo, n, zlib.crc32(np.array(x[lo : lo + n], dtype="<u4").tobytes())))
                lo += n
        assert found == sorted(expected), i
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window


def test_query_round_trip(spark):
    docs = [(r["doc_id"], r["text"]) for r in read_table(spark, SF, "documents").collect()]
    rows = LLM_QUERIES["op13_best_fit_packing"](spark, SF).collect()
    check_pieces(rows, docs, 1024)
    sizes = np.array([r["length"] for r in rows])
    assert len({r["sequence_id"] for r in rows}) <= 1.02 * lower_bound(sizes, 1024)


def test_cases_and_clashing_columns(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (None, "no id"), (4, "same"), (4, "same"), (5, "a <|endoftext|> b")]
    docs += [(6, "word " * 5000), (7, "x" * 9000), (8, "日本語" * 900)]
    schema = "doc_id long, text string, row int, part int, bin int, gap int, offset int, piece int, ids int, length int"
    table = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, 6, 7, 8) for i, t in docs], schema)
    rows = pack_best_fit(table, window_tokens=16).collect()
    check_pieces(rows, docs, 16)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    assert pack_best_fit(table.limit(0)).count() == 0
    named = table.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert {r["doc_id"] for r in pack_best_fit(named, keep_ids=False).collect()} == {f"d{i}" for i in range(1, 9)} | {None}


@pytest.mark.parametrize("part_items", [50, 400])
def test_exchanges_gain_and_keep_every_item(spark, part_items):
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 100, 1500).tolist() + [37] * 700
    items = spark.createDataFrame(list(enumerate(sizes)), "row long, length long")
    none = place_items(items, 100, part_items, rounds=0).collect()
    some = place_items(items, 100, part_items, rounds=best_fit.ROUNDS).collect()
    counts = []
    for rows in (none, some):
        assert sorted(r["row"] for r in rows) == list(range(len(sizes)))
        bins = defaultdict(list)
        for r in rows:
            bins[r["bin"]].append((r["offset"], sizes[r["row"]], r["room"]))
        for b in bins.values():
            b.sort()
            assert [o for o, _, _ in b] == np.cumsum([0] + [n for _, n, _ in b]).tolist()[:-1]
            assert {100 - sum(n for _, n, _ in b)} == {room for _, _, room in b}
        counts.append(len(bins))
    assert lower_bound(np.array(sizes), 100) <= counts[1] < counts[0]
