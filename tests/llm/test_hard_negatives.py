"""Hard negatives against SQL on the given table and against brute force on awkward rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinity.llm import hard_negatives
from affinity.llm.catalog import LLM_QUERIES, llm_oracle_sql
from affinity.llm.hard_negatives import Positives, Rows, Windows, mine_hard_negatives, scan

SF = "/root/testdata/sf0.001"


def expected(rows, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    """All pairs of every anchor; rows are (id, label, vector)."""
    used = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        used.append((i, label, [math.floor(scale * x) for x in v]))
    last = lambda i: (i is None, i or 0)
    out = Counter()
    for k, (i, label, v) in enumerate(used):
        if i is None or not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for n, (j, m, w) in enumerate(used) if n != k]
        scored.sort(key=lambda s: (-s[0], last(s[1])))
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and low * p <= 100 * s[0] <= high * p][:negatives]
            for rank, (n, nid, _) in enumerate(fits, 1):
                out[i, pid, rank, nid, p, n] += 1
    return out


def mined(spark, rows, **options):
    schema = "vec_id long, label int, embedding array<float>, row int, a int, span int, block int, positives int, id int"
    table = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], schema)
    return Counter(tuple(r) for r in mine_hard_negatives(table, F.col("vec_id") % 5 == 0, **options).collect())


def test_query_equals_sql(spark):
    got = Counter(tuple(r) for r in LLM_QUERIES["op12_hard_negatives"](spark, SF).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = Counter(con.sql(llm_oracle_sql()["op12_hard_negatives"]).fetchall())
    assert got == want and len(got) > 100


def awkward(seed, n=120):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(0, 3)), (rng.integers(-4, 5, 6) / 4).tolist()) for i in range(n)]
    rows += [(i, 0, [0.5] * 6) for i in range(n, n + 60)]  # a third of all rows is one vector
    rows += [(5, 1, rows[5][2]), (5, 1, rows[5][2]), (7, 2, [1.0, 1.0]), (500, 9, [0.25] * 6), (505, 1, [])]
    rows += [(510, None, [1.0] * 6), (515, 1, None), (520, 1, [1.0, None]), (525, 1, [float("nan")] * 6)]
    rows += [(530, 1, [float("inf")] * 6), (None, 1, [0.75] * 6), (None, 2, [0.5] * 6), (535, 2, [0.0] * 6)]
    return rows


@pytest.mark.parametrize("block_rows,anchor_rows", [(4096, 4096), (16, 8)])
def test_awkward_rows_match_brute_force(spark, block_rows, anchor_rows):
    rows = awkward(3)
    want = expected(rows, lambda i: i % 5 == 0)
    assert mined(spark, rows, block_rows=block_rows, anchor_rows=anchor_rows) == want and len(want) > 50


def test_other_sizes_and_large_components(spark):
    rows = [(i, label, v and [x and x * 3e6 for x in v]) for i, label, v in awkward(4)]
    want = expected(rows, lambda i: i % 5 == 0, positives=2, negatives=4, low=10, high=99)
    assert max(abs(k[4]) for k in want) >= 1 << 53
    assert mined(spark, rows, positives=2, negatives=4, low=10, high=99, block_rows=32) == want


def test_empty_table(spark):
    assert not mined(spark, []) and not mined(spark, [(5, None, [1.0])]) and not mined(spark, [(5, 1, [1.0])])


def as_rows(ids, labels, vectors, positives=None):
    lists = pa.array(list(map(list, vectors)), pa.list_(pa.int64()))
    kind = pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())]))
    positives = pa.array(positives or [None] * len(ids), kind)
    names = ["row", "id", "label", "v", "positives"]
    return Rows([pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array(labels), lists, positives], names)])


def test_search_stops_early_where_lists_fall_off():
    """One dimension carries the scores: the heads of the lists settle the search, ties at the end included."""
    n = 4000
    rng = np.random.default_rng(1)
    vectors = rng.integers(-1, 2, (n, 8))
    vectors[:, 0] = np.where(np.arange(n) < 40, 1000 - np.arange(n) // 8, 0)
    block = as_rows(list(range(n)), ["x"] * n, vectors)
    met = []
    for kind in (Positives, Windows):
        asked = as_rows([n + 1], ["x" if kind is Positives else "y"], [[100] + [1] * 7], [[{"id": 1, "score": 150_000}]])
        search = Positives(asked, 5) if kind is Positives else Windows(asked, 3, 50, 95)
        visit, here = search.visit, []
        search.visit = lambda q, rows, scores: (here.append(len(rows)), visit(q, rows, scores))  # noqa: B023
        scan(search, block)
        scores = sorted(((int(vectors[i] @ asked.vectors[0]), -i) for i in range(n)), reverse=True)
        if kind is Positives:
            assert search.found[0] == [(s, -i) for s, i in scores[:5]]
        else:
            assert search.windows[0][150_000] == [(s, -i) for s, i in scores if 75_000 <= s <= 142_500][:3]
        met.append(max(here))
    assert max(met) < n / 4, met


def test_a_block_that_cannot_matter_is_not_read():
    good = as_rows([1, 2], ["x", "x"], [[100, 0], [90, 0]])
    poor = as_rows([3, 4], ["x", "x"], [[10, 0], [9, 0]])
    search = Positives(as_rows([9], ["x"], [[1, 0]]), 2)
    scan(search, good)
    search.visit = None
    scan(search, poor)
    assert search.found == [[(100, 1), (90, 2)]]
    assert hard_negatives.DEPTHS[0] >= 1
