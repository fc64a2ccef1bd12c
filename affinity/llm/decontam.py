"""Benchmark decontamination with a positional inverted index that is split by document.

1. One pass over the texts stores, for each document, the posting lists of the benchmark's
   terms: the terms that occur, how often, and their word positions, ordered by term. The
   table lies in the shared checkpoint folder; every later step reads it, never the texts.
2. The terms' counts over the whole corpus come from the lists' lengths.
3. Every window of an item (``window`` consecutive words; a shorter item is one window) has
   its terms ordered from the rarest. A task inverts the lists of a slice of documents into
   (term, position) order, starts from the rarest term's list shifted by the term's place in
   the window, and intersects it with the shifted lists of the next rarest ones until all
   words have been met: what stays are the exact occurrences. A proximity match is an
   occurrence of the rarest term with the next two rarest within ``slop`` words of it.

Nothing is shuffled but one row a term and task, and no list outgrows its document. The
benchmark is taken in parts of at most ``part_chars`` characters, so what a task holds of it
is bounded: some 17 bytes a word and the vocabulary (``Windows``). A task lays out windows and their
candidate places in blocks of at most ``BLOCK_WINDOWS`` and ``BLOCK_PLACES`` (or those of one window). The parts'
results are merged by document.

Cases: a null text has no words and gives a row of zeros; items without words are left out;
items with the same id count once; an item with a null id is named by the empty string;
repeated documents are separate rows; an empty benchmark or table is allowed; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import lists, slices, utf8
from affinity.session import write_stage

WINDOW = 10
SLOP = 20
#: Characters of the benchmark that a task holds at a time.
PART_CHARS = 20_000_000
#: Windows, and places of their rarest terms, that a task intersects at a time.
BLOCK_WINDOWS = 1 << 14
BLOCK_PLACES = 1 << 20
#: Rarest terms that must meet for a proximity match.
NEAR_TERMS = 3

#: Bytes of words, A-Z lower-cased before: digits, a-z and everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


class Windows:
    """The windows of a part of the benchmark: the words' term numbers, and of each window its first word, length,
    item and rarest term. Its words in order of rarity are laid out when they are asked for."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.items)}
        ids, first, length, item, at = [], [], [], [], 0
        for name, text in items:
            words = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)], dtype=np.int32)
            if not len(words):
                continue
            n = min(window, len(words))
            starts = np.arange(at, at + len(words) - n + 1, dtype=np.int32)
            ids.append(words)
            first.append(starts)
            length.append(np.full(len(starts), n, dtype=np.int8 if window < 128 else np.int32))
            item.append(np.full(len(starts), number[name], dtype=np.int32))
            at += len(words)
        none = [np.empty(0, dtype=np.int32)]
        self.ids, self.first, self.length, self.item = (np.concatenate(x or none) for x in (ids, first, length, item))
        self.rare = none[0]

    def __len__(self) -> int:
        return len(self.first)

    def order_by(self, counts: np.ndarray) -> None:
        """Set the terms' counts over the corpus, which say how rare they are."""
        self.counts = counts
        rare = [self.laid_out(np.arange(lo, min(len(self), lo + BLOCK_WINDOWS)))[0][:, 0] for lo in range(0, len(self), BLOCK_WINDOWS)]
        self.rare = np.concatenate(rare).astype(np.int32) if rare else self.rare

    def laid_out(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms and places of windows, from the rarest; what pads a short window is -1 and comes last."""
        inside = np.arange(self.window)[None, :] < self.length[chosen][:, None]
        at = np.where(inside, self.first[chosen][:, None] + np.arange(self.window)[None, :], 0)
        terms = np.where(inside, self.ids[at].astype(np.int64), -1)
        rarity = np.where(inside, self.counts[terms], np.iinfo(np.int64).max)
        places = np.argsort(rarity, axis=1, kind="stable")
        return np.take_along_axis(terms, places, axis=1), places


def _index(batches: Iterator[pa.RecordBatch], vocab: dict[bytes, int], schema: pa.Schema):
    get = vocab.get
    for batch in slices(batches):
        n_words, n_terms, n_positions, terms, counts, positions = [], [], [], [], [], []
        for text in utf8(batch, "text"):
            words = words_of(text)
            ids = np.fromiter((get(w, -1) for w in words), dtype=np.int32, count=len(words))
            at = np.flatnonzero(ids >= 0)
            at = at[np.argsort(ids[at], kind="stable")]
            t = ids[at]
            new = np.flatnonzero(np.diff(t, prepend=-1))
            terms.append(t[new])
            counts.append(np.diff(new, append=len(t)))
            positions.append(at)
            n_words.append(len(words))
            n_terms.append(len(new))
            n_positions.append(len(at))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                lists(np.concatenate(terms).astype(np.int32), n_terms, pa.int32()),
                lists(np.concatenate(counts).astype(np.int32), n_terms, pa.int32()),
                lists(np.concatenate(positions).astype(np.int32), n_positions, pa.int32()),
            ],
            schema=schema,
        )


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(column.offsets.to_numpy())


def _runs(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers lo[i], lo[i] + 1, ... (n[i] of them) for each i in turn."""
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def _blocks(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of windows with ``n`` places each, of at most ``BLOCK_WINDOWS`` and ``BLOCK_PLACES``, or one window."""
    upto, lo = np.concatenate(([0], np.cumsum(n))), 0
    while lo < len(n):
        fits = int(np.searchsorted(upto, upto[lo] + BLOCK_PLACES, side="right")) - 1
        hi = min(max(fits, lo + 1), lo + BLOCK_WINDOWS, len(n))
        yield lo, hi
        lo = hi


def match_windows(
    key_doc: np.ndarray, key_term: np.ndarray, key_at: np.ndarray, w: Windows, n_docs: int, slop: int
) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Postings (document, term, position) -> exact (document, window, start) and different near (document, item)."""
    none = np.empty(0, dtype=np.int64)
    if not len(w) or not len(key_term):
        return (none, none, none), (none, none)
    # One axis for all documents, with gaps that no window and no slop can cross.
    gap = max(slop, w.window) + 1
    longest = np.zeros(n_docs, dtype=np.int64)
    np.maximum.at(longest, key_doc, key_at + 1)
    base = np.cumsum(longest + gap) - longest
    span = int(base[-1] + longest[-1] + gap)
    keys = np.sort(key_term * span + base[key_doc] + key_at)

    def held(k: np.ndarray) -> np.ndarray:
        i = np.searchsorted(keys, k)
        return (i < len(keys)) & (keys[np.minimum(i, len(keys) - 1)] == k)

    n_places = np.bincount(key_term, minlength=len(w.vocab))[w.rare]
    active = np.flatnonzero(n_places)
    exact, near_pairs = [], [none]
    for first, last in _blocks(n_places[active]):
        chosen = active[first:last]
        terms, places = w.laid_out(chosen)
        lo, n = np.searchsorted(keys, terms[:, 0] * span), n_places[chosen]
        win = np.repeat(np.arange(len(n)), n)
        at = keys[_runs(lo, n)] - terms[win, 0] * span

        near = np.ones(len(win), dtype=bool)
        for k in range(1, min(NEAR_TERMS, w.window)):
            t = terms[win, k]
            i = np.searchsorted(keys, t * span + at - slop)
            near &= (t < 0) | ((i < len(keys)) & (keys[np.minimum(i, len(keys) - 1)] <= t * span + at + slop))
        near_doc = np.searchsorted(base, at[near], side="right") - 1
        near_pairs.append(np.unique(near_doc * len(w.items) + w.item[chosen[win[near]]]))

        start = at - places[win, 0]
        for k in range(1, w.window):
            t = terms[win, k]
            stay = (t < 0) | held(t * span + start + places[win, k])
            win, start = win[stay], start[stay]
        doc = np.searchsorted(base, start, side="right") - 1
        exact.append((doc, chosen[win], start - base[doc]))
    pairs = np.unique(np.concatenate(near_pairs))
    found = tuple(np.concatenate([e[k] for e in exact] or [none]) for k in range(3))
    return found, (pairs // len(w.items), pairs % len(w.items))


def _search(batches: Iterator[pa.RecordBatch], w: Windows, slop: int, schema: pa.Schema):
    for batch in slices(batches, 512):
        n_docs = batch.num_rows
        terms, n_terms = _flat(batch.column("terms"))
        counts, _ = _flat(batch.column("counts"))
        at, n_at = _flat(batch.column("positions"))
        doc = np.repeat(np.arange(n_docs), n_at)
        (doc, win, start), (near_doc, near_item) = match_windows(doc, np.repeat(terms, counts), at, w, n_docs, slop)
        # Merge the spans of each document.
        order = np.lexsort((start, doc))
        d, lo, hi = doc[order], start[order], (start + w.length[win])[order]
        far = d * (1 << 40)
        reach = np.maximum.accumulate(far + hi) if len(d) else far
        new = np.ones(len(d), dtype=bool)
        new[1:] = (d[1:] != d[:-1]) | (far[1:] + lo[1:] > reach[:-1])
        first = np.flatnonzero(new)
        end = reach[np.append(first[1:], len(d)) - 1] - far[first] if len(first) else lo[first]
        n_spans = np.bincount(d[first], minlength=n_docs)
        spans = np.stack([lo[first], end], axis=1).ravel()

        def names(doc, item):
            pair = np.unique(doc * len(w.items) + item)
            n = np.bincount(pair // max(1, len(w.items)), minlength=n_docs)
            return [w.items[i] for i in (pair % max(1, len(w.items))).tolist()], n

        hit, n_hit = names(doc, w.item[win])
        close, n_close = names(near_doc, near_item)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                batch.column("n_words"),
                lists(spans, 2 * n_spans, pa.int64()),
                lists(np.array(hit, dtype=object), n_hit, pa.string()),
                lists(np.array(close, dtype=object), n_close, pa.string()),
            ],
            schema=schema,
        )


def _arrow_id(df: DataFrame) -> tuple[str, pa.DataType]:
    kind = df.schema["doc_id"].dataType.simpleString()
    return kind, {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())


def find_benchmark_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    slop: int = SLOP,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """One row a document: doc_id, n_words, spans, items, near_items.

    ``spans``: the word ranges that exact occurrences of windows cover, as start, end, start,
    end, ...; ``items``: the ids of items with an exact occurrence; ``near_items``: of those
    with a proximity match.
    """
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n_parts = int(size // part_chars) + 1
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("i"), "text")
    doc_sql, doc_pa = _arrow_id(docs)
    # Several passes must agree on the rows, so the table is numbered and written first.
    texts = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    if n_parts > 1:
        texts = write_stage(texts, "numbered_documents")
    found = []
    for part in range(n_parts):
        chosen = items.where(F.pmod(F.xxhash64("i", "text"), F.lit(n_parts)) == part)
        w = Windows([(r["i"], (r["text"] or "").encode()) for r in chosen.collect()], window)
        index_schema = pa.schema(
            [("row", pa.int64()), ("doc_id", doc_pa), ("n_words", pa.int64())]
            + [(c, pa.list_(pa.int32())) for c in ("terms", "counts", "positions")]
        )
        index = write_stage(
            texts.mapInArrow(
                lambda it, vocab=w.vocab, schema=index_schema: _index(it, vocab, schema),
                f"row long, doc_id {doc_sql}, n_words long, terms array<int>, counts array<int>, positions array<int>",
            ),
            "postings",
        )
        counts = np.zeros(len(w.vocab), dtype=np.int64)
        each = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
        for r in each.groupBy("p.terms").agg(F.sum("p.counts").alias("n")).collect():
            counts[r["terms"]] = r["n"]
        w.order_by(counts)
        out = pa.schema(
            [("row", pa.int64()), ("doc_id", doc_pa), ("n_words", pa.int64()), ("spans", pa.list_(pa.int64()))]
            + [(c, pa.list_(pa.string())) for c in ("items", "near_items")]
        )
        found.append(
            index.select("row", "doc_id", "n_words", "terms", "counts", "positions").mapInArrow(
                lambda it, w=w, schema=out: _search(it, w, slop, schema),
                f"row long, doc_id {doc_sql}, n_words long, spans array<long>, items array<string>, near_items array<string>",
            )
        )
    if len(found) == 1:
        return found[0].drop("row")
    merged = reduce(DataFrame.unionByName, found).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        *(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("items", "near_items")),
    )
    return merged.drop("row").select("doc_id", "n_words", merged_spans(F.col("spans")).alias("spans"), "items", "near_items")


def merged_spans(spans):
    """Spans that may overlap, in any order -> disjoint ones in order."""
    pairs = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), (F.size(spans) / 2).cast("int") - 1),
            lambda i: F.struct(F.get(spans, 2 * i).alias("a"), F.get(spans, 2 * i + 1).alias("b")),
        )
    )
    start = F.lit(None).cast("array<bigint>")

    def add(acc, p):
        end = F.get(acc, F.size(acc) - 1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.greatest(end, p["b"])))
        apart = F.concat(acc, F.array(p["a"], p["b"]))
        return F.when((F.size(acc) > 0) & (p["a"] <= end), joined).otherwise(apart)

    return F.when(F.size(spans) == 0, spans).otherwise(
        F.aggregate(pairs, F.coalesce(start, F.array().cast("array<bigint>")), add)
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items, near_items."""
    m = find_benchmark_matches(docs, benchmark, **options)
    at = F.sequence(F.lit(0), F.size("spans") - 1)
    n_hit = F.when(F.size("spans") == 0, F.lit(0).cast("long")).otherwise(
        F.aggregate(
            F.transform(at, lambda i: F.when(i % 2 == 1, F.get("spans", i)).otherwise(-F.get("spans", i))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        )
    )
    return m.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
        "items",
        "near_items",
    )


def expected_rows(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The result by brute force, for tests."""
    texts = [(("" if i is None else str(i)), words_of(t.encode() if t else None)) for i, t in items]
    out = []
    for doc_id, text in docs:
        words = words_of(text.encode() if text else None)
        hit, found = set(), set()
        for name, item in texts:
            n = min(window, len(item))
            for lo in range(len(item) - n + 1 if n else 0):
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == item[lo : lo + n]:
                        hit.update(range(at, at + n))
                        found.add(name)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return out
