"""SimHash near-duplicates with a Gray-ordered hierarchical index.

Fingerprint: 64 bits, each set where over half of the hashes of a text's word shingles have
it set. Two fingerprints link at ``max_bits`` or fewer differing bits; documents belong to
one component when links connect their fingerprints.

Every fingerprint is filed under several masks: the bits are cut into ``n_blocks`` blocks,
and a mask keeps ``n_blocks - max_bits`` of them. Fingerprints that link differ in at most
``max_bits`` blocks, so they agree under some mask and meet in that bucket: no link is
missed. Inside a bucket the hierarchical index finds the links: the bucket's fingerprints
lie in Gray order, where neighbours share long bit patterns; every ``LEAF`` of them make a
leaf that holds the pattern and the mask of the bits on which all agree, every ``FANOUT``
nodes the next upper node. Leaves are small, as the bits on which codes agree by chance halve with each further
code: of 5,000 random codes of a bucket three neighbours agree on some 39 bits, sixteen on some 28. A search goes down from the root, adds at each node the
differences in the bits that the node fixes beyond its parent, and leaves a whole group as
soon as the sum exceeds ``max_bits``.

A bucket gives its links' spanning forest, at most a row for each of its fingerprints, never
its pairs. Copies of a text are one fingerprint from the start. A bucket of over
``bucket_rows`` different fingerprints is cut by hash into parts, and every two parts meet in
a task of their own, so no task holds more than two parts. Tasks read their buckets sorted,
one after the other.

Cases: a null or empty text has no shingles and the fingerprint zero, linked like any other;
fewer words than a shingle give the whole sequence; repeated rows have one component; a null
id takes no part in the smallest id (a component of null ids only has a null one); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import Forest, connected_components, slices, utf8
from affinity.session import write_stage

LEAF = 3
FANOUT = 16
#: Query-to-fingerprint comparisons that are held at a time, at most, unless one query has more.
BLOCK_PAIRS = 500_000
#: Rows that a task gathers before it links the buckets that are complete.
CHUNK_ROWS = 100_000


def shingle_hashes(text: bytes | None, words: int, seed: int = 42) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; words are parted by ASCII white space."""
    parts = text.lower().split() if text else []
    if not parts:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    ends = np.cumsum(sizes + 1) - 1
    k = min(words, len(parts))
    starts = (ends - sizes)[: len(parts) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist())], dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Unsigned 64 bits; zero for no hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 1 << 14):
        part = hashes[lo : lo + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int, schema: pa.Schema):
    for batch in slices(batches):
        codes = [fingerprint(shingle_hashes(t, words)) for t in utf8(batch, "text")]
        codes = np.array(codes, dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codes, pa.int64())], schema=schema)


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """doc_id, code (the fingerprint as a signed long)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    arrow = {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())
    schema = pa.schema([("doc_id", arrow), ("code", pa.int64())])
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _fingerprints(it, shingle_words, schema), f"doc_id {kind}, code long"
    )


def block_masks(n_blocks: int, max_bits: int) -> list[int]:
    """Every choice of blocks that must stay whole, as a signed 64-bit mask."""
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(blocks, n_blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def gray_rank(code):
    """The place of a code in Gray order: the exclusive or of all its right shifts."""
    for s in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, s))
    return code


class GrayIndex:
    """The hierarchical index over codes that lie in (bucket, Gray rank) order; a root for each bucket."""

    def __init__(self, codes: np.ndarray, bucket_starts: np.ndarray):
        self.codes, self.compared = codes, 0
        self.levels = []  # from the leaves up: first code, first child, pattern, mask
        n = len(codes)
        first, group = np.arange(n), np.repeat(np.arange(len(bucket_starts)), np.diff(bucket_starts, append=n))
        low = high = codes
        while True:
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            place = np.arange(len(group)) - np.repeat(starts, np.diff(starts, append=len(group)))
            child = np.flatnonzero(place % (FANOUT if self.levels else LEAF) == 0)
            low, high = np.bitwise_and.reduceat(low, child), np.bitwise_or.reduceat(high, child)
            first, group = first[child], group[child]
            self.levels.append((np.append(first, n), np.append(child, len(place)), low, ~(low ^ high)))
            if len(group) == len(bucket_starts):
                return

    def links(self, lo: int, hi: int, bucket_of: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Links of codes lo..hi-1 to later codes of their buckets; ``compared`` counts the pairs looked at."""
        query, node = np.arange(lo, hi), bucket_of[lo:hi]
        _, _, _, fixed = self.levels[-1]
        sums, above = np.zeros(hi - lo, dtype=np.int64), fixed[node]
        for depth in range(len(self.levels) - 1, -1, -1):
            first, child, pattern, mask = self.levels[depth]
            if depth < len(self.levels) - 1:
                later = first[node + 1] > query + 1
                differ = (self.codes[query] ^ pattern[node]) & mask[node] & ~above
                sums = sums + np.bitwise_count(differ)
                stay = later & (sums <= max_bits)
                query, node, sums = query[stay], node[stay], sums[stay]
                above = mask[node]
            n = child[node + 1] - child[node]
            query, sums, above = np.repeat(query, n), np.repeat(sums, n), np.repeat(above, n)
            node = np.repeat(child[node] - np.cumsum(n) + n, n) + np.arange(n.sum())
        stay = node > query
        query, node, sums, above = query[stay], node[stay], sums[stay], above[stay]
        self.compared += len(query)
        stay = sums + np.bitwise_count((self.codes[query] ^ self.codes[node]) & ~above) <= max_bits
        return query[stay], node[stay]


def linked(codes: np.ndarray, starts: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside each bucket: (code's place, its root's place)."""
    forest = Forest(len(codes))
    if len(codes):
        index = GrayIndex(codes, starts)
        sizes = np.diff(starts, append=len(codes))
        bucket_of = np.repeat(np.arange(len(starts)), sizes)
        pairs = np.cumsum(sizes[bucket_of])
        lo = 0
        while lo < len(codes):
            done = pairs[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(pairs, done + BLOCK_PAIRS, side="right")))
            forest.link(*index.links(lo, hi, bucket_of, max_bits))
            lo = hi
    roots = forest.labels()
    child = np.flatnonzero(roots != np.arange(len(codes)))
    return child, roots[child]


def _link_buckets(batches: Iterator[pa.RecordBatch], max_bits: int, schema: pa.Schema):
    """Rows (mask, key, part, other, code) in order -> links (a, b)."""
    names = ("mask", "key", "part", "other", "code")
    held = [np.empty(0, dtype=np.int64) for _ in names]

    def run(cols):
        head, codes = cols[:4], cols[4].view(np.uint64)
        new = np.zeros(len(codes), dtype=bool)
        new[:1] = True
        for c in head:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        # Buckets of one code have no links.
        sizes = np.diff(starts, append=len(codes))
        full = np.repeat(sizes > 1, sizes)
        codes, sizes = codes[full], sizes[sizes > 1]
        child, root = linked(codes, np.cumsum(sizes) - sizes, max_bits)
        back = codes.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(back[child]), pa.array(back[root])], schema=schema)

    for batch in batches:
        new = [batch.column(c).cast(pa.int64()).to_numpy(zero_copy_only=False) for c in names]
        held = [np.concatenate([a, b]) for a, b in zip(held, new)]
        if len(held[0]) >= CHUNK_ROWS:
            same = np.ones(len(held[0]), dtype=bool)
            for c in held[:4]:
                same &= c == c[-1]
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield run([c[:cut] for c in held])
                held = [c[cut:] for c in held]
    yield run(held)


def fingerprint_links(codes: DataFrame, max_bits: int = 4, n_blocks: int = 6, bucket_rows: int = 8192) -> DataFrame:
    """Distinct codes (``code``) -> links (a, b) that connect what links at ``max_bits`` connect."""
    masks = block_masks(n_blocks, max_bits)
    filed = codes.select(
        "code",
        F.posexplode(F.array(*(F.col("code").bitwiseAND(F.lit(m)) for m in masks))).alias("mask", "key"),
    )
    filed = filed.withColumn("key", F.xxhash64("mask", "key"))
    large = write_stage(
        filed.groupBy("mask", "key").count().where(F.col("count") > bucket_rows), "simhash_large"
    )
    n_parts = F.ceil(F.col("count") / bucket_rows)
    part = F.pmod(F.xxhash64("code"), n_parts)
    others = F.filter(F.sequence(F.lit(0), n_parts - 1), lambda k: k != F.col("own"))
    dealt = filed.join(large, ["mask", "key"], "left").withColumn("own", part)
    dealt = dealt.withColumn("other", F.explode(F.when(F.col("count").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(others)))
    dealt = dealt.select(
        "mask",
        "key",
        F.coalesce(F.least("own", "other"), F.lit(-1)).cast("long").alias("part"),
        F.coalesce(F.greatest("own", "other"), F.lit(-1)).cast("long").alias("other"),
        "code",
    )
    dealt = dealt.withColumn("part", F.when(F.col("other") < 0, F.lit(-1)).otherwise(F.col("part")))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return (
        dealt.repartition("key", "part", "other")
        .sortWithinPartitions("mask", "key", "part", "other", gray_rank(F.col("code")))
        .mapInArrow(lambda it: _link_buckets(it, max_bits, schema), "a long, b long")
    )


def simhash_components(
    docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, n_blocks: int = 6, bucket_rows: int = 8192
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id reachable)."""
    each = write_stage(fingerprints(docs, shingle_words), "simhash_docs")
    codes = write_stage(each.groupBy("code").agg(F.min("doc_id").alias("low")), "simhash_codes")
    links = write_stage(fingerprint_links(codes.select("code"), max_bits, n_blocks, bucket_rows), "simhash_links")
    roots = write_stage(connected_components(links).select(F.col("node").alias("code"), "root"), "simhash_roots")
    named = codes.join(roots, "code", "left").select("code", "low", F.coalesce("root", "code").alias("root"))
    named = write_stage(named, "simhash_named")
    low = write_stage(named.groupBy("root").agg(F.min("low").alias("component_id")), "simhash_low")
    component = write_stage(named.join(low, "root").select("code", "component_id"), "simhash_components")
    return each.join(component, "code").select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id"
    )
