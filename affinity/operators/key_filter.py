"""Semi joins on key lists that are too large to broadcast.

A shuffle join sends every row of its large side, also those that it will drop. Where the list is too large
to be broadcast itself, a bit map of its keys' hashes is not: one bit in about eight is set for as many bits
a key, and a row whose bit is not set is in no list. So rows are checked against the broadcast map first, and
only those that pass (all of the list's, and about one of eight others) are shuffled to the exact join.

The map has at most ``MAX_BITS`` bits, 8 MB, whatever the list's size: that bound is what allows the broadcast
hint. Lists with more keys than that have bits are joined without it, as most bits would be set.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.session import write_stage

#: Bits of one row of the map; the size that Spark's ``bitmap_construct_agg`` has.
BUCKET_BITS = 1 << 15
MAX_BITS = 1 << 26
BITS_PER_KEY = 8
#: A good ``map_from``: lists with fewer keys are below Spark's own broadcast threshold of 10 MB.
MAP_FROM = 1 << 18


def bits_for(keys: int) -> int:
    """Bits of the map for so many keys, a multiple of a bucket's."""
    return min(MAX_BITS, -(-BITS_PER_KEY * keys // BUCKET_BITS) * BUCKET_BITS)


def _hash(col, bits: int):
    return F.pmod(F.xxhash64(col), F.lit(bits)) + F.lit(1)


def key_map(keys: DataFrame, bits: int) -> DataFrame:
    """(bucket, bits): the map of the only column of ``keys``; ``bits / BUCKET_BITS`` rows at most."""
    h = _hash(keys.columns[0], bits)
    return keys.groupBy(F.bitmap_bucket_number(h).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias("bits")
    )


def rows_that_may_match(df: DataFrame, col: str, table: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose key's bit is set: all with a key of the list, and some others."""
    h = _hash(F.col(f"rows.{col}"), bits)
    rows, maps = df.alias("rows"), table.alias("maps")
    bit = F.bitmap_bit_position(h)
    byte = F.substring("maps.bits", (bit / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (bit % 8).cast("int")) == 1
    # A semi join, as Spark would push the exact one below an inner join.
    return rows.join(F.broadcast(maps), (F.bitmap_bucket_number(h) == F.col("maps.bucket")) & is_set, "left_semi")


class KeyList(NamedTuple):
    """The keys to keep (one column), and their bit map where they have one."""

    keys: DataFrame
    table: DataFrame | None = None
    bits: int = 0


def key_list(keys: DataFrame, map_from: int | None = None) -> KeyList:
    """A one-column table as a list of keys (repeats and NULLs do no harm).

    With ``map_from`` the keys are written and counted, and a list of at least so many has a map.
    """
    keys = keys.where(F.col(keys.columns[0]).isNotNull())
    if map_from is None:
        return KeyList(keys)
    keys = write_stage(keys, "key_list")
    n = keys.count()
    if not max(1, map_from) <= n <= MAX_BITS:
        return KeyList(keys)
    return KeyList(keys, write_stage(key_map(keys, bits_for(n)), "key_map"), bits_for(n))


def semi_join(df: DataFrame, listed: KeyList, col: str) -> DataFrame:
    """The rows of ``df`` whose ``col`` is in the list."""
    rows = df if listed.table is None else rows_that_may_match(df, col, listed.table, listed.bits)
    return rows.join(listed.keys.toDF(col), col, "left_semi").select(*df.columns)
