"""Pruning before a join: a Bloom filter that executors build as bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 5
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 26  # 4 KB to 8 MB, which is what is broadcast at most
WORD = 1 << 15  # bits of one bitmap of Spark's functions


def bits_for(n: int) -> int:
    """A power of two with ten bits or more for each of ``n`` keys, within bounds: beyond them more rows pass that have no match, and no row is lost."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (10 * max(n, 1) - 1).bit_length()))


def _places(key: Column | str, bits: int) -> list[Column]:
    """From 1 on, as Spark's bitmaps count."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) + 1 for i in range(HASHES)]


def bitmaps(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """One row, maps: bitmap by number, of the places of all keys of ``rows``. Partial bitmaps are made where the rows are, so no key is shuffled."""
    each = rows.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(key, bits))).alias("p"))
    parts = each.groupBy(F.bitmap_bucket_number("p").alias("number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("map"))
    return parts.agg(F.map_from_entries(F.collect_list(F.struct("number", "map"))).alias("maps"))  # bits / WORD entries at most


def may_have(key: Column | str, maps: Column | str, bits: int) -> Column:
    """False for a key that no row of ``bitmaps`` has; nearly always for another one."""
    maps = F.col(maps) if isinstance(maps, str) else maps

    def is_set(p: Column) -> Column:
        at = F.bitmap_bit_position(p)
        byte = F.conv(F.hex(F.substring(F.element_at(maps, F.bitmap_bucket_number(p)), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.coalesce(F.expr("1") == F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")), F.lit(False))

    out = F.lit(True)
    for p in _places(key, bits):
        out = out & is_set(p)
    return out


def split(live: DataFrame, history: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``live`` whose ``key`` history may have, and those whose key it has for certain not (null keys among these). Only the first need a join."""
    n = history.agg(F.approx_count_distinct(key).alias("n")).first()["n"]
    bits = bits_for(n)
    tested = live.join(F.broadcast(bitmaps(history, key, bits))).withColumn("__may", F.col(key).isNotNull() & may_have(key, "maps", bits)).drop("maps")  # one row of 8 MB at most
    return tested.where("__may").drop("__may"), tested.where("NOT __may").drop("__may")
