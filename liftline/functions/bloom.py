"""A Bloom filter as a small table of bitmaps, built and asked with column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of one bitmap, as the bitmap functions make them; bits set per key; bits for each key; bitmaps at most (4 KB each).
BITS, HASHES, PER_KEY, BITMAPS = 32_768, 4, 16, 2_048


def _places(key: Column, bitmaps: int) -> tuple[Column, list[Column]]:
    return F.pmod(F.xxhash64(key), F.lit(bitmaps)), [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(BITS)) for k in range(HASHES)]


def bloom_filter(keys: DataFrame, column: str) -> tuple[DataFrame, int]:
    """((bitmap_number, bits), number of bitmaps) of the keys; each key has all its bits in one bitmap. At most ``BITMAPS`` rows of
    4 KB whatever the number of keys: beyond that the filter lets more through, never less."""
    n = keys.count()
    bitmaps = min(BITMAPS, max(1, -(-n * PER_KEY // BITS)))
    number, bits = _places(F.col(column), bitmaps)
    each = keys.where(F.col(column).isNotNull()).select(number.alias("bitmap_number"), F.explode(F.array(*bits)).alias("_bit"))
    return each.groupBy("bitmap_number").agg(F.bitmap_construct_agg("_bit").alias("_bits")), bitmaps


def likely_in(df: DataFrame, column: str, keys: DataFrame, key_column: str | None = None) -> DataFrame:
    """The rows of ``df`` whose key may be among ``keys``: none that is goes missing, few others stay. No shuffle of ``df``."""
    filter_rows, bitmaps = bloom_filter(keys, key_column or column)
    number, bits = _places(F.col(column), bitmaps)

    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        return F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(1) == 1

    asked = df.withColumn("bitmap_number", number).join(F.broadcast(filter_rows), "bitmap_number")
    for bit in bits:
        asked = asked.where(is_set(bit))
    return asked.select(*df.columns)
