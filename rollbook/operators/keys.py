"""Keys of a new part against the keys that are stored: Bloom filters first, an exact join last.

A filter is a small table of bitmaps, a Bloom filter with one hash, built and combined by
Spark's bitmap aggregates; its size is BITS / 8 bytes whatever the number of keys, so it can
be broadcast.  Each side is cut to the keys that the other side's filter lets through, and only
those meet in a join.  With more keys than bits a filter lets most through: the join is larger
then, the result the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26  # 8 MB of bitmaps
_BUCKET = 1 << 15  # bits of one row, fixed by Spark's bitmap functions


def place_of(key: str, bits: int = BITS) -> Column:
    """1 to ``bits``: the bit of a key."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def key_filter(keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(bucket, bitmap): at most bits / 32768 rows.  Combined map-side; nulls are no keys."""
    place = place_of(key, bits)
    return keys.filter(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(place).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__bitmap")
    )


def let_through(rows: DataFrame, key: str, known: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows whose key may be one that ``known`` was made of."""
    placed = rows.withColumn("__place", place_of(key, bits))
    held = placed.join(F.broadcast(known), F.bitmap_bucket_number("__place") == F.col("__bucket"))
    position = F.bitmap_bit_position("__place")
    byte = F.conv(F.hex(F.substr("__bitmap", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    bit = F.call_function("shiftright", byte.cast("int"), (position % 8).cast("int"))
    return held.filter(bit.bitwiseAND(1) == 1).select(*rows.columns)


def shared_keys(new: DataFrame, stored: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(key) of both sides, once each.  ``new`` is read twice, so it should be a written table."""
    fresh = let_through(new.filter(F.col(key).isNotNull()).select(key), key, key_filter(stored, key, bits), bits)
    old = let_through(stored.select(key), key, key_filter(new, key, bits), bits)
    return fresh.distinct().join(old.distinct(), key, "left_semi")
