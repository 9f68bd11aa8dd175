"""Rows of a large table whose keys occur in a smaller one, found before the large one is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadgrain.functions.columns import join_null_safe
from loadgrain.plans.small import pin_small, stored

# a bitmap of 2**27 bits travels as 4,096 rows of 4 KB, 16 MB whatever the number of keys
BITMAP_BITS = 1 << 27


def rows_with_keys(rows: DataFrame, keys: DataFrame, on: list[str], bits: int = BITMAP_BITS) -> DataFrame:
    """The ``rows`` whose ``on`` occurs in ``keys`` (null matches null), by a join that doesn't shuffle ``rows``.

    Few keys are sent to the rows and the result is exact. More keys set one bit each in a bitmap of bounded size, and rows
    whose bit is not set go: some others may stay, so the join that follows has to decide; ``keys`` is computed once either way.
    """
    wanted, n = pin_small(keys.select(*on).distinct())
    if n is not None:
        return join_null_safe(rows, wanted, on, "left_semi")
    # the same bit for the same key on both sides, nulls included
    bit = F.pmod(F.xxhash64(*on), F.lit(bits))
    marks = wanted.select(bit.alias("_bit")).groupBy(F.bitmap_bucket_number("_bit").alias("_bucket"))
    bitmap = stored(marks.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_bit")).alias("_bits")), "key-bitmap")
    names = rows.columns
    rows = rows.withColumn("_bit", bit).withColumn("_of", F.bitmap_bucket_number("_bit"))
    found = rows.join(F.broadcast(bitmap), F.col("_of") == F.col("_bucket"))
    return found.filter(_is_set(F.col("_bits"), F.bitmap_bit_position("_bit"))).select(*names)


def _is_set(bits: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is 1, as ``bitmap_construct_agg`` sets it: the lowest bit of a byte comes first."""
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # F.shiftright takes constants only
    return F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(position, F.lit(8)))), F.lit(2)) == 1
