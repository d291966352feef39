"""A Bloom filter of keys as a table of bitmaps, from built-in functions.

A key sets HASHES bits of BITS. The bits lie in bitmaps of 32,768, so the
filter has at most BITS / 32,768 rows of 4 KB however many keys it has seen:
2 MB, which is why it may be broadcast. It passes every row that has one of
the keys and few others, until there are far more than BITS / 8 keys; then it
passes more, and never fewer.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

BITS = 1 << 24
HASHES = 2
BITMAP_BITS = 32768


def _bit(key: Column, which: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(which), key), F.lit(BITS))


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """bucket, bits of the non-null values of a column; each task combines its
    own bitmaps before they are shuffled."""
    bits = keys.where(F.col(key).isNotNull()).select(
        F.explode(F.array(*[_bit(F.col(key), which) for which in range(HASHES)])).alias("bit")
    )
    return bits.groupBy(F.floor(F.col("bit") / BITMAP_BITS).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("bit") % BITMAP_BITS).alias("bits")
    )


def may_match(rows: DataFrame, key: str, filtered: DataFrame) -> DataFrame:
    """The rows whose key may be among those of the filter; the filter goes to
    every task, and rows without it are not shuffled."""
    def passed(rows: DataFrame, which: int) -> DataFrame:
        side = F.broadcast(filtered.select(F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits")))
        bit = _bit(F.col(key), which)
        within = bit % BITMAP_BITS
        octet = F.conv(F.hex(F.substring(F.col("__bits"), (within / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.floor(octet / F.pow(F.lit(2), within % 8)) % 2 == 1
        joined = rows.join(side, (F.floor(bit / BITMAP_BITS).cast("int") == F.col("__bucket")) & is_set)
        return joined.drop("__bucket", "__bits")

    return reduce(passed, range(HASHES), rows)
