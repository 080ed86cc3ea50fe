"""Common entries of two very long lists, by bitmaps of the ids in them.

Bitmaps are cut into buckets of ``BUCKET_IDS`` neighbouring ids, so a list is many small rows, dealt to tasks by
list and bucket, and two lists meet bucket by bucket. A bucket costs ``BUCKET_IDS`` / 8 bytes however many ids of
it are in the list: that is less than the ids themselves where a list holds at least one id in ``DENSE``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .skew import HotKeys, spread_join

# Fixed layout of the built-in bitmap functions: ids per bucket; here also read as words of 32 bits.
BUCKET_IDS = 32768
WORD_BITS = 32
# One id in so many takes as much room as a 64-bit number as in the bitmap.
DENSE = 64


def bitmaps(lists: DataFrame, key: str, item: str) -> DataFrame:
    """``(key, bucket, bits)`` of the ids ``item`` of every key; the ids are dealt out by key and bucket first, as
    bitmaps made before the shuffle would mostly be empty."""
    placed = lists.select(key, F.bitmap_bucket_number(item).alias("bucket"), F.bitmap_bit_position(item).alias("bit"))
    placed = placed.repartition(F.col(key), F.col("bucket"))
    return placed.groupBy(key, "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def ids_of(bucket: Column, bits: Column) -> Column:
    """The ids of a bitmap in ascending order of their bits, as an array."""
    size = WORD_BITS // 8
    words = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKET_IDS // WORD_BITS - 1)),
        lambda w: F.struct(w.alias("w"), F.conv(F.hex(F.substring(bits, w * size + 1, F.lit(size))), 16, 10).cast("bigint").alias("x")),
    )
    # Bits count from the low end of each byte, bytes from the first on.
    places = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))

    def of_word(word: Column) -> Column:
        hit = F.filter(places, lambda p: F.getbit(word["x"], F.floor((WORD_BITS - 8) - p + 2 * (p % 8)).cast("int")) == 1)
        return F.transform(hit, lambda p: word["w"] * WORD_BITS + p)

    found = F.flatten(F.transform(F.filter(words, lambda word: word["x"] != 0), of_word))
    start = bucket * BUCKET_IDS
    return F.transform(found, lambda p: F.when(bucket > 0, start - BUCKET_IDS + p + 1).otherwise(start - p))


def common_ids(lists: DataFrame, pairs: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """``(u1, u2, friend)``: the ids that are in the lists ``(uid, friend)`` of both users of a pair."""
    wanted = pairs.select(F.explode(F.array("u1", "u2")).alias("uid")).distinct()
    own = spread_join(lists.select("uid", "friend"), wanted, "uid", "left_semi", left_hot=hot)
    maps = bitmaps(own, "uid", "friend")
    sides = pairs.select("u1", "u2", F.explode(F.array("u1", "u2")).alias("uid"))
    met = sides.join(maps, "uid").groupBy("u1", "u2", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
    both = met.where((F.col("n") == 2) & (F.bitmap_count("bits") > 0))
    return both.select("u1", "u2", F.explode(ids_of(F.col("bucket"), F.col("bits"))).alias("friend"))
