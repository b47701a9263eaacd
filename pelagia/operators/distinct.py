"""Exact distinct counts that merge: one bit per value, kept per key.

Values get dense codes, so a key's set of values is a short bitmap. Bitmaps of samples merge by OR
to stations, regions or years; a count of any grouping is read from the stored bitmaps, exactly and
without the raw rows. Codes are given part by part of a hash of the value, so no task numbers all
values, and equal inputs always give equal codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts in which values are numbered; the table of their sizes has as many rows.
PARTS = 256
#: Bits of a word, the piece in which a bitmap is kept and merged.
WORD = 64


def dense_codes(values: DataFrame, column: str, parts: int = PARTS) -> DataFrame:
    """column, code: the distinct non-NULL values numbered from 0 without gaps."""
    part = F.pmod(F.xxhash64(column), F.lit(parts)).alias("__part")
    distinct = values.filter(F.col(column).isNotNull()).select(column).distinct().select(column, part)
    sizes = distinct.groupBy("__part").count()
    # At most ``parts`` rows meet here.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    nth = F.row_number().over(Window.partitionBy("__part").orderBy(column))
    return distinct.withColumn("__nth", nth).join(offsets, "__part").select(column, (F.col("__offset") + F.col("__nth") - 1).cast("bigint").alias("code"))


def value_bitmaps(rows: DataFrame, keys: list[str], column: str, codes: DataFrame) -> DataFrame:
    """keys, bucket, bits: which values each key has. Rows reduce to bits before the shuffle.

    A row holds one word of a key's bitmap and no word is empty, so a key with few values is as
    short as they are, and a task holds 8 bytes a word, not a buffer of fixed size for each key.
    """
    coded = rows.filter(F.col(column).isNotNull()).select(*keys, column).join(codes, column)
    word = F.floor(F.col("code") / WORD).cast("bigint").alias("bucket")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("code", F.lit(WORD)).cast("int"))
    return coded.groupBy(*keys, word).agg(F.bit_or(bit).alias("bits"))


def merged(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of finer keys as those of coarser ones."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Exact number of distinct values per key, from bitmaps of these or finer keys."""
    return merged(bitmaps, keys).groupBy(*keys).agg(F.sum(F.bit_count("bits")).cast("bigint").alias(name))
