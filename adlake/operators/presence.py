"""Exact distinct counts that add up: which integer keys occur, as bitmaps.

A bitmap tells which of 32,768 neighbouring keys occur in a group. Bitmaps are built before the shuffle, take four
kilobytes however often keys repeat, and are merged by or: months into years, one load into all loads. So counts over any
rollup come from the stored bitmaps, without another look at the rows. Keys should be dense, as surrogate keys are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_bitmaps(frame: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """by, bucket, bitmap: the keys that occur in each group; a null key is none."""
    known = frame.filter(F.col(key).isNotNull()).withColumn("bucket", F.bitmap_bucket_number(F.col(key).cast("bigint")))
    return known.groupBy(*by, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key).cast("bigint"))).alias("bitmap"))


def merged(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several loads."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_keys(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Per group the number of distinct keys."""
    return merged(bitmaps, by).groupBy(*by).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
