"""Exact distinct counts that can be merged: bitmaps over numbered values.

A dictionary numbers values from 1 without gaps and only ever grows. For each group, one
bitmap row for every 32,768 numbers tells which values it has; rows of several groups or
batches merge by "or", so the count over any set of groups needs no value again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hash blocks that new values are numbered in; their counts fit one task.
BLOCKS = 1_024


def new_numbers(
    values: DataFrame, value: str, dictionary: DataFrame | None = None
) -> DataFrame:
    """(value, number) of the values that the dictionary does not hold yet; nulls have none.

    Values are numbered within hash blocks, and blocks follow one another, so no task
    sorts all of them; equal input gives equal numbers.
    """
    fresh = values.select(value).where(F.col(value).isNotNull()).distinct()
    last = F.lit(0).cast("bigint")
    if dictionary is not None:
        fresh = fresh.join(dictionary.select(value), value, "left_anti")
        last = F.coalesce(dictionary.agg(F.max("number")).scalar(), last)
    blocked = fresh.withColumn("_block", F.pmod(F.xxhash64(value), F.lit(BLOCKS)))
    within = F.row_number().over(Window.partitionBy("_block").orderBy(value))
    # One row for each block, BLOCKS at most.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocked.groupBy("_block")
        .agg(F.count("*").alias("_rows"))
        .select("_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    return (
        blocked.withColumn("_within", within)
        .join(starts, "_block")
        .select(value, (last + F.col("_start") + F.col("_within")).cast("bigint").alias("number"))
    )


def bitmaps(rows: DataFrame, keys: list[str], value: str, dictionary: DataFrame) -> DataFrame:
    """keys, bucket and bitmap: which numbered values each group has."""
    numbered = rows.select(*keys, value).distinct().join(dictionary, value)
    return numbered.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def count_merged(maps: DataFrame, *keys: str) -> DataFrame:
    """keys and values: the exact number of distinct values of all rows of a key."""
    merged = maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias("values"))


def count_by_range(maps: DataFrame, ranges: DataFrame, day: str, *keys: str) -> DataFrame:
    """first_day, last_day, keys and values: distinct values of all days of each range.

    ``ranges`` has first_day and last_day, ends included. A range meets its days by a
    plain join on the day; a range without any row is left out.
    """
    days = ranges.distinct().select(
        "first_day",
        "last_day",
        F.explode(F.sequence("first_day", "last_day")).alias(day),
    )
    return count_merged(maps.join(days, day), "first_day", "last_day", *keys)
