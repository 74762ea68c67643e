"""Exact sets of people as bitmaps: counted, joined and intersected without the rows they came from.

A key's dense number says its bit: a bitmap of 4 KB holds 32,768 people. Sets of several stages,
parts or releases are combined bitmap by bitmap, so a count over any of them reads a few bytes for
a thousand people and no fact. Keys without a number are kept one by one, so nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# part of a stage; the bitmap's number and the bitmap; a key without a number; rows of the part
SET_COLUMNS = ("part", "bucket", "people", "loose", "total")


def people_sets(
    df: DataFrame, key: str, numbers: DataFrame, parts: dict[str, Column] | None = None
) -> DataFrame:
    """The people of `df`, and of each of its parts, as sets.

    `parts` maps a part to the number of its rows that a row of `df` stands for, 0 for none; without
    them, all rows are one part without a name. `numbers` has the dense numbers: (key, number).
    Rows are summed by key first, in one shuffle, reduced before it.
    """
    parts = parts or {"": F.lit(1)}
    sums = [F.sum(rows.cast("long")).alias(f"_{k}") for k, rows in enumerate(parts.values())]
    each = F.array(
        *(F.struct(F.lit(part).alias("part"), F.col(f"_{k}").alias("total")) for k, part in enumerate(parts))
    )
    per_key = df.groupBy(F.col(key).alias("_key")).agg(*sums).select("_key", F.inline(each)).where("total > 0")
    return labelled_sets(per_key, numbers)


def labelled_sets(per_key: DataFrame, numbers: DataFrame) -> DataFrame:
    """Sets from rows (_key, part, total), each key once a part."""
    key, number = numbers.columns
    known = numbers.select(F.col(key).alias("_key"), F.col(number).alias("_number"))
    joined = per_key.join(known, "_key", "left")
    loose = F.when(F.col("_number").isNull(), F.col("_key").cast("string"))
    placed = joined.select(
        "part",
        F.bitmap_bucket_number("_number").alias("bucket"),
        F.bitmap_bit_position("_number").alias("_bit"),
        loose.alias("loose"),
        "total",
    )
    sets = placed.groupBy("part", "bucket", "loose").agg(
        F.bitmap_construct_agg("_bit").alias("_bits"), F.sum("total").alias("total")
    )
    people = F.when(F.col("bucket").isNotNull(), F.col("_bits"))
    return sets.withColumn("people", people).select(*SET_COLUMNS)


def _sizes() -> Column:
    """People in a row of combined sets."""
    loose = F.col("loose").isNotNull().cast("long")
    return F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("people")).otherwise(loose))


def count_sets(sets: DataFrame, by: list[str]) -> DataFrame:
    """(by, pat_count, total_count): people in the union of a group's sets, and the sum of their rows."""
    merged = sets.groupBy(*by, "bucket", "loose").agg(
        F.bitmap_or_agg("people").alias("people"), F.sum("total").alias("total")
    )
    return merged.groupBy(*by).agg(_sizes().alias("pat_count"), F.sum("total").alias("total_count"))


def count_common(sets: DataFrame, by: list[str], member: str, members: int) -> DataFrame:
    """(by, pat_count): people in all `members` sets of a group, told apart by `member`.

    A bitmap that one of the sets lacks is empty in it.
    """
    single = sets.groupBy(*by, member, "bucket", "loose").agg(F.bitmap_or_agg("people").alias("people"))
    common = single.groupBy(*by, "bucket", "loose").agg(
        F.bitmap_and_agg("people").alias("people"), F.count("*").alias("_members")
    )
    return common.where(F.col("_members") == members).groupBy(*by).agg(_sizes().alias("pat_count"))
