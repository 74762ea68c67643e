"""Panel profiles, panel statistics and small-cell masking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def profile(df: DataFrame, group: str, dims: dict[str, str], distinct_on: str) -> DataFrame:
    """Distinct `distinct_on` per group and value of every dimension (label -> column).

    The dimensions are unpivoted in one scan; a missing value is a value.
    """
    named = [F.col(column).cast("string").alias(label) for label, column in dims.items()]
    long = df.select(group, distinct_on, *named).unpivot(
        [group, distinct_on], list(dims), "demo_type", "demo_sub_type"
    )
    return long.groupBy(group, "demo_type", "demo_sub_type").agg(
        F.count_distinct(distinct_on).alias("pat_count")
    )


def panel_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean, interpolated median and mode (smallest of ties) per group.

    Equal values are counted first; no step holds all values of a group.
    """
    counted = df.groupBy(group, value).agg(F.count("*").alias("_n"))
    known = F.col(value).isNotNull()
    weight = F.when(known, F.col("_n"))
    commonest = F.when(known, F.struct(F.col("_n"), -F.col(value)))
    stats = counted.groupBy(group).agg(
        (F.sum(F.col(value) * F.col("_n")) / F.sum(weight)).alias("avg_value"),
        F.max_by(value, commonest).alias("mode_value"),
    )
    median = counted_median(counted.where(known), group, value, "_n")
    return stats.join(median, group, "left").select(
        group, "avg_value", "median_value", "mode_value"
    )


def counted_median(
    counted: DataFrame, group: str, value: str, n: str, slices: int = 64
) -> DataFrame:
    """Exact median per group of distinct values with their counts.

    A group's values are cut at approximate quantiles, so each slice holds about as many of them
    however far outliers lie. Exact slice totals show which slice holds the middle ranks, and only
    values between its bounds are ranked. The quantiles decide where is looked, not what is found.
    """
    shares = [k / slices for k in range(1, slices)]
    cuts = counted.groupBy(group).agg(
        F.percentile_approx(value, shares, 20 * slices).alias("_cuts")
    )
    low = F.array_max(F.filter("_cuts", lambda c: c <= F.col(value)))
    sums = (
        counted.join(cuts, group)
        .withColumn("_low", low)
        .groupBy(group, "_low")
        .agg(F.sum(n).alias("_inside"))
    )
    ordered = Window.partitionBy(group).orderBy(F.asc_nulls_first("_low"))
    total = F.sum("_inside").over(Window.partitionBy(group))
    lower, upper = F.floor((F.col("_total") + 1) / 2), F.floor(F.col("_total") / 2) + 1
    middle = (
        sums.withColumn("_total", total)
        .withColumn("_before", F.sum("_inside").over(ordered) - F.col("_inside"))
        .withColumn("_high", F.lead("_low").over(ordered))
        .where((F.col("_before") < upper) & (F.col("_before") + F.col("_inside") >= lower))
        .drop("_inside")
    )
    at_least = F.col("_low").isNull() | (F.col(value) >= F.col("_low"))
    below = F.col("_high").isNull() | (F.col(value) < F.col("_high"))
    rank = F.sum(n).over(Window.partitionBy(group, "_low").orderBy(value)) + F.col("_before")
    ranked = counted.join(middle, group).where(at_least & below).withColumn("_rank", rank)
    at_lower = F.min(F.when(F.col("_rank") >= lower, F.col(value)))
    at_upper = F.min(F.when(F.col("_rank") >= upper, F.col(value)))
    return ranked.groupBy(group).agg(((at_lower + at_upper) / 2).alias("median_value"))


def mask_small(df: DataFrame, column: str, floor: int = 10) -> DataFrame:
    """Raise counts under `floor` to `floor`."""
    return df.withColumn(column, F.greatest(F.col(column), F.lit(floor)))


def suppress(df: DataFrame, group: list[str], label: str, value: str, floor: int = 10) -> DataFrame:
    """The cells of each group with the small ones hidden so that the group's total does not show them.

    Adds `shown`, the cell or NULL, and `total`, the group's sum or NULL. In a group with a cell
    under `floor`, cells are hidden from the smallest on, until there are two of them or more that
    together reach the floor: the total minus the cells shown then tells neither. Where a group has
    not so many, its total is hidden. A group's cells are ordered in one task, so `label` should be
    a dimension with few values.
    """
    cells = Window.partitionBy(*group)
    before = cells.orderBy(F.asc(value), F.asc_nulls_first(label)).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumns(
        {
            "_small": F.max((F.col(value) < floor).cast("int")).over(cells) == 1,
            "_n": F.count(value).over(before),
            "_sum": F.coalesce(F.sum(value).over(before), F.lit(0)),
            "_all": F.sum(value).over(cells),
        }
    )
    hidden = F.col("_small") & ((F.col(value) < floor) | (F.col("_n") < 2) | (F.col("_sum") < floor))
    rows = rows.withColumn("_hidden", hidden)
    enough = (F.sum(F.col("_hidden").cast("int")).over(cells) >= 2) & (
        F.sum(F.when(F.col("_hidden"), F.col(value))).over(cells) >= floor
    )
    return rows.select(
        *df.columns,
        F.when(~F.col("_hidden"), F.col(value)).alias("shown"),
        F.when(~F.col("_small") | enough, F.col("_all")).alias("total"),
    )
