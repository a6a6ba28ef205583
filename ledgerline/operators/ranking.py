"""Ranks and quantiles of few large groups, without a group in one task.

A window over a group sorts the whole group in one task. Here rows are sorted over all groups in ranges whose bounds Spark draws from a sample of the rows
themselves, so a range holds about as many rows as any other, however the values lie; ties are part of the order, so equal values are parted too. The sorted rows
are written once. A row's place is its place in its range and the rows that its group has in the ranges before, of which one
row for each group and range is counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import written


def ranged(df: DataFrame, group: str, *order: str | Column, ranges: int | None = None) -> DataFrame:
    """The rows sorted by group and then ``order`` in ranges, written, with ``__at``: range and place in it."""
    keys = (F.col(group), *order)
    dealt = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
    return written(dealt.sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()))


def places(df: DataFrame, group: str, value: str, ties: str, descending: bool = False, buckets: int | None = None) -> DataFrame:
    """Adds ``place``, the row number in its group by value and then ``ties``, and ``total``, the group's rows.

    Nulls come first, descending last. ``buckets``: ranges, where not as many as Spark shuffles into.
    """
    rows = ranged(df, group, F.desc(value) if descending else F.asc(value), F.col(ties), ranges=buckets)
    part = F.shiftright("__at", 33)
    runs = rows.groupBy(F.col(group).alias("__g"), part.alias("__range")).agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    in_group = Window.partitionBy("__g")  # one row for each range that holds a part of the group
    before = F.coalesce(F.sum("__n").over(in_group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select("__g", "__range", (before - F.col("__first") + 1).alias("__shift"), F.sum("__n").over(in_group).alias("total"))
    met = rows.join(starts, F.col(group).eqNullSafe(F.col("__g")) & (part == F.col("__range")))
    return met.withColumn("place", F.col("__at") + F.col("__shift")).drop("__g", "__range", "__shift", "__at")


def tile(tiles: int) -> Column:
    """ntile() from ``place`` and ``total``: the first tiles have one row more where they do not come out even."""
    size, more = F.floor(F.col("total") / tiles), F.col("total") % tiles
    large = more * (size + 1)
    return F.when(F.col("place") <= large, F.ceil(F.col("place") / (size + 1))).otherwise(more + F.ceil(F.try_divide(F.col("place") - large, size)))


def value_ranks(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, rank, dense): rank() and dense_rank() of each value, over one row for each; for columns of few values."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("__n"))
    order = Window.partitionBy(group).orderBy(value)
    before = F.coalesce(F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
    return counts.select(group, value, before.cast("bigint").alias("rank"), F.row_number().over(order).cast("bigint").alias("dense"))


def group_quantile(df: DataFrame, group: str, value: str, q: float, name: str, buckets: int | None = None) -> DataFrame:
    """(group, name): the exact quantile with linear interpolation, to 6 places; groups without a value are left out.

    Of the rows in order only the two around the quantile are read on.
    """
    known = df.select(group, F.col(value).cast("double").alias("__v"), F.monotonically_increasing_id().alias("__tie")).where("__v is not null")
    at = q * (F.col("total") - 1)
    low, high, place = F.floor(at), F.ceil(at), F.col("place") - 1
    around = places(known, group, "__v", "__tie", buckets=buckets).where((place == low) | (place == high))
    ends = around.groupBy(group).agg(F.min("__v").alias("__l"), F.max("__v").alias("__h"), F.first(at - low).alias("__part"))
    return ends.select(group, (F.col("__l") + (F.col("__h") - F.col("__l")) * F.col("__part")).cast("decimal(38,6)").cast("double").alias(name))
