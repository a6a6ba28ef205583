"""States that merge: quantiles and distinct counts of small spans, rolled up to longer ones without the raw rows.

A quantile's state is a KLL sketch, whose rank error depends on its size ``k`` alone and does not grow by merging. A distinct count's state is a bitmap of
whole numbers, which is exact: one row for each 32,768 numbers in a row that the group meets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: at 400 the rank error stays below 1 % with a probability of 99 %.
K = 400
#: Rank error that is stated for K.
ERROR = 0.01


def quantile_states(rows: DataFrame, by: dict[str, Column], value: str, k: int = K) -> DataFrame:
    """(by, rows, least, most, state) of the values by group; groups without a value are left out, as are values that are no numbers."""
    known = rows.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    v = F.col(value).cast("double")
    return known.groupBy(*(c.alias(n) for n, c in by.items())).agg(
        F.count("*").alias("rows"), F.min(v).alias("least"), F.max(v).alias("most"), F.kll_sketch_agg_double(v, F.lit(k)).alias("state")
    )


def merged_quantiles(states: DataFrame, by: dict[str, Column], k: int = K) -> DataFrame:
    """States of larger groups from those of smaller ones."""
    return states.groupBy(*(c.alias(n) for n, c in by.items())).agg(
        F.sum("rows").alias("rows"), F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double("state", F.lit(k)).alias("state")
    )


def quantile(q: float, state: str = "state") -> Column:
    """About the least value that at least the share q of the rows does not exceed; the ends are exact."""
    if not 0 <= q <= 1:
        raise ValueError(f"not a share: {q}")
    return F.col("least") if q == 0 else F.col("most") if q == 1 else F.kll_sketch_get_quantile_double(state, F.lit(q))


def rank_error(rows: DataFrame, estimates: DataFrame, by: dict[str, Column], value: str, estimate: str, q: float) -> DataFrame:
    """``estimates`` (by, estimate, ..) with ``error``: how far the share of rows up to the estimate is from q, over the raw rows; equal values count in its favour."""
    names = list(by)
    given = rows.where(F.col(value).isNotNull()).select(*(c.alias(n) for n, c in by.items()), F.col(value).cast("double").alias("__v"))
    met = given.join(estimates.select(*names, F.col(estimate).alias("__e")), names)
    shares = met.groupBy(*names).agg(F.avg((F.col("__v") < F.col("__e")).cast("double")).alias("__below"), F.avg((F.col("__v") <= F.col("__e")).cast("double")).alias("__upto"))
    return estimates.join(shares, names).withColumn("error", F.greatest(F.lit(0.0), F.col("__below") - q, q - F.col("__upto"))).drop("__below", "__upto")


def distinct_states(rows: DataFrame, by: dict[str, Column], number: str) -> DataFrame:
    """(by, bucket, bits): the whole numbers that a group meets. Nulls are none; groups without a number are left out."""
    known = rows.where(F.col(number).isNotNull())
    keys = [c.alias(n) for n, c in by.items()]
    return known.groupBy(*keys, F.bitmap_bucket_number(F.col(number)).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("bits"))


def merged_distinct(states: DataFrame, by: dict[str, Column]) -> DataFrame:
    return states.groupBy(*(c.alias(n) for n, c in by.items()), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(states: DataFrame, by: list[str], name: str = "distinct") -> DataFrame:
    """(by, name): how many numbers the states hold."""
    return states.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
