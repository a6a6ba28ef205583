"""Time series and sessions.

A series may hold most of the rows, so it is not left to one task: its rows stand in buckets of time. What a row needs of the rows before it
it finds in its bucket or, for the bucket's first row, in what is carried over one row for each series and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

#: Seconds of a bucket (for a column of numbers, its unit).
WIDTH = 6 * 3600


def bucket(df: DataFrame, time: str, width: int) -> Column:
    """A number that grows with the time; null times have a null one."""
    kind, t = df.schema[time].dataType, F.col(time)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.floor(F.unix_micros(t.cast("timestamp")) / F.lit(width * 1_000_000).cast("decimal(20,0)")).cast("bigint")
    if isinstance(kind, DateType):
        return F.floor(F.unix_date(t) / F.lit(max(width // 86400, 1)).cast("decimal(20,0)")).cast("bigint")
    if isinstance(kind, NumericType):
        return F.floor(t.cast("double") / width).cast("bigint")
    return F.lit(0).cast("bigint")  # no time that is known to be divided


def in_buckets(df: DataFrame, keys: list[str], time: str, width: int = WIDTH) -> DataFrame:
    """Adds __key, a struct of the keys, which is equal where all are equal or null, and __bucket, which null times have to themselves."""
    at = bucket(df, time, width)
    return df.withColumns({"__key": F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys))), "__bucket": F.coalesce(at, F.lit(-(2**62)))})


def previous(samples: DataFrame, series: list[str], time: str, value: str, tiebreak: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """Adds ``__before``, the value of the sample before in its series, and ``__starts``, whether there is none."""
    rows, order = in_buckets(samples, series, time, width), [time, *(tiebreak or [])]
    ends = rows.groupBy("__key", "__bucket").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("__end"))
    carried = ends.select("__key", "__bucket", F.lag("__end").over(Window.partitionBy("__key").orderBy("__bucket")).alias("__carried"))
    inside = Window.partitionBy("__key", "__bucket").orderBy(*order)
    own = rows.withColumn("__own", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    met = own.join(carried, ["__key", "__bucket"])
    last = F.coalesce("__own", "__carried")
    return met.select(*samples.columns, last["v"].alias("__before"), last.isNull().alias("__starts"))


def increases(samples: DataFrame, series: list[str], time: str = "sample_time", value: str = "value", tiebreak: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """Adds ``increase`` since the sample before in its series; after a reset the value itself; null for the first."""
    last = F.col("__before")
    grown = F.when(F.col(value) >= last, F.col(value) - last).when(last.isNotNull(), F.col(value))
    return previous(samples, series, time, value, tiebreak, width).withColumn("increase", grown).drop("__before", "__starts")


def rate(samples: DataFrame, series: list[str], seconds: int = 300, time: str = "sample_time", value: str = "value", tiebreak: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """Adds ``rate``: what a counter gained in the seconds up to a sample, per second.

    A sample stands in its bucket, and as a guest in the next one if it counts there.
    """
    width = max(width, seconds + 1)
    stepped = increases(samples, series, time, value, tiebreak, width).withColumn("__s", F.unix_seconds(F.col(time).cast("timestamp")))
    rows = in_buckets(stepped, series, "__s", width)
    both = F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("guest")), F.struct((F.col("__bucket") + 1).alias("b"), F.lit(True).alias("guest")))
    counts_on = F.floor((F.col("__s") + seconds) / width) > F.col("__bucket")
    spread = rows.withColumn("__at", F.explode(F.when(counts_on, both).otherwise(F.slice(both, 1, 1)))).drop("__bucket")
    up_to = Window.partitionBy("__key", "__at.b").orderBy("__s").rangeBetween(-seconds, 0)
    summed = spread.withColumn("rate", F.sum("increase").over(up_to) / seconds)
    return summed.where(~F.col("__at.guest")).drop("__s", "increase", "__key", "__at")


def changes(samples: DataFrame, series: list[str], time: str = "sample_time", value: str = "value", tiebreak: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """Samples whose value differs from the one before, with that one as ``before``; the first of a series is one too unless it is null."""
    found = previous(samples, series, time, value, tiebreak, width).where(~F.equal_null(F.col("__before"), F.col(value)))
    return found.withColumnRenamed("__before", "before").drop("__starts")


def sessions(events: DataFrame, key: str, time: str, gap: str = "30 minutes") -> DataFrame:
    """(key, session_start, last_event, events): runs of events with less than ``gap`` between neighbours."""
    return (
        events.groupBy(key, F.session_window(time, gap).alias("w"))
        .agg(F.count("*").alias("events"), F.max(time).alias("last_event"))
        .select(key, F.col("w.start").alias("session_start"), "last_event", "events")
    )
