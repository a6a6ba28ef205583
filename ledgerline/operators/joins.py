"""Joins that need more than an equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType, TimestampType

from ledgerline.operators.series import WIDTH, in_buckets

#: Intervals of a key up to which they are scanned as one array for each point.
FEW = 64
#: Bits of a step between levels of nodes: 16 nodes make one of the next level.
BITS = 4
#: Microseconds that ends of intervals in time may be multiples of.
UNITS = (60_000_000, 1_000_000, 1_000, 1)


def numbered(rows: list[tuple], columns: str, spark) -> DataFrame:
    """An inline table with the 0-based place of each row as ``place``."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"place int, {columns}")


def first_interval(points: DataFrame, intervals: DataFrame, key: str, at: Column, start: str, end: str, place: str, few: int = FEW) -> DataFrame:
    """Each point with the first interval, by ``place``, of its key that holds it, both ends included; nulls where none does.

    Where no key has more than ``few`` intervals, a key's become one array, which its points scan. Else, for whole numbers and times, see
    by_nodes(). A null key has no interval; an interval with a null end, or that ends before its start, holds nothing. Repeated points stay as often as they are.
    """
    columns = [c for c in intervals.columns if c != key]
    most = intervals.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if most > few:
        return by_nodes(points, intervals, key, at, start, end, place)
    lists = intervals.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(place, *(c for c in columns if c != place)))).alias("__all"))
    joined = points.withColumn("__at", at).join(lists, key, "left")
    hit = F.get(F.filter("__all", lambda x: (x[start] <= F.col("__at")) & (F.col("__at") <= x[end])), F.lit(0))
    out = joined.withColumn("__hit", hit)
    return out.select(*points.columns, *(F.col("__hit")[c].alias(c) for c in columns if c not in points.columns))


def _up(c: Column, level: Column) -> Column:
    return F.call_function("shiftright", c, (level * BITS).cast("int"))


def _cover(low: Column, high: Column, levels: int) -> Column:
    """(level, node) of the largest nodes that together are [low, high): at most 30 for each level."""
    none = F.array().cast("array<bigint>")
    run = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(none)

    def of(level: Column) -> Column:
        ceiling = lambda k: _up(low + F.call_function("shiftleft", F.lit(1).cast("bigint"), (k * BITS).cast("int")) - 1, k)
        a, b, inner_a, inner_b = ceiling(level), _up(high, level), ceiling(level + 1) * 2**BITS, _up(high, level + 1) * 2**BITS
        nodes = F.when(inner_a < inner_b, F.concat(run(a, inner_a), run(inner_b, b))).otherwise(run(a, b))
        return F.transform(nodes, lambda n: F.struct(level.alias("level"), n.alias("node")))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), of))


def by_nodes(points: DataFrame, intervals: DataFrame, key: str, at: Column, start: str, end: str, place: str) -> DataFrame:
    """first_interval() of any number of intervals, without a list of them.

    An interval is cut into nodes of a tree over the numbers, each as large as it can be, and of all intervals that cover a node only the first stays. A point
    asks for the nodes above it, one for each level that there is, and takes the first of at most as many intervals. So
    work grows with points and intervals times the logarithm of the longest, however many intervals hold a point. Times are counted in the
    largest unit that all ends are multiples of; a point between two of its multiples stands between their numbers.
    """
    columns = [c for c in intervals.columns if c != key]
    asked = points.withColumn("__at", at)
    kind = asked.schema["__at"].dataType
    known = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull() & F.col(key).isNotNull() & (F.col(start) <= F.col(end)))
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        micros = lambda c: F.unix_micros(c.cast("timestamp"))
        whole = known.agg(*(F.bool_and((micros(F.col(start)) % u == 0) & (micros(F.col(end)) % u == 0)) for u in UNITS)).first()
        unit = next((u for u, fits in zip(UNITS, whole) if fits), 1)
        number = lambda c: F.floor(micros(c) / F.lit(unit).cast("decimal(20,0)")).cast("bigint") * 2 + (micros(c) % unit != 0).cast("bigint")
    elif isinstance(kind, IntegralType):
        number = lambda c: c.cast("bigint")
    else:
        raise ValueError(f"intervals of {kind.simpleString()} are not divided: whole numbers or times")
    ranged = known.withColumns({"__low": number(F.col(start)), "__high": number(F.col(end)) + 1})
    longest = ranged.agg(F.max(F.col("__high") - F.col("__low"))).first()[0] or 1
    levels = (int(longest).bit_length() + BITS - 1) // BITS
    nodes = ranged.withColumn("__n", F.explode(_cover(F.col("__low"), F.col("__high"), levels)))
    best = nodes.groupBy(F.col(key).alias("__key"), F.col("__n.level").alias("__level"), F.col("__n.node").alias("__node")).agg(
        F.min(F.struct(place, *(c for c in columns if c != place))).alias("__best")
    )
    # A point's columns go with its first question only.
    narrow = asked.select(F.monotonically_increasing_id().alias("__id"), F.col(key).alias("__key"), number(F.col("__at")).alias("__x"), F.struct(*points.columns).alias("__row"))
    questions = narrow.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(levels)))).withColumn("__node", _up(F.col("__x"), F.col("__level")))
    questions = questions.withColumn("__row", F.when(F.col("__level") == 0, F.col("__row"))).drop("__x")
    met = questions.join(best, ["__key", "__level", "__node"], "left").groupBy("__id").agg(F.first("__row", ignorenulls=True).alias("__row"), F.min("__best").alias("__best"))
    return met.select("__row.*", *(F.col("__best")[c].alias(c) for c in columns if c not in points.columns))


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, values: list[str], width: int = WIDTH) -> DataFrame:
    """Each left row with the values of the last right row of its key at or before its time.

    Both sides are laid in one order by key and time, in place of a range join, and values are carried forward inside buckets of ``width`` seconds;
    over one row for each key and bucket the last value goes on to the buckets after it. So the rows of one key are shared by as many tasks
    as it has buckets. Null keys are one key, a null time has no row before it; of right rows of one time that with the greatest values counts.
    """
    kind = right.select(F.struct(*values).alias("v")).schema["v"].dataType
    sides = left.withColumns({"__side": F.lit(1), "__value": F.lit(None).cast(kind)})
    other = right.where(F.col(time).isNotNull()).select(
        *(F.col(c) if c in (key, time) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns),
        F.lit(0).alias("__side"),
        F.struct(*values).alias("__value"),
    )
    rows = in_buckets(sides.unionByName(other), [key], time, width)
    given = F.struct(time, F.struct(*(F.col("__value")[v] for v in values))) if values else F.struct(time)
    ends = rows.where("__side = 0").groupBy("__key", "__bucket").agg(F.max_by("__value", given).alias("__end"))
    every = rows.groupBy("__key", "__bucket").agg(F.lit(0)).select("__key", "__bucket").join(ends, ["__key", "__bucket"], "left")
    buckets = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("__key", "__bucket", F.last("__end", ignorenulls=True).over(buckets).alias("__before"))
    inside = Window.partitionBy("__key", "__bucket").orderBy(time, "__side", "__value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = rows.withColumn("__last", F.last("__value", ignorenulls=True).over(inside)).where("__side = 1").join(carried, ["__key", "__bucket"], "left")
    found = F.coalesce("__last", "__before")
    return last.select(*left.columns, *(found[v].alias(v) for v in values))
