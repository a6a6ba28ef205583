"""Series, as-of and interval joins whose rows share one key: equal to plain windows and brute force, and spread over many tasks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import joins, series

BASE = datetime(2024, 1, 1)


def samples(spark, kind, rows=3000):
    """One series with most rows, some small ones, null keys, values and times, and repeated times told apart by an id."""
    rng = random.Random(4)
    made = [(i, "hot" if i % 5 else rng.choice(["a", None, "b"]), rng.choice(["x", None]) if i % 10 == 0 else "x", None if i % 97 == 0 else rng.randrange(0, 400_000), None if i % 53 == 0 else float(rng.randint(0, 9))) for i in range(rows)]
    df = spark.createDataFrame(made, "id long, k string, l string, s long, v double").repartition(5)
    at = {"timestamp": F.timestamp_seconds("s"), "ntz": F.timestamp_seconds("s").cast("timestamp_ntz"), "long": F.col("s"), "text": F.timestamp_seconds("s").cast("string")}[kind]
    return df.withColumn("t", at).drop("s")


@pytest.mark.parametrize("kind", ["timestamp", "ntz", "long", "text"])
def test_increases_and_changes_equal_windows(spark, kind):
    df = samples(spark, kind)
    lag = F.lag("v").over(Window.partitionBy("k", "l").orderBy("t", "id"))
    want = df.select("id", F.when(F.col("v") >= lag, F.col("v") - lag).when(lag.isNotNull(), F.col("v")).alias("increase"))
    got = series.increases(df, ["k", "l"], "t", "v", ["id"], width=1800)
    assert got.columns == [*df.columns, "increase"]
    assert sorted(map(tuple, got.select("id", "increase").collect())) == sorted(map(tuple, want.collect()))
    moved = df.withColumn("before", lag).where(~F.equal_null("before", "v")).select("id", "before")
    assert sorted(map(tuple, series.changes(df, ["k", "l"], "t", "v", ["id"], 1800).select("id", "before").collect())) == sorted(map(tuple, moved.collect()))


@pytest.mark.parametrize("seconds", [1, 300, 7200])
def test_rates_equal_windows(spark, seconds):
    df = samples(spark, "timestamp").where("t is not null")
    lag = F.lag("v").over(Window.partitionBy("k", "l").orderBy("t", "id"))
    grown = F.when(F.col("v") >= lag, F.col("v") - lag).when(lag.isNotNull(), F.col("v"))
    up_to = Window.partitionBy("k", "l").orderBy(F.unix_seconds("t")).rangeBetween(-seconds, 0)
    want = df.withColumn("g", grown).select("id", (F.sum("g").over(up_to) / seconds).alias("rate"))
    got = series.rate(df, ["k", "l"], seconds, "t", "v", ["id"], width=1800)
    assert got.columns == [*df.columns, "rate"]
    rounded = lambda rows: sorted((r.id, None if r.rate is None else round(r.rate, 9)) for r in rows)
    assert rounded(got.collect()) == rounded(want.collect())


@pytest.mark.parametrize("kind", ["timestamp", "ntz", "long"])
def test_as_of_equals_brute_force(spark, kind):
    df = samples(spark, kind, 1200)
    left, right = df.where("id % 3 = 0").select("id", "k", "t"), df.where("id % 3 > 0").select("k", "t", F.col("v").alias("seen"), F.col("id").alias("by"))
    rows = [r for r in right.collect() if r.t is not None]
    got = joins.as_of(left, right, "k", "t", ["seen", "by"], width=1800)
    assert got.columns == ["id", "k", "t", "seen", "by"]
    found = {r.id: (r.seen, r.by) for r in got.where("t is not null").collect()}
    for r in left.where("t is not null").collect():
        before = [(x.t, x.seen is not None, x.seen, x.by) for x in rows if x.k == r.k and x.t <= r.t]
        assert found[r.id] == (max(before, key=lambda b: (b[0], b[1], b[2] or 0, b[3]))[2:] if before else (None, None))
    assert got.count() == left.count()


def largest_task(df):
    """The most rows that one task of the last shuffle reads."""
    return max(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())


def test_one_key_is_shared_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(40_000).select("id", F.lit("one").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("t"), (F.col("id") % 100).cast("double").alias("v"))
        assert largest_task(series.increases(df, ["k"], "t", "v", width=3600)) < 10_000
        assert largest_task(series.rate(df, ["k"], 300, "t", "v", width=3600)) < 10_000
        assert largest_task(joins.as_of(df.select("id", "k", "t"), df.select("k", "t", "v"), "k", "t", ["v"], width=3600)) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def brute_first(points, intervals):
    out = []
    for p in points:
        held = [i for i in intervals if p[1] is not None and i[0] == p[1] and None not in (i[2], i[3], p[2]) and i[2] <= p[2] <= i[3]]
        out.append((p[0], min(held, key=lambda i: i[1])[4] if held else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["long", "timestamp", "ntz", "micros"])
def test_many_intervals_of_one_key(spark, kind):
    """Intervals of all lengths, equal and nested ones, empty ones and nulls; both ways of joining agree with brute force."""
    rng = random.Random(9)
    intervals = []
    for i in range(400):
        low = rng.randint(-50, 5000)
        high = low + rng.choice([0, 0, 1, 2, 15, 16, 17, 200, 3000, -1])
        intervals.append((rng.choice(["hot", "hot", "hot", "b", None]), i, None if i % 41 == 0 else low, None if i % 43 == 0 else high, f"n{i}"))
    intervals += [("hot", 1000 + i, 100, 300, f"same{i}") for i in range(50)]
    points = [(i, rng.choice(["hot", "hot", "b", "none", None]), None if i % 29 == 0 else rng.randint(-60, 9000)) for i in range(600)] + [(5, "hot", 150)] * 3
    scale = {"long": None, "timestamp": 60, "ntz": 1, "micros": None}[kind]
    p = spark.createDataFrame(points, "id long, k string, x long")
    r = spark.createDataFrame(intervals, "k string, place int, low long, high long, name string")
    if kind != "long":
        of = (lambda c: F.timestamp_micros(F.col(c) * 7)) if kind == "micros" else (lambda c: F.timestamp_seconds(F.col(c) * scale))
        cast = (lambda c: c.cast("timestamp_ntz")) if kind == "ntz" else (lambda c: c)
        p, r = p.withColumn("x", cast(of("x"))), r.withColumns({c: cast(of(c)) for c in ("low", "high")})
    want = brute_first(points, intervals)
    for few in (0, 10**6):
        got = joins.first_interval(p, r, "k", F.col("x"), "low", "high", "place", few=few)
        assert set(got.columns) == {"id", "k", "x", "place", "low", "high", "name"}
        assert sorted(((g.id, g.name) for g in got.collect()), key=str) == want
    assert joins.first_interval(p.limit(0), r, "k", F.col("x"), "low", "high", "place", few=0).count() == 0
    assert joins.first_interval(p, r.limit(0), "k", F.col("x"), "low", "high", "place").where("name is not null").count() == 0


def test_times_between_the_ends_of_intervals(spark):
    """Ends are whole minutes, points are not: an end holds its own instant only."""
    r = spark.createDataFrame([("k", 0, BASE, BASE + timedelta(minutes=1), "first"), ("k", 1, BASE + timedelta(minutes=1), BASE + timedelta(minutes=2), "second")], "k string, place int, low timestamp, high timestamp, name string")
    moments = [timedelta(), timedelta(seconds=59, microseconds=999_999), timedelta(minutes=1), timedelta(minutes=1, microseconds=1), timedelta(minutes=2), timedelta(minutes=2, microseconds=1), timedelta(microseconds=-1)]
    p = spark.createDataFrame([(i, "k", BASE + m) for i, m in enumerate(moments)], "id int, k string, x timestamp")
    got = joins.first_interval(p, r, "k", F.col("x"), "low", "high", "place", few=0)
    assert [g.name for g in got.orderBy("id").collect()] == ["first", "first", "first", "second", "second", None, None]


def test_intervals_that_all_hold_all_points_make_no_pairs(spark):
    """100,000 intervals of one key over 10,000 points: 10^9 pairs, of which none is made."""
    r = spark.range(100_000).select(F.lit("k").alias("k"), (F.lit(100_000) - F.col("id")).cast("int").alias("place"), F.col("id").alias("low"), (F.lit(2_000_000) + F.col("id")).alias("high"))
    p = spark.range(10_000).select("id", F.lit("k").alias("k"), (F.col("id") * 10).alias("x"))
    got = joins.first_interval(p, r, "k", F.col("x"), "low", "high", "place")
    assert got.where("place <> 100000 - x").count() == 0 and got.count() == 10_000
