"""Arguments and column expressions."""

import datetime
import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import arguments as a
from ledgerline.functions import expressions as x


@pytest.mark.parametrize("value, out", [(None, 50), (0, 50), (-3, 50), ("abc", 50), (10**9, 500), ("7", 7), (float("inf"), 50), ([], 50)])
def test_limits_are_bounded(value, out):
    assert a.bounded_limit(value) == out


def test_names():
    assert a.slug("Привет, мир!") == "privet_mir"
    assert a.slug("9 lives", "query_") == "query_9_lives"
    assert a.slug("a__b") == "a_b"
    assert len(a.slug("x" * 200)) == 80
    assert a.program_name("query_cars") == "query_cars"
    for bad in ("cars", "../etc", "", None):
        with pytest.raises(ValueError):
            a.program_name(bad)
    for bad in ("a b", "1a", "a;b", "", None):
        with pytest.raises(ValueError):
            a.safe_identifier(bad)


def test_comparisons_and_table_arguments():
    assert [a.comparison(s) for s in ("eq", "=", "GTE", " lt ")] == ["=", "=", ">=", "<"]
    with pytest.raises(ValueError):
        a.comparison("like")
    assert a.table_argument({"table_name": "t"}) == "t"
    with pytest.raises(ValueError):
        a.table_argument({})


@given(st.text())
def test_titles_hold_plain_characters(text):
    assert len(a.title(text, "x")) <= 90 and "<" not in a.title(text, "x")


def test_times(spark):
    rows = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.123456+02:00", "2024-01-02 03:04:05", "1704164645", "1704164645.5", "garbage", "", None]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select(x.iso_millis(x.best_effort_time(F.col("t")))).collect()
    assert [r[0] for r in got] == [
        "2024-01-02T03:04:05.000Z", "2024-01-02T01:04:05.123Z", "2024-01-02T03:04:05.000Z", "2024-01-02T03:04:05.000Z", "2024-01-02T03:04:05.500Z", None, None, None,
    ]


def test_canonical_labels_equal_sorted_compact_json(spark):
    maps = [{"b": "1", "a": 'q"\\/'}, {"a": 'q"\\/', "b": "1"}, {"é": "ü\n\t", "A": "\x01"}, {}]
    got = spark.createDataFrame([(m,) for m in maps], "m map<string,string>").select(x.canonical_labels(F.col("m")).alias("j"), x.fingerprint(x.canonical_labels(F.col("m"))).alias("f")).collect()
    assert [r.j for r in got] == [json.dumps(m, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for m in maps]
    assert got[0].f == got[1].f and len(got[0].f) == 64


def test_means_ratios_and_sizes(spark):
    df = spark.createDataFrame([("a", 1.005, 3), ("a", 1.015, 0), ("b", None, 0)], "k string, v double, n int")
    rows = {r.k: r for r in df.groupBy("k").agg(x.exact_mean(F.col("v")).alias("m"), x.share(F.sum("n"), F.count("v")).alias("s"), x.p95(F.col("v")).alias("p")).collect()}
    assert rows["a"].m == 1.01 and rows["a"].s == 1.5 and rows["a"].p == 1.0145
    assert rows["b"].m is None and rows["b"].s is None and rows["b"].p is None
    sizes = spark.createDataFrame([(0,), (1023,), (1024,), (5 * 1024**3,)], "b long").select(x.readable_size(F.col("b"))).collect()
    assert [r[0] for r in sizes] == ["0.00 B", "1023.00 B", "1.00 KiB", "5.00 GiB"]


def test_latest_value_skips_nulls_and_breaks_ties(spark):
    rows = [("a", 1, 1, 5.0), ("a", 2, 1, None), ("a", 1, 2, 6.0), ("b", 1, 1, None)]
    df = spark.createDataFrame(rows, "k string, t int, i int, v double")
    got = dict(df.groupBy("k").agg(x.latest_value(F.col("v"), F.col("t"), F.col("i"))).collect())
    assert got == {"a": 6.0, "b": None}


def test_text_hash(spark):
    def slow(text):
        h = 0
        for c in text:
            h = (h * 31 + ord(c)) % 2**32
        return 2**32 - h if h >= 2**31 else h

    words = ["", "a", "payment-service", "db-mysql-billing:lag", "x" * 40]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(x.text_hash(F.col("w"))).collect()
    assert [r[0] for r in got] == [slow(w) for w in words]


def test_json_values(spark):
    doc = '{"@timestamp":"t","n":5,"s":"x","o":{"c":1}}'
    got = spark.createDataFrame([(doc,), ("broken",)], "d string").select(
        x.json_text(F.col("d"), "$.s"), x.json_text(F.col("d"), "$.none"), x.json_int(F.col("d"), "$.n"), x.json_int(F.col("d"), "$.s"), x.json_text(F.col("d"), "$['@timestamp']")
    ).collect()
    assert [tuple(r) for r in got] == [("x", "", 5, 0, "t"), ("", "", 0, 0, "")]


def test_month(spark):
    assert spark.createDataFrame([(datetime.datetime(2024, 3, 1),)], "t timestamp").select(x.month(F.col("t"))).first()[0] == "202403"
