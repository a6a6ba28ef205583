"""Mergeable states, the vector index, variants, table functions, and stateful streams, over odd input and against brute force."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import sketches, tables, vector_index
from ledgerline.sources import metrics, variants
from ledgerline.streaming import stateful
from ledgerline.streaming.ledger import Ledger


def test_quantiles_of_merged_states_keep_their_rank_error(spark):
    """200,000 values of a heavy tail in 500 states: merged, they answer as one sketch would, and the error is measured."""
    rows = spark.range(200_000).select(F.lit("a").alias("g"), (F.col("id") % 500).alias("part"), F.exp(F.randn(3) * 2).alias("v"))
    states = sketches.quantile_states(rows, {"g": F.col("g"), "part": F.col("part")}, "v")
    merged = sketches.merged_quantiles(states, {"g": F.col("g")})
    for q in (0.01, 0.5, 0.95, 0.999):
        found = sketches.rank_error(rows, merged.withColumn("e", sketches.quantile(q)), {"g": F.col("g")}, "v", "e", q).first()
        assert found.rows == 200_000 and found.error <= sketches.ERROR
    ends = merged.select(sketches.quantile(0).alias("low"), sketches.quantile(1).alias("high")).first()
    assert (ends.low, ends.high) == rows.agg(F.min("v"), F.max("v")).first()[:]


def test_quantile_states_of_odd_values(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), (None, 2.0), ("b", None), ("c", 5.0), ("c", 5.0)], "g string, v double")
    got = {r.g: (r.rows, r.p) for r in sketches.quantile_states(rows, {"g": F.col("g")}, "v").withColumn("p", sketches.quantile(0.5)).collect()}
    assert got == {"a": (1, 1.0), None: (1, 2.0), "c": (2, 5.0)}
    assert sketches.quantile_states(rows.limit(0), {"g": F.col("g")}, "v").count() == 0
    with pytest.raises(ValueError):
        sketches.quantile(1.5)


def test_distinct_counts_of_merged_states(spark):
    rng = random.Random(1)
    made = [(rng.choice("ab"), rng.randrange(20), rng.choice([rng.randrange(100), rng.randrange(-(10**6), 10**6), rng.randrange(10**12), None])) for _ in range(3000)]
    rows = spark.createDataFrame([*made, ("none", 1, None)], "g string, hour int, n long")
    states = sketches.distinct_states(rows, {"g": F.col("g"), "hour": F.col("hour")}, "n")
    days = sketches.merged_distinct(states, {"g": F.col("g")})
    got = {r.g: r.users for r in sketches.distinct_counts(days, ["g"], "users").collect()}
    assert got == {g: len({n for k, _, n in made if k == g and n is not None}) for g in "ab"}
    by_hour = {(r.g, r.hour): r["distinct"] for r in sketches.distinct_counts(states, ["g", "hour"]).collect()}
    assert by_hour == {(g, h): len({n for k, x, n in made if (k, x) == (g, h) and n is not None}) for g, h in {(g, h) for g, h, n in made if n is not None}}


def vectors(spark, n=600, seed=0):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(12, 8)) * 3
    made = [(i, (middles[i % 12] + rng.normal(size=8)).tolist()) for i in range(n)]
    made += [(n + i, made[0][1]) for i in range(5)] + [(n + 5, [0.0] * 8), (n + 6, None)]
    return made, spark.createDataFrame(made, "k long, v array<double>")


def brute(made, asked, k):
    known = [(i, np.array(v)) for i, v in made if v is not None]
    size = lambda v: np.linalg.norm(v) or 1.0
    out = set()
    for q, v in asked:
        best = sorted((-round(float(v / size(v) @ (w / size(w))), 4), i) for i, w in known)[:k]
        out |= {(q, i, -s + 0.0, place) for place, (s, i) in enumerate(best, 1)}
    return out


def test_exact_search_equals_brute_force(spark, monkeypatch):
    """Equal vectors go by id, zeros are like nothing, rows without a vector are left out; lists in one part or in many."""
    made, df = vectors(spark)
    asked = [(i, np.array(v)) for i, v in made if v is not None and i % 50 == 0]
    for part in (vector_index.PART, 7):
        monkeypatch.setattr(vector_index, "PART", part)
        index = vector_index.VectorIndex(df, "k", "v", 10)
        assert (index.parts > 1) == (part == 7)
        got = {(r["query"], r.id, r.similarity, r.place) for r in index.search(df.where("k % 50 = 0"), "k", "v", 7, probes=None).collect()}
        assert got == brute(made, asked, 7)


def test_recall_of_the_nearest_lists(spark):
    _, df = vectors(spark)
    index = vector_index.VectorIndex(df, "k", "v", 12)
    asked = df.where("k % 7 = 0")
    exact = index.search(asked, "k", "v", 10, probes=None)
    probes = index.probes_for(asked, "k", "v", 10, 0.95)
    assert probes < 12 and vector_index.recall(index.search(asked, "k", "v", 10, probes), exact) >= 0.9
    assert vector_index.recall(exact, exact) == 1.0 and index.search(asked, "k", "v", 10, 1).where("place = 1").count() == asked.where("v is not null").count()


def test_index_of_nothing_and_of_one(spark):
    _, df = vectors(spark)
    empty = vector_index.VectorIndex(df.limit(0), "k", "v")
    assert empty.search(df, "k", "v").count() == 0 and empty.probes_for(df, "k", "v") == 0
    one = vector_index.VectorIndex(df.where("k = 3"), "k", "v")
    assert [(r["query"], r.id) for r in one.search(df.where("k < 2"), "k", "v").orderBy("query").collect()] == [(0, 3), (1, 3)]
    assert one.search(df.limit(0), "k", "v").count() == 0


def test_documents_as_variants(spark, tmp_path):
    texts = ['{"service":{"name":"s"},"http":{"status_code":500,"latency_ms":"12"},"deep":{"a":[1,{"b":2}]}}', '{"service":"flat","log":{"level":7}}', "[]", "null", "no json", "", None, '{"http":{"status_code":"x"}}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, document_json string")
    variants.parsed(rows).write.parquet(str(tmp_path / "v"))
    got = {r.id: r for r in spark.read.parquet(str(tmp_path / "v")).withColumns({"b": variants.field("$.deep.a[1].b", "int"), "j": F.col("document").cast("string")}).drop("document").collect()}
    assert (got[0].service, got[0].status_code, got[0].latency_ms, got[0].b, got[0].document_text) == ("s", 500, 12, 2, None)
    assert (got[1].service, got[1].level, got[7].status_code) == (None, "7", None)
    assert [got[i].document_text for i in (4, 5, 6)] == ["no json", "", None] and got[4].j is None
    assert len(got) == len(texts)
    shapes = variants.shapes(variants.parsed(spark.createDataFrame([("a", '{"x":1}'), ("a", '{"x":2.5,"y":"z"}'), ("b", "[1]")], "k string, document_json string")), "k")
    assert {r.k: r.schema for r in shapes.collect()}["b"].startswith("ARRAY")


def test_plan_of_variants_parses_once(spark):
    rows = spark.createDataFrame([(1, '{"a":1}')], "id int, document_json string").cache()
    plan = variants.parsed(rows).select("service", "level", "city")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") <= 1
    rows.unpersist()


def test_first_rows_of_each(spark):
    outer = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, name string")
    inner = spark.createDataFrame([(1, 5), (1, 7), (1, 6), (2, 1), (None, 9)], "of int, v int")
    got = tables.first_of_each(outer, inner, {"k": "of"}, [F.desc("v")], 2).select("name", "v").collect()
    assert sorted(map(tuple, got)) == [("a", 6), ("a", 6), ("a", 7), ("a", 7), ("b", 1)]


def test_payloads_by_table_function(spark):
    series = spark.createDataFrame([("r1", 1, {"a": "x"}, [(5, 1.5), (6, 2.5)]), ("r1", 2, {"a": "y"}, [(7, 3.5)]), ("r2", 1, {"a": "z"}, [(8, 4.5)])], "receiver string, number long, labels map<string,string>, samples array<struct<timestamp:long,value:double>>")
    payloads = metrics.write_payloads(series, "receiver", "number")
    again = payloads.unionByName(payloads.where("receiver = 'r1'")).unionByName(spark.createDataFrame([("r3", 1, None)], payloads.schema))
    got = tables.decoded(spark, again).collect()
    assert sorted((r.receiver, r.number, r.labels["a"], r.timestamp, r.value) for r in got) == [("r1", 1, "x", 5, 1.5), ("r1", 1, "x", 6, 2.5), ("r1", 2, "y", 7, 3.5), ("r2", 1, "z", 8, 4.5)]


def batch_sessions(rows, gap):
    out = []
    for key in {k for _, k, _ in rows}:
        times = sorted(t for _, k, t in rows if k == key)
        runs = [[times[0]]]
        for t in times[1:]:
            runs[-1].append(t) if t < runs[-1][-1] + gap else runs.append([t])
        out += [(key, r[0], r[-1], len(r)) for r in runs]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions_of_rows_out_of_order(spark, tmp_path, seed):
    """Rows come shuffled within the lateness and some far too late, over several restarts: sessions and late rows are all rows."""
    rng, base, gap = random.Random(seed), datetime(2024, 1, 1), timedelta(seconds=60)
    rows = [(i, rng.choice(["a", "b", "c"]), base + timedelta(seconds=rng.randrange(0, 6000), microseconds=rng.randrange(10**6))) for i in range(240)]
    order = sorted(rows, key=lambda r: r[2] + timedelta(seconds=rng.choice([0, 0, 50, 200, 2500])))
    parts = [order[k : k + 60] for k in range(0, 240, 60)] + [[(999, "end", base + timedelta(days=9))]]
    folder, checkpoint, book = str(tmp_path / "in"), str(tmp_path / "checkpoint"), Ledger(spark, str(tmp_path / "out"), "s")
    late, top = [], None
    for part in parts:
        spark.createDataFrame(part, "id long, k string, t timestamp").coalesce(1).write.mode("append").parquet(folder)
        stream = stateful.stream_sessions(spark.readStream.schema("id long, k string, t timestamp").parquet(folder), "k", "t", "id", 60, "5 minutes")
        stream.writeStream.outputMode("append").foreachBatch(book.append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
        if top is not None:
            mark = top.replace(microsecond=top.microsecond // 1000 * 1000) - timedelta(minutes=5)
            late += [r for r in part if r[2] < mark]
        top = max([r[2] for r in part] + ([top] if top else []))
    found = book.table(stream.schema).where("key <> 'end'").collect()
    assert sorted(r.id for r in found if r.kind == "late") == sorted(r[0] for r in late) and late
    sessions = sorted(((r.key, r.session_start, r.last_event, r.events) for r in found if r.kind == "session"), key=str)
    assert sessions == batch_sessions([r for r in rows if r not in late], gap)
    assert sum(s[3] for s in sessions) + len(late) == 240
