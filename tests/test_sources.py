"""Decoding, documents, changes, files and sinks."""

import random
import json
import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.schemas import SAMPLES, TABLES, table_from_source
from ledgerline.sources import changes, documents, files, generators, metrics, sinks


def number(n):
    out = b""
    while n > 127:
        out += bytes([n % 128 + 128])
        n //= 128
    return out + bytes([n])


def message(tag, body):
    return number(tag << 3 | 2) + number(len(body)) + body


def payload(series):
    """A write request of (labels, [(milliseconds, value)])."""
    out = b""
    for labels, samples in series:
        body = b"".join(message(1, message(1, k.encode()) + message(2, v.encode())) for k, v in labels.items())
        body += b"".join(message(2, b"\x09" + struct.pack("<d", v) + b"\x10" + number(t % 2**64)) for t, v in samples)
        out += message(1, body + message(9, b"unknown"))
    return out


def packed(data):
    return number(len(data)) + pa.compress(data, codec="snappy", asbytes=True)[len(number(len(data))) :] if data else b""


labels = st.dictionaries(st.text("abc_é", min_size=1, max_size=5), st.text(max_size=8), max_size=4)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(labels, st.lists(st.tuples(st.integers(-(2**40), 2**40), st.floats(allow_nan=False)), max_size=4)), max_size=4))
def test_decoding_gives_back_what_was_encoded(series):
    rows = [(k, t, v) for k, samples in series for t, v in samples]
    assert list(metrics.write_request(metrics.uncompressed(pa.compress(payload(series), codec="snappy", asbytes=True) if series else b""))) == rows


def test_broken_payloads_raise():
    good = pa.compress(payload([({"__name__": "up"}, [(1, 2.0)])]), codec="snappy", asbytes=True)
    for bad in (good[:-3], b"\xff" * 12, number(5) + b"\x00"):
        with pytest.raises(ValueError):
            list(metrics.write_request(metrics.uncompressed(bad)))
    with pytest.raises(ValueError):
        list(metrics.fields(b"\x0b"))
    assert list(metrics.write_request(metrics.uncompressed(b""))) == []


def test_pushed_payloads_become_rows(spark, tmp_path):
    body = payload([({"__name__": "up", "job": "x"}, [(1500, 1.0), (2500, float("nan"))]), ({"job": "y"}, [(0, 3.0)])])
    (tmp_path / "one.bin").write_bytes(pa.compress(body, codec="snappy", asbytes=True))
    rows = metrics.sample_rows(metrics.pushed_series(metrics.landed_payloads(spark, str(tmp_path)))).orderBy("sample_time").collect()
    assert [r.metric_name for r in rows] == ["unknown_metric", "up", "up"]
    assert rows[1].labels_json == '{"__name__":"up","job":"x"}' and rows[1].sample_time.microsecond == 500000


def test_range_queries(spark):
    body = {"status": "success", "data": {"result": [{"metric": {"job": "a"}, "values": [[10, "1.5"], [20.5, "NaN"]]}, {"metric": {"__name__": "n"}, "values": []}]}}
    df = spark.createDataFrame([("rate(x)", json.dumps(body))], "query string, body string")
    rows = metrics.range_rows(df).orderBy("sample_time").collect()
    assert [(r.metric_name, r.ingest_mode) for r in rows] == [("rate(x)", "backfill")] * 2 and rows[0].value == 1.5
    assert metrics.backfill_details(df).first()["inserted"] == 2
    with pytest.raises(PySparkException):
        metrics.range_rows(spark.createDataFrame([("q", '{"status":"error"}')], "query string, body string")).collect()


def test_debug_input_is_off_unless_allowed(spark):
    body = '{"timeseries":[{"labels":{"__name__":"m"},"samples":[{"timestamp":1000,"value":"2"}]}]}'
    with pytest.raises(PermissionError):
        metrics.debug_rows(spark, body)
    assert metrics.debug_rows(spark, body, True).first()["ingest_mode"] == "debug_json"


def test_exposition_text(spark):
    lines = ["# HELP x y", 'x{a="q\\"\\\\",b="2"} 1.5 100', "y 2 50.5", "broken{", "# EOF"]
    rows = metrics.exposition_rows(spark.createDataFrame([(v,) for v in lines], "value string")).orderBy("metric_name").collect()
    assert [(r.metric_name, r.value) for r in rows] == [("x", 1.5), ("y", 2.0)]
    assert json.loads(rows[0].labels_json) == {"__name__": "x", "a": 'q"\\', "b": "2"}


def test_bulk_documents_and_ranges(spark, tmp_path):
    made = generators.log_documents(spark, 720)
    hits = made.collect()
    assert [len([h for h in hits if h._index.endswith(d)]) for d in ("05.21", "05.22", "05.23", "05.24")] == [120, 240, 240, 120]
    with open(tmp_path / "x.bulk.ndjson", "w") as f:
        for h in hits[:50]:
            f.write('{"index":{"_index":"%s","_id":"%s"}}\n%s\n' % (h._index, h._id, h._source))
    read = documents.bulk_hits(spark, str(tmp_path))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, hits[:50]))
    rows = documents.hit_rows(read, "lab", 7)
    first = min(json.loads(h._source)["@timestamp"] for h in hits[:50])
    assert documents.range_scan(rows, first, "2026-05-21 12:06:00", "nginx-*").count() == 1  # start in, end out
    assert documents.range_scan(rows, first, "2030-01-01", "other-*").count() == 0


def test_missing_and_nested_time_fields_fall_back(spark):
    df = spark.createDataFrame([('{"a":{"b":"2020-01-01T00:00:00Z"}}',), ('{"a.b":"2020-01-01T00:00:00Z"}',)], "d string")
    other = F.lit("1999-01-01").cast("timestamp")
    assert [r[0].year for r in df.select(documents.document_time(F.col("d"), "a.b", other)).collect()] == [1999, 2020]


def test_changes(spark):
    rows = [("c", None, '{"id":1,"v":"a"}', 1), ("u", '{"id":1,"v":"a"}', '{"id":1,"v":"b"}', 2), ("d", '{"id":2,"v":"z"}', None, 3), (None, None, None, 4)]
    df = spark.createDataFrame(rows, "op string, before string, after string, lsn long")
    schema = table_from_source([("id", "bigint", False), ("v", "uuid", True)])
    flat = changes.flat_rows(df, schema).orderBy("__order").collect()
    assert [(r.id, r.v, r["__deleted"]) for r in flat] == [(1, "a", "false"), (1, "b", "false"), (2, "z", "true")]
    routes = changes.topic_map("a.b = t, c=u")
    assert routes == {"a.b": "t", "c": "u"}
    with pytest.raises(ValueError):
        changes.topic_map("a.b")
    with pytest.raises(PySparkException):
        changes.routed(spark.createDataFrame([("other",)], "topic string"), routes)["t"].collect()
    assert changes.ChangeSource("mysql", "/x", ("db.cars",)).routes() == {"mysql.db.cars": "cars"}
    with pytest.raises(ValueError):
        changes.ChangeSource("oracle", "/x", ("t",))
    with pytest.raises(ValueError):
        changes.ChangeSource("mysql", "", ())


def test_folder_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for name in ("a.md", "sub/b.TXT", "sub/.hidden.md", "c.exe"):
        (tmp_path / "in" / name).write_text(name)
    got = {r.path: r.supported for r in files.folder_files(spark, str(tmp_path / "in")).collect()}
    assert got == {"a.md": True, "sub/b.TXT": True, "c.exe": False}


def test_sinks(spark, tmp_path):
    table = TABLES["prometheus_samples"]
    made = generators.service_metrics(spark, 2).select(F.unix_millis("sample_time").alias("timestamp"), F.map_concat("labels", F.create_map(F.lit("__name__"), "metric_name")).alias("labels"), "value")
    rows = metrics.sample_rows(made)
    path = str(tmp_path / "samples")
    sinks.append(rows, table, path)
    back = sinks.read(spark, table, path)
    assert back.count() == rows.count() and back.drop("yyyymm").columns == SAMPLES.fieldNames()
    pruned = sinks.read(spark, table, path).where("yyyymm = '202605'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in pruned
    sinks.delete_where(spark, path, F.col("metric_name") == "synthetic_service_up", str(tmp_path / "kept"))
    assert spark.read.parquet(str(tmp_path / "kept")).where("metric_name = 'synthetic_service_up'").count() == 0
    with pytest.raises(ValueError):
        sinks.clear(spark, "system")
    filled = sinks.with_defaults(spark.createDataFrame([(None,), ("x",)], "a string"), {"a": F.lit("d"), "b": F.lit(1)}).collect()
    assert [tuple(r) for r in filled] == [("d", 1), ("x", 1)]


def test_golden_counts_of_generators(spark):
    e = generators.app_events(spark)
    assert {r["count"] for r in e.groupBy("event_type").count().collect()} == {200}
    assert {r.status_code: r["count"] for r in e.groupBy("status_code").count().collect()} == {200: 857, 429: 85, 500: 58}
    c = generators.car_inventory(spark)
    assert {r.stock_status: r["count"] for r in c.groupBy("stock_status").count().collect()} == {"available": 2437, "reserved": 406, "maintenance": 157}
    assert c.where("mileage_km > 20000").count() == 1712
    assert {r["count"] for r in c.groupBy("city").count().collect()} == {1000} and {r["count"] for r in c.groupBy("brand", "model").count().collect()} == {150}
    m = generators.service_metrics(spark, 72)
    assert m.select("sample_time").distinct().count() == 4321
    assert m.where("metric_name = 'synthetic_service_up' and value = 0").count() == 3 * 24


def test_a_minute_of_the_metric_scenario(spark):
    m = generators.service_metrics(spark, 0, "2026-05-24 13:10:00")
    rows = {(r.metric_name, r.labels["service"], r.labels.get("route"), r.labels.get("status_class"), r.labels.get("level")): r for r in m.collect()}
    assert m.count() == 115 and len({r.metric_name for r in rows.values()}) == 10 and {r.labels["environment"] for r in rows.values()} == {"synthetic-prod"}
    down = rows["synthetic_log_events_total", "db-mysql-billing", None, None, "error"]
    assert down.labels["event"] == "database_unavailable" and rows["synthetic_db_replication_lag_seconds", "db-mysql-billing", None, None, None].value == 180
    assert rows["synthetic_incident_active", "db-mysql-billing", None, None, None].labels["severity"] == "critical"


def test_settings_of_a_backfill():
    import datetime

    now = datetime.datetime(2024, 1, 1, 12, tzinfo=datetime.UTC)
    assert metrics.backfill_request({}, now) == {"queries": ["up"], "start": "2024-01-01T11:00:00Z", "end": "2024-01-01T12:00:00Z", "step": "60s"}
    assert metrics.backfill_request({"queries": ["a", "b"], "query": "c", "step": "5s"}, now)["queries"] == ["a", "b"]
    assert metrics.backfill_request({"queries": [], "query": "c"}, now)["queries"] == ["c"]


def test_payloads_over_the_limit_raise(spark, monkeypatch):
    monkeypatch.setattr(metrics, "MOST_BODY", 10)
    with pytest.raises(PySparkException):
        metrics.pushed_series(spark.createDataFrame([(bytearray(20),)], "content binary")).collect()


def test_bulk_actions_in_other_spellings(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{ "create": {"_index":"i","_id":"1"}}\n{"v":1}\n{"index":{"_index":"i","_id":"2"}}\n{"v":2}\n{"index" : {"_index":"i","_id":"3"}}\r\n{"v":3}\r\n')
    assert sorted(map(tuple, documents.bulk_hits(spark, str(tmp_path)).collect())) == [("i", "1", '{"v":1}'), ("i", "2", '{"v":2}'), ("i", "3", '{"v":3}')]
    (tmp_path / "b.ndjson").write_text('{"index":{"_index":"i","_id":"4"}}\n{"v":4}\n{"v":5}\n{"v":6}\n')
    with pytest.raises(PySparkException):
        documents.bulk_hits(spark, str(tmp_path)).collect()
    assert documents.ordered(spark.createDataFrame([(2,), (1,)], "n int"), "none", "n").first().n == 1


def test_typed_values_of_documents(spark):
    rows = [('{"id":{"$oid":"ab"},"n":{"$numberLong":"5"},"t":{"$date":17}}',), (json.dumps('{"id":"c","n":6,"t":{"$date":"2024"}}'),)]
    got = spark.createDataFrame(rows, "d string").select(changes.plain_json(F.col("d"))).collect()
    assert [json.loads(r[0]) for r in got] == [{"id": "ab", "n": 5, "t": 17}, {"id": "c", "n": 6, "t": "2024"}]


def plain_bulk(path):
    """Bulk files read line by line."""
    out = []
    for file in path.iterdir():
        if file.suffix != ".crc":
            lines = [x.rstrip("\r") for x in file.read_bytes().decode().split("\n") if x.strip()]
            for action, document in zip(lines[::2], lines[1::2], strict=True):
                found = json.loads(action)
                head = found.get("index") or found.get("create")
                out.append((head.get("_index"), head.get("_id"), document))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["300", "1000", "128m"])
def test_bulk_documents_that_look_like_actions(spark, tmp_path, split):
    """Documents that hold actions, escaped line ends and other line separators, blank lines, both ends of line, in many small splits."""
    rng = random.Random(3)
    odd = [{"es": {"index": 5}}, {"index": {"_index": "no", "_id": "0"}}, {"create": {"_id": "x"}}, {"t": '{"index":{"_id":"1"}}\n{"index":{}}'}, {"t": "a b\u0085c é 😀"}, {}, {"long": "x" * 900}]
    for k in range(3):
        with open(tmp_path / f"f{k}.ndjson", "wb") as f:
            for i in range(150):
                action = {rng.choice(["index", "create"]): {"_index": f"i{k}", "_id": str(i)} if i % 9 else {"_index": "i"}}
                for part in (action, rng.choice(odd)):
                    text = json.dumps(part, ensure_ascii=rng.random() < 0.5, separators=rng.choice([(",", ":"), (", ", " : ")]))
                    f.write(text.encode() + rng.choice([b"\n", b"\r\n"]) + rng.choice([b"", b"", b"\n", b"  \t\r\n"]))
    (tmp_path / "empty.ndjson").write_bytes(b"\n \n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        hits = documents.bulk_hits(spark, str(tmp_path))
        assert sorted(map(tuple, hits.collect()), key=str) == plain_bulk(tmp_path)
        assert split == "128m" or hits.rdd.getNumPartitions() > 30
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text", ['{"index":{"_id":"1"}}\n', '{"index":{"_id":"1"}}\n{"a":1}\n{"a":2}\n{"a":3}\n', '{"index":{"_id":"1"}}\nno json\n', '{"delete":{"_id":"1"}}\n{"a":1}\n'])
def test_bulk_files_that_do_not_alternate_raise(spark, tmp_path, text):
    (tmp_path / "x.ndjson").write_text(text)
    with pytest.raises(Exception, match="no document|no action"):
        documents.bulk_hits(spark, str(tmp_path)).collect()


def test_lines_with_faults_are_reported(spark):
    lines = ["# HELP x", "", "  ", "x 1", 'x{a="1",a="2"} 3', "x{", "x one", 'x{a="b"} NaN', "y +Inf 5", "!"]
    df = spark.createDataFrame([(v,) for v in [*lines, None]], "value string")
    assert {r.value: r.fault for r in metrics.bad_lines(df).collect()} == {'x{a="1",a="2"} 3': "a label twice", "x{": "no sample", "x one": "no number", "!": "no sample"}
    assert metrics.exposition_rows(df).count() == 3


def test_long_files_are_hashed_in_pieces(spark, tmp_path, monkeypatch):
    import hashlib

    (tmp_path / "in").mkdir()
    contents = {"a.txt": b"", "b.md": b"short", "c.bin": bytes(range(256)) * 10}
    for name, body in contents.items():
        (tmp_path / "in" / name).write_bytes(body)
    monkeypatch.setattr(files, "PIECE", 100)
    got = {r.path: (r.length, r.sha256, r.supported) for r in files.folder_files(spark, str(tmp_path / "in")).collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest(), not n.endswith(".bin")) for n, b in contents.items() if b}


def test_a_run_of_a_corpus(spark):
    """New, changed, failed, removed, unsupported files, one that became unsupported, and the run after it."""
    from ledgerline.operators import corpus

    now = spark.createDataFrame([("n.md", "1"), ("c.md", "2"), ("s.md", "3"), ("u.exe", "4"), ("f.md", "5"), ("lost.md", "6"), ("was.exe", "7")], "path string, sha256 string")
    before = spark.createDataFrame([("c.md", "0", "c-id"), ("s.md", "3", "s-id"), ("gone.md", "9", "g-id"), ("was.exe", "7", "w-id")], "path string, sha256 string, file_id string")
    plan = corpus.sync_plan(now, before)
    assert {r.path: (r.action, r.old_file_id) for r in plan.collect()} == {
        "n.md": ("index", None), "c.md": ("index", "c-id"), "s.md": ("skip", None), "u.exe": ("unsupported", None),
        "f.md": ("index", None), "lost.md": ("index", None), "gone.md": ("remove", "g-id"), "was.exe": ("remove", "w-id"),
    }
    results = spark.createDataFrame([("n.md", None), ("c.md", None), ("c.md", None), ("f.md", None), ("f.md", "boom")], "path string, error string")
    report = corpus.sync_report(plan, results)
    states = {r.path: (r.state, r.error) for r in report.collect()}
    assert states["n.md"] == states["c.md"] == ("indexed", None) and states["f.md"] == ("failed", "boom") and states["lost.md"] == ("failed", "no result")
    assert (states["s.md"][0], states["u.exe"][0], states["gone.md"][0], states["was.exe"][0]) == ("skipped", "unsupported", "removed", "removed")
    after = corpus.synced_manifest(report)
    assert {r.path for r in after.collect()} == {"n.md", "c.md", "s.md"}
    assert {r.path: r.action for r in corpus.sync_plan(now, after).collect()} == {"n.md": "skip", "c.md": "skip", "s.md": "skip", "u.exe": "unsupported", "f.md": "index", "lost.md": "index", "was.exe": "unsupported"}
