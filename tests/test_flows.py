"""Paged and pushed sources, batches written once, and tables replaced in place: restarts, repeats, crashes, and queries against their SQL."""

import json
import threading
from datetime import UTC, datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer
from pathlib import Path
from urllib.parse import parse_qs, urlparse

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThanOrEqual, LessThan

from ledgerline.plans import flows
from ledgerline.plans.queries import ORACLE_SQL
from ledgerline.sources import keyed, metrics, paged, pushed, range_queries
from ledgerline.streaming.ledger import Ledger

DATA = "/root/testdata/sf0.001"


def compared(spark, name):
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = getattr(flows, name)(spark, DATA)
    columns = sorted(got.columns)
    want = con.sql(ORACLE_SQL[name]).project(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("name", [n for n in dir(flows) if n in ORACLE_SQL])
def test_queries_against_their_sql(spark, name):
    compared(spark, name)


# Paged


def files_of(spark, tmp_path):
    """Rows with equal keys across pages, without a key, and of two files."""
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=i // 7), f"v{i}") for i in range(100)] + [(200 + i, None, "none") for i in range(9)]
    spark.createDataFrame(rows, "id long, at timestamp_ntz, v string").repartition(2).write.parquet(str(tmp_path / "rows"))
    return {"path": str(tmp_path / "rows"), "key": "at", "id": "id", "slices": "5", "pagesize": "4"}


def test_pages_of_files(spark, tmp_path):
    options = files_of(spark, tmp_path)
    got, plain = paged.read_pages(spark, **options), spark.read.parquet(options["path"])
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect())) and got.schema == plain.schema
    assert got.rdd.getNumPartitions() == 6  # five slices and the rows without a key
    reader = paged.PagedReader(options, plain.schema)
    for part in reader.partitions():
        pages = list(reader.read(part))
        assert [p.to_pylist() for p in reader.read(part)] == [p.to_pylist() for p in pages]  # a task that is repeated
        assert all(p.num_rows <= 4 for p in pages)
    parts = reader.partitions()
    spark.createDataFrame([(900, datetime(2024, 1, 1), "late")], "id long, at timestamp_ntz, v string").write.mode("append").parquet(options["path"])
    assert sum(p.num_rows for part in parts for p in reader.read(part)) == 109  # the snapshot is as it was


def test_filters_become_slices(spark, tmp_path):
    options = files_of(spark, tmp_path)
    low, high = datetime(2024, 1, 1, 3), datetime(2024, 1, 1, 9)
    got = paged.read_pages(spark, **options).where((F.col("at") >= F.lit(low)) & (F.col("at") < F.lit(high)) & (F.col("v") != "v30"))
    assert sorted(r.id for r in got.collect()) == [i for i in range(21, 63) if i != 30]
    reader = paged.PagedReader(options, spark.read.parquet(options["path"]).schema)
    list(reader.pushFilters([GreaterThanOrEqual(("at",), low), LessThan(("at",), high), GreaterThanOrEqual(("v",), "x")]))
    parts = reader.partitions()
    assert len(parts) == 5 and min(p.low for p in parts) == low and max(p.high for p in parts) == high
    assert sum(p.num_rows for part in parts for p in reader.read(part)) == 49  # the rows of 3 to 9, both included
    none = paged.read_pages(spark, **options).where(F.col("at") > F.lit(datetime(2030, 1, 1)))
    assert none.collect() == []


def test_pages_of_an_empty_store(spark, tmp_path):
    spark.createDataFrame([], "id long, at long").write.parquet(str(tmp_path / "rows"))
    assert paged.read_pages(spark, path=str(tmp_path / "rows"), key="at", id="id").collect() == []
    with pytest.raises(ValueError):
        paged.PagedReader({"path": str(tmp_path / "rows"), "key": "at", "id": "id", "pagesize": "0"}, spark.range(1).schema)


@pytest.mark.parametrize(("low", "high", "n"), [(0, 10, 3), (0, 2, 8), (5, 5, 4), (0.0, 1.0, 4), ("a", "z", 4), (datetime(2024, 1, 1), datetime(2024, 2, 1), 7)])
def test_bounds_of_slices(low, high, n):
    ends = paged.between(low, high, n)
    assert ends[0] == low and ends[-1] == high and len(ends) <= n + 1
    assert ends == sorted(ends) and (low == high or len(set(ends)) == len(ends))


@pytest.fixture
def search():
    """A document store's search interface with points in time; every fifth page fails once."""
    documents = [{"_index": "logs", "_id": str(i), "_source": {"@timestamp": f"2024-01-01T{i // 9:02d}:00:00+00:00", "n": i}} for i in range(80)]
    documents += [{"_index": "logs", "_id": f"x{i}", "_source": {"n": i}} for i in range(3)]
    state = {"pits": {}, "asked": 0, "documents": documents}

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])) or b"{}")
            state["asked"] += 1
            if state["asked"] % 5 == 0:
                return self.answer(503, {})
            if "_pit" in self.path:
                state["pits"][f"p{len(state['pits'])}"] = list(state["documents"])
                return self.answer(200, {"id": f"p{len(state['pits']) - 1}"})
            if "aggs" in body:
                times = [datetime.fromisoformat(d["_source"]["@timestamp"]).timestamp() * 1000 for d in state["documents"] if "@timestamp" in d["_source"]]
                return self.answer(200, {"aggregations": {"low": {"value": min(times)}, "high": {"value": max(times)}, "none": {"doc_count": 3}}})
            rows, wanted = state["pits"][body["pit"]["id"]], body["query"]["bool"]["filter"][0]
            time = lambda t: datetime.fromisoformat(t).timestamp()
            if "range" in wanted:
                r = wanted["range"]["@timestamp"]
                rows = [(time(d["_source"]["@timestamp"]), k, d) for k, d in enumerate(rows) if "@timestamp" in d["_source"]]
                rows = [x for x in rows if x[0] >= time(r["gte"]) and (x[0] < time(r["lt"]) if "lt" in r else x[0] <= time(r["lte"]))]
            else:
                rows = [(9e18, k, d) for k, d in enumerate(rows) if "@timestamp" not in d["_source"]]
            rows = [x for x in sorted(rows, key=lambda x: x[:2]) if "search_after" not in body or list(x[:2]) > body["search_after"]][: body["size"]]
            self.answer(200, {"hits": {"hits": [d | {"sort": [t, k]} for t, k, d in rows]}})

        def answer(self, code, body):
            data = json.dumps(body).encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", state
    server.shutdown()


def test_pages_of_a_search(spark, search):
    url, state = search
    options = {"store": "search", "url": url, "index": "logs", "slices": "3", "pagesize": "10"}
    got = paged.read_pages(spark, **options).collect()
    assert sorted(r._id for r in got) == sorted(d["_id"] for d in state["documents"]) and len(got) == 83
    assert {r._id: json.loads(r._source) for r in got}["17"] == {"@timestamp": "2024-01-01T01:00:00+00:00", "n": 17}
    reader = paged.PagedReader(options, paged.SearchPages(options).schema())
    parts = reader.partitions()
    state["documents"] = [{"_index": "logs", "_id": "new", "_source": {"@timestamp": "2024-01-01T02:00:00+00:00"}}]
    ids = [i for part in parts for page in reader.read(part) for i in page["_id"].to_pylist()]
    assert len(ids) == len(set(ids)) == 83 and "new" not in ids  # the point in time is all slices'
    ranged = paged.read_pages(spark, **options, start="2024-01-01T01:00:00+00:00", end="2024-01-01T02:30:00+00:00").select("_id").collect()
    assert [r._id for r in ranged] == ["new"]


def test_a_search_that_refuses_raises(spark, search):
    url, _ = search
    reader = paged.PagedReader({"store": "search", "url": url, "index": "logs", "attempts": "1"}, paged.SearchPages({"url": url, "index": "logs"}).schema())
    with pytest.raises(Exception, match="503|Service"):
        for _ in range(6):
            reader.store.snapshot()


# Pushed


def drained(spark, folder, checkpoint, book, batch=4096):
    stream = pushed.pushed_stream(spark, folder, batch)
    stream.writeStream.foreachBatch(book).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def test_pushes_survive_restarts_and_crashes(spark, tmp_path):
    """Payloads come before, between and after runs, one run breaks down while it writes: each is loaded once."""
    folder, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    one, book, sent = pushed.Receiver(folder, "one"), Ledger(spark, str(tmp_path / "rows"), "pushed"), []

    def push(receiver, *bodies):
        for body in bodies:
            receiver.append(body)
            sent.append(body)

    push(one, b"a", b"b", b"")
    drained(spark, folder, checkpoint, book.append)
    push(one, b"c")
    push(pushed.Receiver(folder, "two"), b"x", b"y")

    def broken(batch, batch_id):
        batch.write.mode("overwrite").parquet(book._rows(batch_id))  # and no mark
        raise RuntimeError("down")

    with pytest.raises(Exception, match="down"):
        drained(spark, folder, checkpoint, broken)
    push(pushed.Receiver(folder, "one"), b"d")  # a receiver that starts again counts on
    for _ in range(3):
        drained(spark, folder, checkpoint, book.append)
    push(pushed.Receiver(folder, "one"), b"e")
    push(pushed.Receiver(folder, "three"), b"z")
    drained(spark, folder, checkpoint, book.append)
    rows = book.table(pushed.pushed_stream(spark, folder).schema).collect()
    assert sorted(bytes(r.content) for r in rows) == sorted(sent)
    assert sorted((r.receiver, r.number) for r in rows) == [("one", k) for k in range(6)] + [("three", 0), ("two", 0), ("two", 1)]


def test_offsets_of_pushes(tmp_path):
    folder = str(tmp_path / "landing")
    receiver = pushed.Receiver(folder, "r")
    for k in range(5):
        receiver.append(bytes([k]))
    reader = pushed.PushedReader({"path": folder, "batch": "2"})
    assert reader.initialOffset() == {} and reader.latestOffset() == {"r": 5}  # all that is there when it starts
    for k in range(5):
        receiver.append(bytes([k]))
    assert reader.latestOffset() == {"r": 7}
    parts = reader.partitions({"r": 5}, {"r": 7})
    assert [p.numbers for p in parts] == [[5, 6]] and [b["content"][0].as_py() for b in reader.read(parts[0])] == [b"\0", b"\1"]
    reader.commit({"r": 5})
    assert pushed.PushedReader({"path": folder}).latestOffset() == {"r": 10} and pushed.Receiver(folder, "r").next == 10
    assert [p.numbers for p in pushed.PushedReader({"path": folder}).partitions({}, {"r": 7})] == [[5, 6]]
    reader.commit({"r": 10})
    assert pushed.Receiver(folder, "r").next == 10 and pushed.PushedReader({"path": folder}).latestOffset() == {}
    (tmp_path / "landing" / "r" / "x.part").write_bytes(b"half")
    assert pushed.PushedReader({"path": folder}).latestOffset() == {}


def test_payloads_that_cannot_be_pushed(tmp_path, monkeypatch):
    monkeypatch.setattr(pushed, "MOST_BODY", 3)
    receiver = pushed.Receiver(str(tmp_path), "r")
    with pytest.raises(ValueError):
        receiver.append(b"1234")
    assert receiver.append(b"123") == 0
    for name in ("", "a/b"):
        with pytest.raises(ValueError):
            pushed.Receiver(str(tmp_path), name)


def test_a_request_written_by_hand(spark, tmp_path):
    """A write request as bytes: series of labels __name__=up and a=b with 1.5 at 1 ms and -2.0 at 2^41 ms, snappy in one literal."""
    body = bytes.fromhex("0a37" + "0a0e" + "0a085f5f6e616d655f5f" + "12027570" + "0a06" + "0a0161" + "120162" + "120b" + "09000000000000f83f" + "1001" + "1210" + "0900000000000000c0" + "10808080808040")
    assert body[1] == len(body) - 2
    framed = bytes([len(body)]) + bytes([(len(body) - 1) << 2 if len(body) <= 60 else 60 << 2]) + (b"" if len(body) <= 60 else bytes([len(body) - 1])) + body
    receiver = pushed.Receiver(str(tmp_path / "landing"), "hand")
    receiver.append(framed)
    book = Ledger(spark, str(tmp_path / "rows"), "hand")
    drained(spark, str(tmp_path / "landing"), str(tmp_path / "checkpoint"), book.append)
    rows = metrics.pushed_series(book.table(pushed.pushed_stream(spark, str(tmp_path / "landing")).schema)).collect()
    assert [(r.labels, r.timestamp, r.value) for r in rows] == [({"__name__": "up", "a": "b"}, 1, 1.5), ({"__name__": "up", "a": "b"}, 2**41, -2.0)]


# Batches once


def test_a_batch_that_comes_again_is_written_once(spark, tmp_path):
    book, other = Ledger(spark, str(tmp_path), "a"), Ledger(spark, str(tmp_path), "b-2")
    batch = spark.range(5)
    assert book.table(batch.schema).count() == 0 and book.ids() == []
    for _ in range(3):
        book.append(batch, 0)
    batch.write.parquet(book._rows(1))  # a crash before the mark
    assert book.table(batch.schema).count() == 5
    book.append(batch, 1)
    other.append(batch.limit(1), 0)
    assert book.table(batch.schema).count() == 10 and other.table(batch.schema).count() == 1 and book.ids() == [0, 1]
    calls = []
    for _ in range(2):
        book.once(lambda b, i: calls.append(i))(batch, 7)
    assert calls == [7] and book.ids() == [0, 1, 7]
    with pytest.raises(ValueError):
        Ledger(spark, str(tmp_path), "a/b")


# Replaced in place


def state(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def test_only_touched_buckets_are_written(spark, tmp_path):
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v"), (F.col("id") * 1.0).alias("price"))
    table = keyed.KeyedTable(spark, str(tmp_path), rows.schema, ["k"], 8)
    assert table.read().count() == 0 and table.upsert(rows.limit(0), "v") == 0
    assert table.upsert(rows, "v") == 1 and table.read().count() == 200
    before = {f["path"] for f in table.files()}
    one = spark.createDataFrame([(7, 2, 7.5), (7, 3, 8.5), (1000, 1, 1.0)], rows.schema)
    table.upsert(one, "v")
    after = {f["path"] for f in table.files()}
    assert len(before - after) <= 2 and len(before & after) >= 6
    got = {r.k: (r.v, r.price) for r in table.read().collect()}
    assert got[7] == (3, 8.5) and got[1000] == (1, 1.0) and len(got) == 201
    assert table.read(1).where("k = 7").first().v == 1  # the version before
    gone = one.withColumn("gone", F.col("k") == 7)
    table.upsert(gone, "v", deleted="gone")
    assert 7 not in {r.k for r in table.read().collect()} and table.read().count() == 200
    assert table.vacuum() > 0 and table.read().count() == 200 and table.versions() == [3]


def test_deletes_read_files_that_can_match(spark, tmp_path, monkeypatch):
    rows = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") != 50, F.col("id") * 10).alias("v"))
    table = keyed.KeyedTable(spark, str(tmp_path), rows.schema, ["k"], 10)
    table.upsert(rows, "k")
    read = []
    plain = keyed.KeyedTable._rows
    monkeypatch.setattr(keyed.KeyedTable, "_rows", lambda self, paths: (read.append(set(paths)), plain(self, paths))[1])
    before = {f["path"]: f for f in table.files()}
    assert table.delete("v", 2000, None) == 1 and not read  # no file has such a value
    table.delete("v", 30, 31)
    can = {p for p, f in before.items() if int(f["least"]["v"]) < 31 and int(f["most"]["v"]) >= 30}
    assert read[0] == can and len(before.keys() - {f["path"] for f in table.files()}) == 1
    table.delete("v", None, 500)
    assert {r.k for r in table.read().collect()} == {*range(50, 100)} and table.read().where("v is null").count() == 1
    table.delete("k")
    assert table.read().count() == 0


def test_a_crash_before_the_swap_leaves_the_old_version(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    table = keyed.KeyedTable(spark, str(tmp_path), rows.schema, ["k"], 4)
    table.upsert(rows, "v")
    old = state(table)
    with monkeypatch.context() as m:
        m.setattr(keyed.KeyedTable, "_swap", lambda *_: (_ for _ in ()).throw(RuntimeError("down")))
        with pytest.raises(RuntimeError, match="down"):
            table.upsert(spark.createDataFrame([(1, "z"), (None, "y")], rows.schema), "v")
        with pytest.raises(RuntimeError, match="down"):
            table.delete("v", "a", "b")
    assert state(table) == old and table.versions() == [1]
    other = keyed.KeyedTable(spark, str(tmp_path), rows.schema, ["k"], 4)
    files = other.files()
    table.upsert(spark.createDataFrame([(None, "y")], rows.schema), "v")
    assert state(table) == [(1, "a"), (None, "y")]
    with pytest.raises(RuntimeError, match="another"):
        other._swap(files, 1)  # it read version 1
    with pytest.raises(ValueError):
        keyed.KeyedTable(spark, str(tmp_path), rows.schema, ["none"])


# Range queries


@pytest.fixture
def ranges():
    """A metric server's range queries: value is the time; every fourth answer fails once, over 50 points are refused."""
    state = {"asked": 0, "steps": []}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            state["asked"] += 1
            start, end, step = float(q["start"]), float(q["end"]), range_queries.seconds(q["step"])
            steps = [start + k * step for k in range(int((end - start) / step + 1e-6) + 1)]
            if state["asked"] % 4 == 0:
                code, body = 500, {}
            elif len(steps) > 50 or q["query"] == "bad(":
                code, body = 400, {"status": "error", "error": "exceeded or bad"}
            else:
                state["steps"] += steps
                code, body = 200, {"status": "success", "data": {"result": [{"metric": {"job": "j"}, "values": [[t, str(t % 100)] for t in steps]}]}}
            data = json.dumps(body).encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", state
    server.shutdown()


def test_range_queries_in_stretches(spark, ranges):
    url, state = ranges
    asked = {"queries": ["up", "rate(x[5m])"], "start": "2024-01-01T00:00:00Z", "end": "2024-01-01T02:05:30Z", "step": "1m"}
    answers = range_queries.range_answers(spark, url, asked, points=50)
    assert answers.rdd.getNumPartitions() == 6  # 126 steps of two queries
    rows = metrics.range_rows(answers).collect()
    for query in asked["queries"]:
        times = sorted(r.sample_time.timestamp() for r in rows if r.metric_name == query)
        assert times == [datetime(2024, 1, 1, tzinfo=UTC).timestamp() + 60 * k for k in range(126)]
    assert {r.query: r.inserted for r in metrics.backfill_details(range_queries.range_answers(spark, url, asked, points=50)).collect()} == {"up": 126, "rate(x[5m])": 126}
    with pytest.raises(Exception, match="400"):
        range_queries.range_answers(spark, url, asked | {"queries": ["bad("]}, points=50).collect()
    assert range_queries.range_answers(spark, url, asked | {"end": "2023-01-01T00:00:00Z"}).collect() == []


@pytest.mark.parametrize(("step", "want"), [("60s", 60), ("1m30s", 90), ("250ms", 0.25), ("15", 15), ("2h", 7200)])
def test_steps(step, want):
    assert range_queries.seconds(step) == want


def test_one_source_at_a_time(spark, tmp_path):
    """A source that is started in place of others stops them; streams of other names go on."""
    from ledgerline.streaming import micro_batches

    start = lambda name: lambda df: df.writeStream.format("noop").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
    stream = spark.readStream.format("rate").load()
    sources = ["cdc-postgres", "cdc-mysql"]
    try:
        for name in ("cdc-postgres", "other", "cdc-mysql"):
            micro_batches.start_or_replace(stream, name, start(name), sources if name in sources else ())
        assert sorted(q.name for q in spark.streams.active) == ["cdc-mysql", "other"]
    finally:
        for q in spark.streams.active:
            q.stop()
