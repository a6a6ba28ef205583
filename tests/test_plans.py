"""Views, panels, catalog, guarded queries, programs, streams and the query catalogue."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import corpus, filters, joins, series, versions
from ledgerline.plans import catalog, guarded, panels, programs, views
from ledgerline.plans import queries as q
from ledgerline.schemas import OFFSETS, TABLES
from ledgerline.sources import documents, generators, metrics
from ledgerline.streaming import micro_batches

DATA = Path("/root/testdata/sf0.001")


def test_views_over_generated_tables(spark):
    cars = views.inventory_summary(generators.car_inventory(spark))
    assert cars.agg(F.sum("cars"), F.sum("available_cars")).first()[:] == (3000, 2437)
    events = views.event_summary(generators.app_events(spark))
    assert events.agg(F.sum("events")).first()[0] == 1000
    hits = documents.hit_rows(generators.log_documents(spark), "lab", 1)
    assert views.index_summary(hits).count() == 4
    assert views.document_timeline(hits).agg(F.sum("documents")).first()[0] == 720
    assert {r.service for r in views.document_producers(hits).collect()} == {s for s, _, _ in generators.LOG_SERVICES}
    assert views.log_fields(hits).where("status_code = 500").count() > 0


def test_metric_views_leave_stale_marks_out_and_count_merged_rows_once(spark):
    made = spark.createDataFrame(
        [({"__name__": "up", "job": "a", "instance": "i"}, 0, 0.0), ({"__name__": "up", "job": "a", "instance": "i"}, 1000, 1.0), ({"__name__": "g"}, 0, float("nan"))],
        metrics.SERIES,
    )
    once = metrics.sample_rows(made)
    twice = once.unionByName(once.withColumn("ingest_time", F.col("ingest_time") + F.expr("interval 1 second")))
    other = metrics.sample_rows(made, "backfill")
    merged = versions.merged(twice.unionByName(other), TABLES["prometheus_samples"])
    assert merged.count() == 6  # another way of loading is another row
    t = views.targets(versions.merged(twice, TABLES["prometheus_samples"])).first()
    assert (t.job, t.instance, t.last_up, t.avg_up) == ("a", "i", 1.0, 0.5)
    stale = views.metric_summary(once).where("metric_name = 'g'").first()
    assert stale.samples == 1 and stale.max_value is None
    assert [r[0] for r in views.label_values(once, "up", "job").collect()] == ["a"]
    ups = metrics.sample_rows(generators.service_metrics(spark, 24).select(F.map_concat("labels", F.create_map(F.lit("__name__"), "metric_name")).alias("labels"), F.unix_millis("sample_time").alias("timestamp"), "value"))
    down = {r.service: r.availability for r in views.availability(ups, "24 hours").collect()}
    assert down["db-mysql-billing"] < 1.0 and down["api-gateway"] == 1.0


def test_panels_become_a_dashboard(spark):
    e = generators.app_events(spark)
    shown = [panels.panel(n, k, f(e)) for n, (k, f) in panels.PANELS.items()]
    board = panels.dashboard("Events <now>", shown)
    assert len(board["panels"]) == 8 and board["title"] == "Events now"
    assert panels.panel("x", "timeseries", panels.event_type_share(e))["type"] == "barchart"
    assert panels.error_events(e).first()[0] == 200
    assert panels.rows_of(panels.total_events(e)) == ['{"total_events":1000}'] and panels.rows_of(panels.total_events(e), "tsv") == ["total_events", "1000"]
    assert {r.route: r.error_rate for r in panels.problem_routes(e).collect()}["/chat"] == 0.145


def test_aggregates_of_all_null_groups(spark):
    e = generators.app_events(spark, 10).withColumns({"latency_ms": F.lit(None).cast("int"), "route": F.lit("r")})
    row = panels.problem_routes(e).first()
    assert row.avg_latency_ms is None and row.p95_latency_ms is None


@pytest.mark.parametrize("text", ["SELECT 1", "select 1;", "  SELECT 1", "WITH a AS (SELECT 1) SELECT * FROM a", "(SELECT 1)", "SELECT 'delete' AS x", "SELECT 1 UNION SELECT 2", "VALUES (1)"])
def test_queries_pass_the_guard(spark, text):
    guarded.run_query(spark, text).collect()


@pytest.mark.parametrize("text", ["DROP TABLE x", "INSERT INTO x SELECT 1", "SELECT 1; SELECT 2", "SHOW TABLES", "CREATE VIEW v AS SELECT 1", "TRUNCATE TABLE x", "SET a=1", "", "ALTER TABLE x ADD COLUMN y int", "USE x", "EXPLAIN SELECT 1", "CACHE TABLE x", "WITH a AS (SELECT 1) INSERT INTO x SELECT * FROM a"])
def test_everything_else_fails(spark, text):
    with pytest.raises(ValueError):
        guarded.run_query(spark, text)


@pytest.mark.parametrize(
    "text",
    [
        "FROM guard_t INSERT INTO a SELECT id INSERT INTO b SELECT id",
        "SELECT * FROM (SELECT TRANSFORM(id) USING 'cat' AS (x) FROM guard_t)",
        "FROM guard_t MAP id USING 'cat'",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT id FROM guard_t WHERE id = (SELECT java_method('java.lang.System', 'getProperty', 'user.home'))",
        "SELECT id FROM guard_t ORDER BY try_reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT transform(array(1), x -> reflect('java.lang.System', 'getProperty', 'user.home'))",
        "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')",
        "SELECT system.builtin.reflect('java.lang.System', 'getProperty', 'user.home')",
        "SELECT * FROM guard_t LATERAL VIEW reflect('a', 'b') e AS x",
        "SELECT * FROM parquet.`/path`",
        "SELECT * FROM `/path`",
        "WITH a AS (SELECT * FROM text.`/etc/hosts`) SELECT * FROM a",
        "SELECT (SELECT max(value) FROM text.`/etc/hosts`)",
        "SELECT * FROM IDENTIFIER('parquet.`/path`')",
        "SELECT * FROM python_worker_logs()",
        "SELECT input_file_name() FROM guard_t",
        "SELECT * FROM no_such_table",
        *(
            outer.format(f"SELECT id, rank() OVER w AS r FROM guard_t WINDOW w AS ({inside})")
            for outer in ("{}", "WITH a AS ({}) SELECT * FROM a", "SELECT * FROM ({}) b", "SELECT id FROM guard_t WHERE id IN (SELECT r FROM ({}) c)", "SELECT 1 AS id, 1 AS r UNION ALL ({})")
            for inside in (
                "ORDER BY reflect('java.lang.System', 'setProperty', 'guard.passed', '1')",
                "PARTITION BY java_method('java.lang.System', 'setProperty', 'guard.passed', '1') ORDER BY id",
                "ORDER BY (SELECT max(value) FROM text.`/etc/hostname`)",
            )
        ),
        "SELECT sum(id) FILTER (WHERE reflect('java.lang.System', 'getProperty', 'a') = '') FROM guard_t",
        "SELECT id FROM guard_t GROUP BY GROUPING SETS ((id), (reflect('java.lang.System', 'getProperty', 'a')))",
        "SELECT * FROM guard_t PIVOT (max(reflect('java.lang.System', 'getProperty', 'a')) FOR id IN (1, 2))",
        "SELECT * FROM guard_t TABLESAMPLE (10 PERCENT) JOIN (SELECT * FROM text.`/etc/hostname`) x ON true",
        "SELECT id FROM guard_t LIMIT (SELECT max(length(value)) FROM text.`/etc/hostname`)",
        "SELECT * FROM VALUES (reflect('java.lang.System', 'getProperty', 'a'))",
        "SELECT * FROM guard_t, LATERAL (SELECT * FROM text.`/etc/hostname`)",
    ],
)
def test_the_whole_plan_is_checked(spark, text):
    spark.range(3).createOrReplaceTempView("guard_t")
    with pytest.raises(ValueError):
        guarded.run_query(spark, text)


def test_queries_of_every_shape_pass_the_guard(spark):
    spark.range(3).createOrReplaceTempView("guard_t")
    for text in (
        "SELECT id, count(*) AS n FROM guard_t GROUP BY id HAVING n > 0 ORDER BY id LIMIT 2",
        "SELECT * FROM guard_t WHERE id IN (SELECT id FROM guard_t) AND EXISTS (SELECT 1 FROM guard_t) AND id > (SELECT min(id) FROM guard_t)",
        "SELECT x FROM guard_t LATERAL VIEW explode(array(1, 2)) e AS x",
        "SELECT * FROM range(3)",
        "SELECT rank() OVER w FROM guard_t WINDOW w AS (ORDER BY id)",
        "SELECT sum(id) OVER w AS s, min(id) OVER v FROM guard_t WINDOW v AS (PARTITION BY id % 2), w AS (PARTITION BY id % 2 ORDER BY id ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)",
        "SELECT cast(1.5 AS decimal(9,2)), date'2024-01-01', interval 3 days, X'1A', 1e3, 2.5BD, 'é', NULL, true, array(1), map('a', 1), CASE WHEN id > 1 THEN 'x' END FROM guard_t TABLESAMPLE (50 PERCENT)",
        "SELECT a.id FROM guard_t a LEFT JOIN guard_t b USING (id) JOIN guard_t c ON a.id = c.id NATURAL JOIN guard_t d WHERE a.id BETWEEN 0 AND 2 AND cast(a.id AS string) LIKE '%1%' OR a.id IS NOT NULL",
        "SELECT id, count(*) AS n FROM guard_t GROUP BY ROLLUP (id) ORDER BY n DESC NULLS LAST LIMIT 3 OFFSET 1",
        "SELECT transform(array(1, 2), x -> x + 1), count(DISTINCT id) FILTER (WHERE id > 0), percentile(id, 0.5) FROM guard_t",
        "SELECT * FROM (SELECT id, id + 1 AS b FROM guard_t) UNPIVOT (v FOR k IN (id, b))",
        "SELECT * FROM guard_t a, LATERAL (SELECT a.id + 1 AS next)",
        "WITH a AS (WITH b AS (SELECT 1 AS y) SELECT * FROM b) SELECT * FROM a, guard_t",
        "SELECT id FROM guard_t PIVOT (count(*) FOR id IN (1, 2))".replace("SELECT id", "SELECT *"),
    ):
        guarded.run_query(spark, text).collect()


def test_rows_within_a_time(spark):
    assert guarded.rows_within(spark.range(2)) == spark.range(2).collect()
    slow = spark.range(10**12).where("hash(id) = hash(id + 1)").agg(F.count("*"))
    with pytest.raises(TimeoutError):
        guarded.rows_within(slow, 1.0)
    with pytest.raises(Exception, match="no luck"):
        guarded.rows_within(spark.range(1).select(F.raise_error(F.lit("no luck"))), attempts=2, pause=lambda _: None)


def test_strict_guard(spark):
    for text in ("WITH a AS (SELECT 1) SELECT * FROM a", "SELECT 'delete' AS x"):
        with pytest.raises(ValueError):
            guarded.run_query(spark, text, strict=True)


def test_short_names():
    r = guarded.rewrite
    assert r("SELECT city FROM cars;") == "SELECT city FROM v_car_inventory_summary"
    assert r("select * from x JOIN car_inventory c") == "select * from x JOIN v_car_inventory_summary c"
    assert r("SELECT * FROM analytics.car_inventory") == "SELECT * FROM analytics.car_inventory"
    assert r("SELECT count(*) AS n FROM cars") == "SELECT sum(cars) AS n FROM v_car_inventory_summary"
    assert r("SELECT 1 FROM x JOIN cars c") == "SELECT 1 FROM x JOIN v_car_inventory_summary c"
    assert r("SELECT city, COUNT ( * )  as n, 'count(*) AS n' FROM x JOIN cars") == "SELECT city, sum(cars) AS n, 'count(*) AS n' FROM x JOIN v_car_inventory_summary"
    assert r("SELECT автомобилей FROM x") == "SELECT car_count FROM x"
    assert r("SELECT count(*) AS n FROM x") == "SELECT count(*) AS n FROM x"
    assert r("SELECT город FROM cars WHERE city = 'город from cars'") == "SELECT city FROM v_car_inventory_summary WHERE city = 'город from cars'"


def test_catalog(spark):
    generators.car_inventory(spark, 30).createOrReplaceTempView("car_inventory_view")
    spark.range(0).select(F.lit("x").alias("document_json")).createOrReplaceTempView("elasticsearch_events")
    c = catalog.Catalog(spark)
    assert next(t for t in c.tables() if t["name"] == "car_inventory_view")["rows"] is None
    assert c.for_question("сколько машин в городе?")[0]["name"] == "car_inventory_view"
    assert c.columns("car_inventory_view")[0] == {"name": "id", "type": "bigint", "position": 1}
    assert c.sample("car_inventory_view", 5).count() == 5
    assert c.count_by("car_inventory_view", ["city"], {"brand": "Toyota"}).agg(F.sum("rows")).first()[0] == 6
    assert c.distinct("car_inventory_view", "city").count() == 3
    assert c.profile("car_inventory_view", ["city"]).first()["distinct_values"] == 3
    for call in (lambda: c.table("none"), lambda: c.table("a;b"), lambda: c.distinct("car_inventory_view", "nope"), lambda: c.count_by("car_inventory_view", [])):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(ValueError):
        c.count_by("car_inventory_view", ["city"], compare=[{"column": "city", "operator": "like", "value": "x"}])


PROGRAM = '''
CONNECTOR = {"name": "query_by_city", "description": "cars of each city", "input_schema": {"type": "object"}}
def handler(args, run_query, helpers):
    n = helpers.bounded_limit(args.get("limit"))
    return [r["city"] for r in run_query("SELECT DISTINCT city FROM program_cars ORDER BY city").limit(n).collect()]
'''


def test_programs(spark):
    generators.car_inventory(spark, 30).createOrReplaceTempView("program_cars")
    p = programs.Programs(spark)
    assert p.run_once(PROGRAM) == ["Minsk", "Moscow", "Tokyo"] and p.known == {}
    p.create(PROGRAM)
    assert p.run("query_by_city", {"limit": 1}) == ["Minsk"]
    with pytest.raises(ValueError):
        p.create(PROGRAM)
    p.create(PROGRAM, overwrite=True)
    for bad in ("import os\n" + PROGRAM, PROGRAM.replace("helpers.bounded_limit", "open"), "x = 1", PROGRAM.replace("cars of each city", "cars"), PROGRAM + "#" * 30_000, PROGRAM.replace("query_by", "other_by"), "def"):
        with pytest.raises(ValueError):
            p.create(bad, overwrite=True)


def test_programs_reach_neither_the_session_nor_unchecked_columns(spark):
    generators.car_inventory(spark, 30).createOrReplaceTempView("program_cars")
    p = programs.Programs(spark)
    for bad in ("helpers._catalog", "run_query('SELECT 1')._frame", "helpers.schema.__self__"):
        with pytest.raises(ValueError):
            p.create(PROGRAM.replace("helpers.bounded_limit(args.get(\"limit\"))", bad))
    with pytest.raises(ValueError):
        p.create(PROGRAM.replace("FROM program_cars", "FROM analytics.program_cars"))
    p.create(PROGRAM.replace("FROM program_cars", "FROM analytics.program_cars").replace("    n =", "    helpers.column_exists('program_cars', 'city')\n    n ="))
    assert p.update("query_by_city", PROGRAM).name == "query_by_city" and p.run("query_by_city") == ["Minsk", "Moscow", "Tokyo"]
    for call in (lambda: p.update("query_other", PROGRAM), lambda: p.create(PROGRAM, True, "query_other")):
        with pytest.raises(ValueError):
            call()
    h = programs.Helpers(spark)
    assert h.table_exists("program_cars") == "program_cars" and h.column_exists("program_cars", "city") == "city"
    assert h.literal("a'b\\") == "'a\\'b\\\\'" and h.literal(True) == "1" and h.quoted_name("a`b") == "`a``b`" and h.quoted_text(5) == "'5'"
    assert len(h.count_by("program_cars", ["city"]).collect()) == 3 and "program_cars" in {t["name"] for t in h.list_tables()}


def test_intervals_match_closed_and_first(spark):
    points = spark.createDataFrame([("a", 1), ("a", 5), ("a", 7), ("a", 8), ("b", 5), (None, 5)], "k string, t int")
    rows = joins.numbered([("a", "one", 1, 5), ("a", "two", 5, 7)], "k string, name string, start int, stop int", spark)
    got = joins.first_interval(points, rows, "k", F.col("t"), "start", "stop", "place").select("k", "t", "name").collect()
    assert {(r.k, r.t): r.name for r in got} == {("a", 1): "one", ("a", 5): "one", ("a", 7): "two", ("a", 8): None, ("b", 5): None, (None, 5): None}


def test_as_of(spark):
    left = spark.createDataFrame([("a", 1, 10), ("a", 5, 11), ("b", 3, 12)], "k string, t int, id int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("c", 1, "z")], "k string, t int, v string")
    got = {r.id: r.v for r in joins.as_of(left, right, "k", "t", ["v"]).collect()}
    assert got == {10: None, 11: "y", 12: None}


def test_series(spark):
    rows = [("s", f"2024-01-01 00:0{i}:00", v) for i, v in enumerate([10.0, 15.0, 3.0, 3.0])]
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp"))
    assert [r.increase for r in series.increases(df, ["k"], "t", "v").orderBy("t").collect()] == [None, 5.0, 3.0, 0.0]
    assert series.rate(df, ["k"], 300, "t", "v").orderBy(F.desc("t")).first()["rate"] == 8.0 / 300
    assert series.changes(df, ["k"], "t", "v").count() == 3
    assert series.sessions(df, "k", "t", "30 seconds").count() == 4 and series.sessions(df, "k", "t", "2 minutes").count() == 1


def test_corpus(spark):
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "4")], "path string, sha256 string")
    then = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", "3")], "path string, sha256 string")
    assert dict(corpus.manifest_diff(now, then).collect()) == {"a": "unchanged", "b": "changed", "c": "removed", "d": "new"}
    assert [r.path for r in corpus.removed(now, then).collect()] == ["c"]
    texts = spark.createDataFrame([(1, "x" * 3000), (2, ""), (3, "y" * 1500)], "id int, text string")
    parts = corpus.chunks(texts).collect()
    assert {i: [len(p.chunk) for p in parts if p.id == i] for i in (1, 2, 3)} == {1: [1500, 1500, 200], 2: [0], 3: [1500]}
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [2.0, 0.0]), (4, [0.0, 0.0])], "vec_id int, embedding array<float>")
    assert [tuple(r) for r in corpus.nearest(vectors, [1.0, 0.0], 2).collect()] == [(1, 1.0), (3, 1.0)]


def test_current_state_and_checkpoints(spark):
    log = spark.createDataFrame([(1, "a", 1, "false"), (1, "b", 2, "false"), (2, "c", 1, "false"), (2, "c", 2, "true"), (1, "b", 2, "false")], "id int, v string, n int, __deleted string")
    assert [tuple(r) for r in versions.current_state(log, ["id"], "n").collect()] == [(1, "b", 2)]
    once = versions.latest_by_key(log, ["id"], "n")
    assert sorted(versions.latest_by_key(once, ["id"], "n").collect()) == sorted(once.collect())


def test_micro_batches(spark):
    at = lambda m, s=0: datetime.datetime(2024, 1, 1, 0, m, s)
    source = spark.createDataFrame([(f"d{i}", at(i)) for i in range(10)], "document_id string, event_time timestamp")
    empty = spark.createDataFrame([], OFFSETS)
    loads = []
    run = lambda o, end: micro_batches.run_micro_batch(source, o, end, lambda b: loads.append(b.collect()), "s", "c")
    first = run(empty, at(5))
    assert [r.document_id for r in loads[-1]] == ["d3", "d4"]  # start in, end out
    second = run(first, at(8))
    assert [r.document_id for r in loads[-1]] == ["d2", "d3", "d4", "d5", "d6", "d7"]  # overlap of two minutes
    nothing = micro_batches.run_micro_batch(source.limit(0), second, at(9), loads.append, "s", "c")
    assert nothing is second and len(loads) == 2
    with pytest.raises(RuntimeError):  # a crash between load and checkpoint repeats the interval

        def fail(_):
            raise RuntimeError

        micro_batches.run_micro_batch(source, second, at(9), fail, "s", "c")
    assert versions.latest_checkpoint(second, "s", "c").first()["last_document_id"] == "d7"
    assert micro_batches.interval(at(3), at(5)) == (at(3), at(5)) and micro_batches.interval(at(5), at(5)) == (at(3), at(5))


def test_streams(spark, tmp_path):
    rows = [{"id": i, "t": f"2024-01-01T00:{i:02d}:00Z", "topic": "x" if i % 2 else "y"} for i in range(20)]
    source = tmp_path / "in"
    spark.createDataFrame(rows, "id int, t string, topic string").coalesce(1).write.json(str(source))
    schema = "id int, t timestamp, topic string"
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for _ in range(2):  # the second run finds nothing new
        micro_batches.stream_into(spark.readStream.schema(schema).json(str(source)), out, mark, "plain").awaitTermination()
    assert spark.read.parquet(out).count() == 20
    routed = micro_batches.stream_routed(spark.readStream.schema(schema).json(str(source)), {"x": "odd", "y": "even"}, str(tmp_path / "t"), str(tmp_path / "m2"), "routed")
    routed.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t/odd")).count() == 10
    windows = micro_batches.tumbling(spark.readStream.schema(schema).json(str(source)), "t", "5 minutes", ["topic"])
    micro_batches.stream_into(windows, str(tmp_path / "w"), str(tmp_path / "m3"), "windows").awaitTermination()
    closed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "w")).select("window_start", "topic", "events").collect()}
    whole = {tuple(r) for r in micro_batches.tumbling(spark.read.schema(schema).json(str(source)), "t", "5 minutes", ["topic"]).collect()}
    assert closed and closed < whole  # windows that the watermark has not passed stay open
    unique = micro_batches.without_repeats(spark.readStream.schema(schema).json(str(source)), ["topic"], "t", "1 hour")
    micro_batches.stream_into(unique, str(tmp_path / "u"), str(tmp_path / "m4"), "unique").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "u")).count() == 2


def test_filters(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00", 1), ("2020-01-02 00:00:00", 2)], "t string, n int").withColumn("t", F.col("t").cast("timestamp"))
    assert filters.recent(df, "t", "1 hour").count() == 1  # before the latest row, not before now
    with pytest.raises(ValueError):
        filters.conditions(df, {"x": 1})


@pytest.mark.parametrize("name", sorted(q.QUERIES))
def test_queries_match_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    mine = q.QUERIES[name](spark, str(DATA))
    columns = sorted(mine.columns)
    theirs = con.sql(q.ORACLE_SQL[name])
    assert columns == sorted(theirs.columns)
    plain = lambda rows: sorted(tuple("" if v is None else repr(v) for v in r) for r in rows)
    assert plain(mine.select(*columns).collect()) == plain(theirs.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_ranks_in_buckets_against_windows(spark):
    from pyspark.sql import Window

    from ledgerline.operators import ranking

    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"), F.round(F.rand(1) * 40, 1).alias("v")).unionByName(spark.createDataFrame([(900, 7, 1.0), (901, 8, 2.0), (902, 8, 2.0)], "id long, g long, v double"))
    w = Window.partitionBy("g").orderBy("v", "id")
    want = df.select("id", F.row_number().over(w).alias("place"), F.ntile(4).over(w).alias("t"))
    got = ranking.places(df, "g", "v", "id", buckets=16).select("id", F.col("place").cast("int"), ranking.tile(4).cast("int").alias("t"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    for q in (0.0, 0.5, 0.95, 1.0):
        exact = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", q).cast("decimal(38,6)").cast("double").alias("p")).collect()}
        assert {r.g: r.p for r in ranking.group_quantile(df, "g", "v", q, "p", 16).collect()} == exact
    d = Window.partitionBy("g").orderBy("v")
    ranks = {(r.g, r.v, r["rank"], r.dense) for r in ranking.value_ranks(df, "g", "v").collect()}
    assert ranks == {tuple(r) for r in df.select("g", "v", F.rank().over(d), F.dense_rank().over(d)).collect()}


def test_trace(spark, tmp_path):
    from ledgerline.plans import trace

    t = trace.Trace(spark, str(tmp_path / "trace"))
    assert t.call("double", lambda n: 2 * n, n=4) == 8

    def fails(source_code):
        raise ValueError("no")

    with pytest.raises(ValueError):
        t.call("fails", fails, source_code="x" * 1000)
    rows = {r.name: r for r in spark.read.parquet(str(tmp_path / "trace")).collect()}
    assert rows["double"].output == "8" and rows["fails"].level == "ERROR" and '"chars": 1000' in rows["fails"].input
    assert trace.shortened("x" * 9000) == {"truncated": True, "chars": 9002, "preview": '"' + "x" * 7999}
    (tmp_path / "file").write_text("")
    assert trace.Trace(spark, str(tmp_path / "file" / "below")).call("f", lambda: 1) == 1


def test_usage_and_levels(spark):
    from ledgerline.functions import expressions as x

    df = spark.createDataFrame([('{"usage":{"prompt_tokens":3,"completion_tokens":4,"total_tokens":7}}',), ('{"id":1}',), ("broken",)], "b string")
    assert [r[0] and tuple(r[0]) for r in df.select(x.usage(F.col("b"))).collect()] == [(3, 4, 7, "TOKENS"), None, None]
    steps = [(None, "green"), (0.5, "yellow"), (0.9, "red")]
    assert [r[0] for r in spark.createDataFrame([(0.1,), (0.5,), (2.0,)], "v double").select(x.level(F.col("v"), steps)).collect()] == ["green", "yellow", "red"]
    with pytest.raises(ValueError):
        panels.rows_of(spark.range(11), most=10)


@pytest.mark.parametrize("values", ["outlier", "heavy", "equal"])
def test_ranges_hold_about_equally_many_rows(spark, values):
    """With one value far from all others, with a log-normal column, and with half of the rows equal."""
    from ledgerline.operators import ranking

    v = {"outlier": F.when(F.col("id") == 7, 1e12).otherwise(F.rand(1)), "heavy": F.exp(F.randn(2) * 3), "equal": F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.rand(3) * 10)}[values]
    df = spark.range(40_000).select("id", F.lit("g").alias("g"), v.alias("v"))
    rows = ranking.ranged(df, "g", "v", "id", ranges=20)
    sizes = [r["count"] for r in rows.groupBy(F.shiftright("__at", 33).alias("r")).count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert [r.place for r in ranking.places(df, "g", "v", "id", buckets=20).orderBy("v", "id").collect()] == list(range(1, 40_001))
