"""Queries of the platform over the star-schema tables, each with the same query in SQL.

``events`` stands for application events, metric samples and log documents;
``orders`` with customers and nations stands for the inventory. A query is registered by
the decorator with the SQL that DuckDB runs on the same files.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import expressions as x
from ledgerline.operators import corpus, filters, joins, ranking, series, versions
from ledgerline.plans import catalog, guarded, panels, views
from ledgerline.schemas import OFFSETS, table_from_source
from ledgerline.session import fresh_path
from ledgerline.sources import changes, metrics
from ledgerline.sources import documents as bulk
from ledgerline.streaming import micro_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as application events: the payload's number is the tokens, values of 50 or more have failed."""
    k = F.get_json_object("props", "$.k").cast("int")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("event_time"),
        F.col("user_id"),
        "event_type",
        F.col("event_type").alias("route"),
        F.when(F.col("value") >= 50, 500).otherwise(200).alias("status_code"),
        F.col("value").alias("latency_ms"),
        F.concat(F.lit("model_"), k % 4).alias("model_name"),
        k.alias("prompt_tokens"),
        F.when(k % 3 != 0, k).alias("completion_tokens"),
        F.col("value").cast("decimal(12,6)").alias("total_cost_usd"),
    )


APP = """(SELECT event_id AS id, ts AS event_time, user_id, event_type, event_type AS route, CASE WHEN value >= 50 THEN 500 ELSE 200 END AS status_code,
 value AS latency_ms, 'model_' || (k % 4) AS model_name, k AS prompt_tokens, CASE WHEN k % 3 <> 0 THEN k END AS completion_tokens,
 CAST(value AS DECIMAL(12,6)) AS total_cost_usd FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as cars: nation, segment and priority for city, warehouse and brand, status letters for the three states."""
    orders, customer, nation = (read(spark, sf_dir, n) for n in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)
    status = F.when(F.col("o_orderstatus") == "F", "available").when(F.col("o_orderstatus") == "O", "reserved").otherwise("maintenance")
    return joined.select(
        F.col("n_name").alias("city"), F.col("c_mktsegment").alias("warehouse_name"), F.col("o_orderpriority").alias("brand"), status.alias("stock_status"),
        F.col("o_totalprice").alias("price_usd"), F.year("o_orderdate").alias("model_year"), F.col("o_orderkey").alias("id"),
    )


CARS = """(SELECT n_name AS city, c_mktsegment AS warehouse_name, o_orderpriority AS brand,
 CASE o_orderstatus WHEN 'F' THEN 'available' WHEN 'O' THEN 'reserved' ELSE 'maintenance' END AS stock_status,
 o_totalprice AS price_usd, CAST(year(o_orderdate) AS INT) AS model_year, o_orderkey AS id
 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("metric_name"), F.col("props").alias("labels_json"), F.sha2("props", 256).alias("fingerprint"), F.col("ts").alias("sample_time"), "value", "event_id"
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("source_name"), F.concat(F.lit("events-"), F.date_format("ts", "yyyy.MM.dd")).alias("index_name"), F.col("event_id").cast("string").alias("document_id"),
        F.col("ts").alias("event_time"), F.col("ts").alias("ingest_time"), F.col("props").alias("document_json"), F.col("event_id").alias("version"),
    )


def ntz(df: DataFrame, *names: str) -> DataFrame:
    """Times without a zone, as the tables have them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def mean_sql(value: str, digits: int) -> str:
    return f"CAST(round(CAST(CAST(sum(CAST({value} AS DECIMAL(28,6))) AS DOUBLE) / nullif(count({value}), 0) AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


@query(f"""SELECT date_trunc('hour', event_time) AS hour, event_type, count(*) AS events, count(DISTINCT user_id) AS users,
 {mean_sql("latency_ms", 6)} AS avg_latency_ms, CAST(sum(total_cost_usd) AS DECIMAL(22,6)) AS total_cost_usd FROM {APP} GROUP BY 1, 2""")
def event_summary_hourly(spark, sf_dir):
    return ntz(views.event_summary(app_events(spark, sf_dir), F.col("event_time")), "hour")


@query(f"""SELECT city, warehouse_name, brand, count(*) AS cars, count(*) FILTER (stock_status = 'available') AS available_cars,
 count(*) FILTER (stock_status = 'reserved') AS reserved_cars, count(*) FILTER (stock_status = 'maintenance') AS maintenance_cars,
 {mean_sql("price_usd", 2)} AS avg_price_usd, min(model_year) AS oldest_model_year, max(model_year) AS newest_model_year FROM {CARS} GROUP BY 1, 2, 3""")
def inventory_summary(spark, sf_dir):
    return views.inventory_summary(inventory(spark, sf_dir))


@query(f"""SELECT date_trunc('minute', ts) AS minute, event_type AS metric_name, count(*) AS samples, min(value) AS min_value, max(value) AS max_value,
 {mean_sql("value", 6)} AS avg_value, CAST(CAST(quantile_cont(value, 0.95) AS DECIMAL(38,6)) AS DOUBLE) AS p95_value FROM events GROUP BY 1, 2""")
def metric_minute_summary(spark, sf_dir):
    return ntz(views.metric_summary(samples(spark, sf_dir)), "minute")


@query(f"""SELECT coalesce(json_extract_string(props, '$.k'), '') AS k, max(ts) AS last_sample_time, arg_max(value, (ts, event_id)) AS last_value,
 min(value) AS min_value, {mean_sql("value", 6)} AS avg_value FROM events GROUP BY 1""")
def metric_targets_latest(spark, sf_dir):
    s = samples(spark, sf_dir)
    return s.groupBy(x.json_text(F.col("labels_json"), "$.k").alias("k")).agg(
        F.max("sample_time").alias("last_sample_time"),
        x.latest_value(F.col("value"), F.col("sample_time"), F.col("event_id")).alias("last_value"),
        F.min("value").alias("min_value"),
        x.exact_mean(F.col("value"), 6).alias("avg_value"),
    )


@query("""SELECT event_type AS source_name, 'events-' || strftime(ts, '%Y.%m.%d') AS index_name, count(*) AS documents, min(ts) AS first_event_time,
 max(ts) AS last_event_time, max(ts) AS last_ingest_time FROM events GROUP BY 1, 2""")
def document_index_summary(spark, sf_dir):
    return views.index_summary(documents(spark, sf_dir))


@query("""SELECT date_trunc('hour', ts) AS hour, event_type AS source_name, 'events-' || strftime(ts, '%Y.%m.%d') AS index_name, count(*) AS documents
 FROM events GROUP BY 1, 2, 3""")
def document_timeline_hourly(spark, sf_dir):
    return ntz(views.document_timeline(documents(spark, sf_dir)), "hour")


@query("SELECT count(*) AS total_events FROM events")
def total_events(spark, sf_dir):
    return panels.total_events(app_events(spark, sf_dir))


@query("SELECT count(*) FILTER (event_type = 'error') AS errors FROM events")
def error_events(spark, sf_dir):
    return panels.error_events(app_events(spark, sf_dir))


@query("SELECT date_trunc('hour', ts) AS time, event_type, count(*) AS value FROM events WHERE ts IS NOT NULL GROUP BY 1, 2")
def events_by_type_over_time(spark, sf_dir):
    return ntz(panels.events_by_type_over_time(app_events(spark, sf_dir), F.col("event_time")), "time")


@query("SELECT event_type, count(*) AS value FROM events GROUP BY 1")
def event_type_share(spark, sf_dir):
    return panels.event_type_share(app_events(spark, sf_dir))


@query(f"SELECT id, event_time, user_id, event_type, route, model_name, status_code, latency_ms FROM {APP} ORDER BY id DESC LIMIT 50")
def latest_events(spark, sf_dir):
    return panels.latest_events(app_events(spark, sf_dir))


ROUTES = f"""SELECT route, count(*) AS events, count(DISTINCT user_id) AS users, count(*) FILTER (status_code >= 400) AS errors,
 {mean_sql("latency_ms", 2)} AS avg_latency_ms, CAST(CAST(quantile_cont(latency_ms, 0.95) AS DECIMAL(38,6)) AS DOUBLE) AS p95_latency_ms,
 CAST(round(CAST(count(*) FILTER (status_code >= 400) AS DOUBLE) / count(*), 4) AS DOUBLE) AS error_rate FROM {APP} WHERE route IS NOT NULL GROUP BY route"""


@query(f"SELECT route, error_rate, events, errors, avg_latency_ms, p95_latency_ms FROM ({ROUTES})")
def problem_routes(spark, sf_dir):
    return panels.problem_routes(app_events(spark, sf_dir))


@query(ROUTES)
def problem_routes_detail(spark, sf_dir):
    return panels.problem_route_details(app_events(spark, sf_dir))


@query(f"""SELECT model_name, CAST(sum(total_cost_usd) AS DECIMAL(22,6)) AS total_cost_usd,
 CAST(sum(coalesce(prompt_tokens, 0) + coalesce(completion_tokens, 0)) AS BIGINT) AS total_tokens, {mean_sql("latency_ms", 2)} AS avg_latency_ms
 FROM {APP} WHERE model_name IS NOT NULL GROUP BY 1""")
def model_cost(spark, sf_dir):
    return panels.model_cost(app_events(spark, sf_dir))


@query('SELECT o_orderpriority AS value, count(*) AS "rows" FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100')
def distinct_values(spark, sf_dir):
    return catalog.distinct_values(read(spark, sf_dir, "orders"), "o_orderpriority")


@query("""SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS "rows" FROM lineitem WHERE l_linestatus = 'O' AND l_quantity >= 10 AND l_discount < 0.05
 GROUP BY 1, 2, 3 ORDER BY 4 DESC, 1, 2, 3 LIMIT 100""")
def count_by_3dims_filtered(spark, sf_dir):
    compare = [{"column": "l_quantity", "operator": "gte", "value": 10}, {"column": "l_discount", "operator": "<", "value": 0.05}]
    return catalog.count_by(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"], {"l_linestatus": "O"}, compare)


@query("SELECT DISTINCT o_orderstatus FROM orders")
def distinct_sorted(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderstatus").distinct().orderBy("o_orderstatus")


@query(f"SELECT city, count(*) AS cars, count(*) FILTER (stock_status = 'available') AS available_cars FROM {CARS} GROUP BY 1")
def summary_rollup_sum(spark, sf_dir):
    summary = views.inventory_summary(inventory(spark, sf_dir))
    return summary.groupBy("city").agg(F.sum("cars").alias("cars"), F.sum("available_cars").alias("available_cars"))


PROFILED = {"customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]}
PROFILE = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS "rows", count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS distinct_values,
 CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM {t}"""
    for t, columns in PROFILED.items()
    for c in columns
)


@query(PROFILE)
def table_profile(spark, sf_dir):
    found = [catalog.profile(read(spark, sf_dir, t), columns).select(F.lit(t).alias("table"), "*") for t, columns in PROFILED.items()]
    return found[0].unionByName(found[1])


@query("SELECT event_type, count(*) AS n FROM events WHERE value > 100 GROUP BY 1")
def run_query_guarded(spark, sf_dir):
    read(spark, sf_dir, "events").createOrReplaceTempView("guarded_events")
    text = "WITH big AS (SELECT * FROM guarded_events WHERE value > :least) SELECT event_type, count(*) AS n FROM big GROUP BY event_type;"
    return guarded.run_query(spark, text, {"least": 100})


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1")
def latest_version_per_key(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return versions.latest_by_key(o, ["o_custkey"], "o_orderdate", "o_orderkey")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def checkpoint_latest(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
    return o.orderBy(F.desc_nulls_last("o_orderdate"), F.desc_nulls_last("o_orderkey")).limit(1).select("o_orderkey", "o_orderdate")


@query("""SELECT event_id, sha256('{"event_type":' || to_json(event_type) || ',"k":' || to_json(json_extract_string(props, '$.k')) || '}') AS fingerprint,
 upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 17)) AS vin FROM events""")
def fingerprint(spark, sf_dir):
    labels = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("event_type"), F.col("event_type"))
    e = read(spark, sf_dir, "events")
    return e.select("event_id", x.fingerprint(x.canonical_labels(labels)).alias("fingerprint"), F.upper(F.substring(F.md5(F.col("event_id").cast("string")), 1, 17)).alias("vin"))


@query("SELECT coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k, coalesce(json_extract_string(props, '$.none'), '') AS none, count(*) AS n FROM events GROUP BY 1, 2")
def json_extract_group(spark, sf_dir):
    e, p = read(spark, sf_dir, "events"), F.col("props")
    return e.groupBy(x.json_int(p, "$.k").alias("k"), x.json_text(p, "$.none").alias("none")).agg(F.count("*").alias("n"))


@query("SELECT event_id, ts, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'")
def half_open_interval(spark, sf_dir):
    return filters.between(read(spark, sf_dir, "events"), "ts", "2024-01-10 00:00:00", "2024-01-12 00:00:00").select("event_id", "ts", "event_type")


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-20' AND ts >= TIMESTAMP '2024-01-05' GROUP BY 1, 2")
def stream_microbatch_equiv(spark, sf_dir):
    """Micro-batches from checkpoint to checkpoint, each with an overlap, into a table whose versions make them one load."""
    e = read(spark, sf_dir, "events").where(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz"))
    source = e.withColumns({"document_id": F.col("event_id").cast("string"), "ts": F.col("ts").cast("timestamp")})
    path, offsets = fresh_path(spark, "micro-batches"), spark.createDataFrame([], OFFSETS)
    for run, end in enumerate((datetime(2024, 1, 9, 12), datetime(2024, 1, 15), datetime(2024, 1, 20))):
        put = lambda batch, run=run: batch.withColumn("version", F.lit(run)).write.mode("append").parquet(path)
        lookback = timedelta(days=5) if not run else micro_batches.LOOKBACK
        offsets = micro_batches.run_micro_batch(source, offsets, end, put, "events", "hourly", "ts", lookback=lookback)
    loaded = versions.latest_by_key(spark.read.parquet(path), ["event_id"], "version")
    return ntz(loaded.groupBy(x.hour(F.col("ts")).alias("hour"), "event_type").agg(F.count("*").alias("n")), "hour")


@query("SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def tumbling_5m(spark, sf_dir):
    return ntz(micro_batches.tumbling(read(spark, sf_dir, "events"), "ts", "5 minutes", ["event_type"]), "window_start")


@query("SELECT event_type, count(*) AS n FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOURS GROUP BY 1")
def anchored_last_24h(spark, sf_dir):
    return filters.recent(read(spark, sf_dir, "events"), "ts", "24 hours").groupBy("event_type").agg(F.count("*").alias("n"))


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
 WHERE rn = 1 AND o_orderstatus <> 'P'""")
def cdc_current_state(spark, sf_dir):
    """Orders as the changes of a customer's row; status P deletes it."""
    log = read(spark, sf_dir, "orders").withColumn("__deleted", (F.col("o_orderstatus") == "P").cast("string"))
    return versions.current_state(log, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


INCIDENT_ROWS = [("error", "night", 120, 240), ("error", "noon", 700, 760), ("click", "morning", 480, 600), ("error", "long", 700, 900)]
INCIDENTS_SQL = "(VALUES " + ", ".join(f"({i}, '{a}', '{b}', {c}, {d})" for i, (a, b, c, d) in enumerate(INCIDENT_ROWS)) + ") AS t(place, event_type, incident, start, stop)"


@query(f"""SELECT event_id, incident FROM (SELECT event_id, incident, row_number() OVER (PARTITION BY event_id ORDER BY place) AS rn FROM events e LEFT JOIN {INCIDENTS_SQL}
 ON e.event_type = t.event_type AND hour(ts) * 60 + minute(ts) BETWEEN start AND stop) WHERE rn = 1""")
def incident_interval_join(spark, sf_dir):
    incidents = joins.numbered(INCIDENT_ROWS, "event_type string, incident string, start int, stop int", spark)
    at = F.hour("ts") * 60 + F.minute("ts")
    found = joins.first_interval(read(spark, sf_dir, "events"), F.broadcast(incidents), "event_type", at, "start", "stop", "place")
    return found.select("event_id", "incident")


@query("""SELECT p_partkey, color, city FROM part JOIN (VALUES (0,'White'),(1,'Black'),(2,'Silver')) AS c(i, color) ON p_partkey % 3 = c.i
 JOIN (VALUES (0,'Tokyo'),(1,'Moscow')) AS d(j, city) ON p_size % 2 = d.j""")
def numbered_dim_join(spark, sf_dir):
    colors = joins.numbered([("White",), ("Black",), ("Silver",)], "color string", spark).withColumnRenamed("place", "i")
    cities = joins.numbered([("Tokyo",), ("Moscow",)], "city string", spark).withColumnRenamed("place", "j")
    parts = read(spark, sf_dir, "part").withColumns({"i": (F.col("p_partkey") % 3).cast("int"), "j": F.col("p_size") % 2})
    return parts.join(F.broadcast(colors), "i").join(F.broadcast(cities), "j").select("p_partkey", "color", "city")


@query("""SELECT CASE WHEN l_quantity >= 40 THEN 'large' WHEN l_quantity >= 20 THEN 'medium' ELSE 'small' END AS bucket, count(*) AS n,
 CAST(sum(CAST(l_extendedprice AS DECIMAL(28,6))) AS DOUBLE) AS price FROM lineitem GROUP BY 1""")
def case_status_buckets(spark, sf_dir):
    bucket = F.when(F.col("l_quantity") >= 40, "large").when(F.col("l_quantity") >= 20, "medium").otherwise("small")
    return read(spark, sf_dir, "lineitem").groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), x.exact_sum(F.col("l_extendedprice")).alias("price"))


@query("""SELECT doc_id, CAST(c AS INT) AS chunk_no, substr(text, CAST(c * 1400 + 1 AS BIGINT), 1500) AS chunk
 FROM (SELECT doc_id, text, unnest(range(0, greatest(1, CAST(ceil((length(text) - 100) / 1400.0) AS BIGINT)))) AS c FROM documents)""")
def chunk_documents(spark, sf_dir):
    return corpus.chunks(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("SELECT doc_id AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def manifest_removed(spark, sf_dir):
    files, manifest = (read(spark, sf_dir, n).select(F.col("doc_id").alias("path")) for n in ("labels", "documents"))
    return corpus.removed(files, manifest)


@query("""SELECT coalesce(f.path, m.path) AS path, CASE WHEN m.path IS NULL THEN 'new' WHEN f.path IS NULL THEN 'removed' WHEN f.s = m.s THEN 'unchanged' ELSE 'changed' END AS state
 FROM (SELECT doc_id AS path, sha256(text) AS s FROM documents) f
 FULL JOIN (SELECT l.doc_id AS path, sha256(CASE WHEN quality = 0 THEN text || '!' ELSE text END) AS s FROM labels l JOIN documents d ON l.doc_id = d.doc_id
 UNION ALL SELECT -1 - item_id, sha256(text) FROM benchmark) m ON f.path = m.path""")
def manifest_classified(spark, sf_dir):
    """Documents against what was known of them: the labelled ones, those of low quality with another text, and passages that are no documents."""
    d, labels, benchmark = (read(spark, sf_dir, n) for n in ("documents", "labels", "benchmark"))
    path = F.col("doc_id").alias("path")
    old = F.when(F.col("quality") == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    known = d.join(labels.select("doc_id", "quality"), "doc_id").select(path, F.sha2(old, 256).alias("sha256"))
    gone = benchmark.select((-1 - F.col("item_id")).alias("path"), F.sha2("text", 256).alias("sha256"))
    return corpus.manifest_diff(d.select(path, F.sha2("text", 256).alias("sha256")), known.unionByName(gone))


@query("""SELECT vec_id, CAST(round(CAST(list_sum(list_transform(list_zip(embedding, q), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE)))
 / (sqrt(list_sum(list_transform(embedding, lambda a: CAST(a AS DOUBLE) * CAST(a AS DOUBLE)))) * sqrt(list_sum(list_transform(q, lambda a: CAST(a AS DOUBLE) * CAST(a AS DOUBLE))))) AS DECIMAL(38,6)), 4) AS DOUBLE) AS similarity
 FROM embeddings, (SELECT embedding AS q FROM embeddings WHERE vec_id = 0) ORDER BY 2 DESC, 1 LIMIT 10""")
def embedding_topk(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings")
    return corpus.nearest(v, v.where("vec_id = 0").select("embedding").scalar(), 10)


@query("""SELECT event_id, CASE WHEN value >= prev THEN value - prev WHEN prev IS NOT NULL THEN value END AS increase
 FROM (SELECT *, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events)""")
def counter_rate_lag(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return series.increases(e, ["user_id", "event_type"], "ts", "value", ["event_id"]).select("event_id", "increase")


@query("""SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS events FROM (
 SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
 SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTES THEN 1 ELSE 0 END AS fresh FROM events)) GROUP BY user_id, s""")
def session_30m(spark, sf_dir):
    return ntz(series.sessions(read(spark, sf_dir, "events"), "user_id", "ts"), "session_start", "last_event")


@query("SELECT p_partkey, count(l_orderkey) AS lines FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1")
def left_join_counts(spark, sf_dir):
    part, line = read(spark, sf_dir, "part"), read(spark, sf_dir, "lineitem")
    lines = line.groupBy("l_partkey").agg(F.count("l_orderkey").alias("lines"))
    return part.join(lines, part.p_partkey == lines.l_partkey, "left").select("p_partkey", F.coalesce("lines", F.lit(0)).cast("bigint").alias("lines"))


@query("SELECT s_suppkey, c_custkey FROM supplier FULL JOIN customer ON s_suppkey = c_custkey")
def full_join_keys(spark, sf_dir):
    s, c = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "customer")
    return s.select("s_suppkey").join(c.select("c_custkey"), s.s_suppkey == c.c_custkey, "full")


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus IN ('O', 'P'))")
def semi_join_customers(spark, sf_dir):
    c, o = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("O", "P"))
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey", "c_name")


@query("""SELECT e.event_id, v.value AS last_view FROM (SELECT * FROM events WHERE event_type = 'purchase') e
 ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON e.user_id = v.user_id AND e.ts >= v.ts""")
def asof_join(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    bought = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = e.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("value").alias("last_view"))
    return joins.as_of(bought, seen, "user_id", "ts", ["last_view"]).select("event_id", "last_view")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(28,6))) AS DOUBLE) AS quantity FROM lineitem
 GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_returns(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), x.exact_sum(F.col("l_quantity")).alias("quantity"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority) HAVING count(*) > 10")
def cube_having(spark, sf_dir):
    return read(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n")).where("n > 10")


@query("""SELECT c_nationkey AS nation, 'both' AS side FROM customer INTERSECT SELECT s_nationkey, 'both' FROM supplier
 UNION ALL (SELECT c_nationkey, 'customer' FROM customer EXCEPT SELECT s_nationkey, 'customer' FROM supplier)""")
def set_operations(spark, sf_dir):
    c, s = read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")), read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return c.intersect(s).withColumn("side", F.lit("both")).unionAll(c.subtract(s).withColumn("side", F.lit("customer")))


@query("""SELECT o_orderkey, rank() OVER w AS rank, dense_rank() OVER w AS dense, ntile(4) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS quarter,
 first_value(o_orderkey) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS best FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_orderdate)""")
def ranking_windows(spark, sf_dir):
    """Ranks inside three large groups, whose rows stay in many tasks."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    by_date = ranking.value_ranks(o, "o_orderstatus", "o_orderdate")
    best = o.groupBy("o_orderstatus").agg(F.min_by("o_orderkey", F.struct(-F.col("o_totalprice"), "o_orderkey")).alias("best"))
    placed = ranking.places(o, "o_orderstatus", "o_totalprice", "o_orderkey", descending=True)
    return placed.join(by_date, ["o_orderstatus", "o_orderdate"]).join(best, "o_orderstatus").select("o_orderkey", "rank", "dense", ranking.tile(4).cast("bigint").alias("quarter"), "best")


@query(f"SELECT brand, {mean_sql('price_usd', 2)} AS avg_price_usd FROM {CARS} GROUP BY 1")
def mean_price_by_brand(spark, sf_dir):
    return inventory(spark, sf_dir).groupBy("brand").agg(x.exact_mean(F.col("price_usd")).alias("avg_price_usd"))


@query(f"SELECT id, city, brand, price_usd FROM {CARS} ORDER BY price_usd DESC, id LIMIT 10")
def most_expensive(spark, sf_dir):
    return inventory(spark, sf_dir).select("id", "city", "brand", "price_usd").orderBy(F.desc_nulls_last("price_usd"), "id").limit(10)


@query(f"SELECT warehouse_name, count(*) AS cars FROM {CARS} WHERE model_year <= 1996 GROUP BY 1")
def old_models_by_warehouse(spark, sf_dir):
    cars = inventory(spark, sf_dir)
    kept = cars.where(filters.conditions(cars, compare=[{"column": "model_year", "operator": "lte", "value": 1996}]))
    return kept.groupBy("warehouse_name").agg(F.count("*").alias("cars"))


@query(f"SELECT city, brand, count(*) AS cars, {mean_sql('price_usd', 2)} AS avg_price_usd FROM {CARS} GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20")
def load_summary_top20(spark, sf_dir):
    grouped = inventory(spark, sf_dir).groupBy("city", "brand").agg(F.count("*").alias("cars"), x.exact_mean(F.col("price_usd")).alias("avg_price_usd"))
    return grouped.orderBy(F.desc("cars"), "city", "brand").limit(20)


@query(f"SELECT city, warehouse_name, count(*) AS cars FROM {CARS} WHERE brand = '1-URGENT' GROUP BY 1, 2")
def brand_by_city_and_warehouse(spark, sf_dir):
    return inventory(spark, sf_dir).where("brand = '1-URGENT'").groupBy("city", "warehouse_name").agg(F.count("*").alias("cars"))


@query(f"SELECT city, stock_status, {mean_sql('price_usd', 2)} AS avg_price_usd FROM {CARS} GROUP BY 1, 2")
def mean_price_by_city_and_status(spark, sf_dir):
    return inventory(spark, sf_dir).groupBy("city", "stock_status").agg(x.exact_mean(F.col("price_usd")).alias("avg_price_usd"))


@query("""SELECT event_id, user_id, event_type, value, CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS "__deleted" FROM events""")
def cdc_flatten(spark, sf_dir):
    """Events as change envelopes with JSON images, flattened again; errors are deletes, whose image is the one before."""
    e = read(spark, sf_dir, "events")
    image, gone = F.to_json(F.struct("event_id", "user_id", "event_type", "value")), F.col("event_type") == "error"
    envelopes = e.select(F.when(gone, "d").otherwise("c").alias("op"), F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"), F.unix_micros(F.col("ts").cast("timestamp")).alias("lsn"))
    schema = table_from_source([("event_id", "bigint", False), ("user_id", "bigint", False), ("event_type", "text", False), ("value", "double precision", False)])
    return changes.flat_rows(envelopes, schema).drop("__order")


@query("""SELECT event_id, user_id, event_type, CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END AS "__deleted" FROM events""")
def cdc_flatten_documents(spark, sf_dir):
    """The same for documents: images are JSON texts with typed values, in quotes or as they are; views are updates, errors deletes with the image before."""
    document = F.format_string('{"event_id":{"$numberLong":"%d"},"user_id":{"$numberLong":"%d"},"event_type":"%s"}', "event_id", "user_id", "event_type")
    quoted = F.concat(F.lit('"'), F.replace(document, F.lit('"'), F.lit('\\"')), F.lit('"'))
    image, kind = F.when(F.col("event_id") % 2 == 0, quoted).otherwise(document), F.col("event_type")
    gone, old = kind == "error", F.when(kind.isin("view", "error"), image)
    op = F.when(gone, "d").when(kind == "view", "u").when(kind == "click", "r").otherwise("c")
    envelopes = read(spark, sf_dir, "events").select(op.alias("op"), old.alias("before"), F.when(~gone, image).alias("after"), F.unix_micros(F.col("ts").cast("timestamp")).alias("lsn"))
    schema = table_from_source([("event_id", "bigint", False), ("user_id", "bigint", False), ("event_type", "text", False)])
    return changes.document_rows(envelopes, schema).select("event_id", "user_id", "event_type", "__deleted")


@query("""SELECT event_type AS metric_name, '{"__name__":' || to_json(event_type) || ',"k":' || to_json(json_extract_string(props, '$.k')) || '}' AS labels_json,
 date_trunc('millisecond', ts) AS sample_time, value FROM events""")
def remote_write_rows(spark, sf_dir):
    """Events encoded as compressed write requests, one for each series and hour, and decoded again."""
    e = read(spark, sf_dir, "events")
    labels = F.create_map(F.lit("__name__"), F.col("event_type"), F.lit("k"), F.get_json_object("props", "$.k"))
    point = F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), "value")
    grouped = e.groupBy("event_type", F.get_json_object("props", "$.k").alias("k"), x.hour(F.col("ts"))).agg(F.any_value(labels).alias("labels"), F.collect_list(point).alias("samples"))
    rows = metrics.sample_rows(metrics.pushed_series(metrics.write_payloads(grouped)))
    return ntz(rows.select("metric_name", "labels_json", "sample_time", "value"), "sample_time")


@query("""SELECT event_type AS metric_name, '{"__name__":' || to_json(event_type) || ',"k":' || to_json(json_extract_string(props, '$.k')) || ',"note":"a\\\\b\\"c\\nd"}' AS labels_json,
 date_trunc('second', ts) AS sample_time, value FROM events""")
def exposition_text(spark, sf_dir):
    """Events as lines of exposition text, with what must be escaped in a label, and read again."""
    e = read(spark, sf_dir, "events")
    labels = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("note"), F.lit('a\\b"c\nd'), F.lit("none"), F.lit(""))
    lines = metrics.exposition_lines(e.select(F.col("event_type").alias("metric_name"), labels.alias("labels"), "value", F.col("ts").alias("sample_time")))
    return ntz(metrics.exposition_rows(lines).select("metric_name", "labels_json", "sample_time", "value"), "sample_time")


@query("""SELECT 'events-' || strftime(ts, '%Y.%m.%d') AS index_name, CAST(event_id AS VARCHAR) AS document_id, date_trunc('second', ts) AS event_time, props AS document_json FROM events""")
def bulk_documents(spark, sf_dir):
    """Events written as a bulk file, actions in three spellings and documents that hold the text of one, and read again."""
    e = read(spark, sf_dir, "events")
    start = F.get(F.array(*(F.lit(a) for a in ('{"index":{', '{ "create" : {', '{ "index": { '))), (F.col("event_id") % 3).cast("int"))
    action = F.concat(start, F.format_string('"_index":"events-%s","_id":"%d"}}', F.date_format("ts", "yyyy.MM.dd"), "event_id"))
    document = F.concat(F.lit('{"@timestamp":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('","es":{"index":{"_id":5}},"props":'), F.col("props"), F.lit("}"))
    path = fresh_path(spark, "bulk")
    e.select(F.concat(action, F.lit("\n"), document).alias("value")).write.text(path)
    rows = bulk.hit_rows(bulk.bulk_hits(spark, path), "bulk", 1)
    return ntz(rows.select("index_name", "document_id", "event_time", F.get_json_object("document_json", "$.props").alias("document_json")), "event_time").withColumn(
        "document_json", F.regexp_replace("document_json", ":", ": ")
    )


@query("""SELECT event_type, user_id, count(*) AS samples, CAST(round(CAST(sum(CAST(increase AS DECIMAL(28,6))) AS DOUBLE), 3) AS DOUBLE) AS gained FROM (
 SELECT event_type, user_id, CASE WHEN value >= prev THEN value - prev WHEN prev IS NOT NULL THEN value END AS increase
 FROM (SELECT *, lag(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS prev FROM events)) GROUP BY 1, 2""")
def counter_gain_by_series(spark, sf_dir):
    grown = series.increases(read(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "value", ["event_id"])
    return grown.groupBy("event_type", "user_id").agg(F.count("*").alias("samples"), F.round(x.exact_sum(F.col("increase")), 3).alias("gained"))


def service_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples of services: the type is the service, the user its instance, values under 90 are up; the gauge and the counter are the value."""
    e = read(spark, sf_dir, "events")
    labels = F.create_map(F.lit("job"), F.lit("events"), F.lit("service"), F.col("event_type"), F.lit("instance"), F.concat("event_type", F.lit(":"), F.col("user_id").cast("string")))
    metric = F.explode(
        F.array(
            F.struct(F.lit("synthetic_service_up").alias("name"), (F.col("value") < 90).cast("double").alias("value")),
            F.struct(F.lit("synthetic_db_connections").alias("name"), F.col("value")),
            F.struct(F.lit("synthetic_http_requests_total").alias("name"), F.col("value")),
        )
    )
    spread = e.select(F.col("ts").cast("timestamp").alias("ts"), labels.alias("labels"), metric.alias("m"))
    named = F.map_concat("labels", F.create_map(F.lit("__name__"), F.col("m.name")))
    return metrics.sample_rows(spread.select(named.alias("labels"), F.unix_millis("ts").alias("timestamp"), F.col("m.value").alias("value")), "backfill")


#: Events of the last day of the data, at the milliseconds that samples have.
LAST_DAY = "(SELECT *, date_trunc('millisecond', ts) AS moment FROM events WHERE date_trunc('millisecond', ts) > (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 24 HOURS)"


#: What a service has samples of by themselves.
ROUTES, LEVELS = ("/list", "/item", "/order"), ("error", "warn", "info")


def family_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as moments of a service and its database: 23 samples of ten families each, as many of a family as a service and a database of the metric scenario have in a minute."""
    value, failed = F.col("value"), F.col("value") >= 90

    def sample(name: str, reading: Column, **labels: str) -> Column:
        own = F.create_map(*(F.lit(x) for pair in {"__name__": f"synthetic_{name}", **labels}.items() for x in pair))
        return F.struct(own.alias("own"), reading.cast("double").alias("value"))

    made = [
        *(sample("service_up", ~failed, component_kind=kind) for kind in ("db", "service")),
        sample("incident_active", failed, severity="critical"),
        sample("db_connections", value, state="active"),
        sample("db_query_duration_seconds_p95", value / 1000),
        sample("db_replication_lag_seconds", F.when(failed, 180).otherwise(value / 10)),
        sample("db_disk_usage_ratio", F.least(value / 100, F.lit(0.98)), mount="/var/lib/data"),
        *(sample("process_restarts_total", F.when(failed, value).otherwise(0), component_kind=kind) for kind in ("db", "service")),
        *(sample("log_events_total", value, component_kind="service", level=level) for level in LEVELS),
        *(sample("log_events_total", value, component_kind="db", level=level) for level in ("error", "info")),
        *(sample("http_requests_total", value, route=route, status_class=status) for route in ROUTES for status in ("2xx", "5xx")),
        *(sample("http_request_duration_seconds_p95", value / 1000, route=route) for route in ROUTES),
    ]
    common = F.create_map(F.lit("job"), F.lit("events"), F.lit("service"), F.col("event_type"), F.lit("instance"), F.concat("event_type", F.lit(":"), F.col("user_id").cast("string")))
    spread = read(spark, sf_dir, "events").select(F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), common.alias("common"), F.explode(F.array(*made)).alias("s"))
    return metrics.sample_rows(spread.select(F.map_concat("common", "s.own").alias("labels"), "timestamp", F.col("s.value").alias("value")), "backfill")


@query("""SELECT 'synthetic_' || name AS metric_name, CAST(sum(n) AS BIGINT) AS samples FROM events, (VALUES ('service_up', 2), ('incident_active', 1), ('db_connections', 1),
 ('db_query_duration_seconds_p95', 1), ('db_replication_lag_seconds', 1), ('db_disk_usage_ratio', 1), ('process_restarts_total', 2),
 ('log_events_total', 5), ('http_requests_total', 6), ('http_request_duration_seconds_p95', 3)) m(name, n) GROUP BY 1""")
def metric_families(spark, sf_dir):
    return family_samples(spark, sf_dir).groupBy("metric_name").agg(F.count("*").alias("samples"))


@query(f"""SELECT event_type || ':' || user_id AS instance, event_type AS service, moment AS "at", CASE WHEN up THEN 'up' ELSE 'down' END AS state FROM (
 SELECT *, value < 90 AS up, lag(value < 90) OVER (PARTITION BY event_type, user_id ORDER BY moment) AS before FROM {LAST_DAY}) WHERE before <> up""")
def targets_down_and_up(spark, sf_dir):
    return ntz(views.transitions(service_samples(spark, sf_dir)), "at")


@query(f"SELECT event_type AS service, {mean_sql('CASE WHEN value < 90 THEN 1 ELSE 0 END', 4)} AS availability, count(*) AS samples FROM {LAST_DAY} GROUP BY 1")
def availability_by_service(spark, sf_dir):
    return views.availability(service_samples(spark, sf_dir), "24 hours")


@query(f"SELECT event_type AS service, max(value) AS highest, {mean_sql('value', 6)} AS mean, count(*) AS samples FROM {LAST_DAY} GROUP BY 1")
def connections_by_service(spark, sf_dir):
    return views.gauge_by(service_samples(spark, sf_dir), "synthetic_db_connections", "service", "24 hours").select("service", "highest", "mean", "samples")


@query(f"""SELECT event_type AS service, CAST(round(sum(CAST(gain AS DECIMAL(28,6))), 3) AS DOUBLE) AS gained, count(*) AS samples FROM (
 SELECT event_type, CASE WHEN value >= before THEN value - before ELSE CASE WHEN before IS NOT NULL THEN value END END AS gain FROM (
 SELECT *, lag(value) OVER (PARTITION BY event_type, user_id ORDER BY moment) AS before FROM {LAST_DAY})) GROUP BY 1""")
def requests_by_service(spark, sf_dir):
    return views.counter_by(service_samples(spark, sf_dir), "synthetic_http_requests_total", "service", "24 hours")


@query("""SELECT event_type AS metric_name, user_id, moment, value FROM (SELECT *, date_trunc('millisecond', ts) AS moment,
 row_number() OVER (PARTITION BY event_type ORDER BY date_trunc('millisecond', ts) DESC, sha256('{"__name__":' || to_json(event_type) || ',"user":' || to_json(CAST(user_id AS VARCHAR)) || '}')) AS rn FROM events) WHERE rn <= 5""")
def latest_samples(spark, sf_dir):
    """The latest five samples of each metric."""
    e = read(spark, sf_dir, "events")
    labels = F.create_map(F.lit("__name__"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    made = metrics.sample_rows(e.select(labels.alias("labels"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), "value"))
    found = views.latest_samples(made, 5)
    return ntz(found.select("metric_name", F.get_json_object("labels_json", "$.user").cast("bigint").alias("user_id"), F.col("sample_time").alias("moment"), "value"), "moment")
