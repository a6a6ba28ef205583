"""Queries over tables that are paged, pushed, streamed or replaced in place, each with the same query in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import expressions as x
from ledgerline.operators import corpus, sketches, tables, vector_index
from ledgerline.plans.queries import ntz, query, read
from ledgerline.session import fresh_path, written
from ledgerline.sources import keyed, metrics, paged, pushed, variants
from ledgerline.streaming import ledger, stateful


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def keyset_scan(spark, sf_dir):
    """All events, page by page, in time slices."""
    pages = paged.read_pages(spark, path=f"{sf_dir}/events.parquet", key="ts", id="event_id", slices="16", pagesize="5000")
    return pages.select("event_id", "ts", "user_id", "event_type", "value")


@query("SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'")
def keyset_range(spark, sf_dir):
    """The same with a range that becomes the slices' bounds."""
    pages = paged.read_pages(spark, path=f"{sf_dir}/events.parquet", key="ts", id="event_id", slices="8", pagesize="5000")
    inside = (F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-12").cast("timestamp_ntz"))
    return pages.where(inside).select("event_id", "ts", "value")


def series_of(events: DataFrame) -> DataFrame:
    """(labels, samples): a series for each type and payload number, cut by hours."""
    k = F.get_json_object("props", "$.k")
    labels = F.create_map(F.lit("__name__"), F.col("event_type"), F.lit("k"), k)
    point = F.struct(F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), "value")
    return events.groupBy("event_type", k.alias("k"), x.hour(F.col("ts"))).agg(F.any_value(labels).alias("labels"), F.collect_list(point).alias("samples"))


def landed(spark, stream: DataFrame, checkpoint: str, name: str) -> DataFrame:
    """What a stream of payloads holds now, loaded through a ledger."""
    book = ledger.Ledger(spark, fresh_path(spark, "pushed"), name)
    stream.writeStream.foreachBatch(book.append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return book.table(stream.schema)


@query("""SELECT event_type AS metric_name, '{"__name__":' || to_json(event_type) || ',"k":' || to_json(json_extract_string(props, '$.k')) || '}' AS labels_json,
 date_trunc('millisecond', ts) AS sample_time, value FROM events""")
def push_stream_rows(spark, sf_dir):
    """Events pushed as compressed write requests, read as a stream with its own offsets and decoded."""
    folder = fresh_path(spark, "landing")
    pushed.push_all(metrics.write_payloads(series_of(read(spark, sf_dir, "events"))), folder)
    payloads = landed(spark, pushed.pushed_stream(spark, folder), fresh_path(spark, "checkpoint"), "metrics")
    return ntz(metrics.sample_rows(metrics.pushed_series(payloads)).select("metric_name", "labels_json", "sample_time", "value"), "sample_time")


@query("SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS events, CAST(round(sum(CAST(value AS DECIMAL(28,6))), 3) AS DOUBLE) AS total FROM events GROUP BY 1, 2")
def exactly_once_batches(spark, sf_dir):
    """Events as a stream whose checkpoint is lost after a run: the second run brings the same batches again, the ledger keeps them out."""
    events = read(spark, sf_dir, "events")
    folder = fresh_path(spark, "events")
    events.repartitionByRange(6, "ts").write.parquet(folder)
    book = ledger.Ledger(spark, fresh_path(spark, "ledger"), "events")
    for _ in range(2):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(folder)
        stream.writeStream.foreachBatch(book.append).option("checkpointLocation", fresh_path(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    grouped = book.table(events.schema).groupBy("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    return grouped.agg(F.count("*").alias("events"), F.round(F.sum(F.col("value").cast("decimal(28,6)")), 3).cast("double").alias("total"))


@query("""SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
 SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
 WHERE rn = 1 AND o_orderstatus <> 'P' AND NOT (o_totalprice >= 50000 AND o_totalprice < 60000)""")
def keyed_upsert_state(spark, sf_dir):
    """Orders as versions of their customer's row, loaded by years into a keyed table; status P deletes a row, and then a range of prices goes."""
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    rows = orders.drop("o_orderstatus")
    table = keyed.KeyedTable(spark, fresh_path(spark, "keyed"), rows.schema, ["o_custkey"], 16)
    changes = orders.withColumn("gone", F.col("o_orderstatus") == "P")
    for after, upto in (("1900", "1994"), ("1994", "1996"), ("1996", "2100")):
        part = changes.where((F.col("o_orderdate") >= F.lit(f"{after}-01-01")) & (F.col("o_orderdate") < F.lit(f"{upto}-01-01")))
        table.upsert(part, "o_orderdate", "o_orderkey", deleted="gone")
    table.delete("o_totalprice", 50000, 60000)
    return table.read()


#: Rows that come when the others are there, as those of a device that was offline.
STRAGGLERS = "event_id % 40 = 7"


def arrivals(spark, sf_dir: str, run) -> None:
    """Events as they come in: those of the first days, of the others, the stragglers, and at last one row of a time far ahead. ``run`` takes the stream after each."""
    events = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value").where("ts is not null")
    folder = fresh_path(spark, "arrivals")
    half = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    end = events.agg((F.max("ts") + F.expr("interval 30 days")).alias("ts")).select(F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit(-1).cast("bigint").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"))
    known = events.where(~F.expr(STRAGGLERS))
    for part in (known.where(half), known.where(~half), events.where(STRAGGLERS), end):
        part.write.mode("append").parquet(folder)
        run(spark.readStream.schema(events.schema).parquet(folder))


def settled(spark, sf_dir: str, make, name: str) -> DataFrame:
    """What a stream of results holds when the events have come in, its query stopped and started again after each part."""
    checkpoint, out = fresh_path(spark, "checkpoint"), []
    book = ledger.Ledger(spark, fresh_path(spark, "stateful"), name)

    def run(stream: DataFrame) -> None:
        results = make(stream)
        writer = results.writeStream.outputMode("append").foreachBatch(book.append).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        stateful.started(spark, writer).awaitTermination()
        out[:] = [results.schema]

    arrivals(spark, sf_dir, run)
    return book.table(out[0])  # without the last row: the watermark never passes its time


#: The watermark when the stragglers come: whole milliseconds, ten minutes before the latest of the others.
_WATERMARK = f"(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTES FROM events WHERE NOT ({STRAGGLERS}))"
_LATE = f"({STRAGGLERS} AND ts < {_WATERMARK})"


@query(f"""SELECT 'session' AS kind, user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS events, NULL::BIGINT AS event_id FROM (
 SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
 SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTES THEN 1 ELSE 0 END AS fresh FROM events WHERE NOT {_LATE})) GROUP BY user_id, s
 UNION ALL SELECT 'late', user_id, NULL, NULL, NULL, event_id FROM events WHERE {_LATE}""")
def stream_sessions_and_late(spark, sf_dir):
    """Sessions of a stream by state and timers, and the rows that came too late for them."""
    found = settled(spark, sf_dir, lambda s: stateful.stream_sessions(s, "user_id", "ts", "event_id"), "sessions")
    return ntz(found.select("kind", F.col("key").cast("bigint").alias("user_id"), "session_start", "last_event", "events", F.col("id").alias("event_id")), "session_start", "last_event")


@query(f"""SELECT 'sample' AS kind, event_type, event_id, value, CASE WHEN value >= prev THEN value - prev WHEN prev IS NOT NULL THEN value END AS increase
 FROM (SELECT *, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM events WHERE NOT {_LATE} AND value IS NOT NULL)
 UNION ALL SELECT 'late', event_type, event_id, value, NULL FROM events WHERE {_LATE} AND value IS NOT NULL""")
def stream_counters_and_late(spark, sf_dir):
    """Gains of counters over a stream, resets among them, and the samples that came too late."""
    found = settled(spark, sf_dir, lambda s: stateful.stream_increases(s, "event_type", "ts", "event_id", "value"), "counters")
    return found.select("kind", F.col("key").alias("event_type"), F.col("id").alias("event_id"), "value", "increase")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(value) AS samples, true AS within FROM events WHERE value IS NOT NULL GROUP BY 1, 2")
def day_p95_from_minutes(spark, sf_dir):
    """Daily 95th percentiles merged from minute states; within says that the rank error over the raw rows is as stated."""
    events = read(spark, sf_dir, "events")
    kind, day = F.col("event_type"), F.date_trunc("day", "ts")
    minutes = written(sketches.quantile_states(events, {"event_type": kind, "minute": F.date_trunc("minute", "ts")}, "value"))
    days = sketches.merged_quantiles(minutes, {"event_type": kind, "day": F.date_trunc("day", "minute")})
    estimates = days.withColumn("p95", sketches.quantile(0.95))
    measured = sketches.rank_error(events, estimates, {"event_type": kind, "day": day}, "value", "p95", 0.95)
    return ntz(measured.select("day", "event_type", F.col("rows").alias("samples"), (F.col("error") <= sketches.ERROR).alias("within")), "day")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(DISTINCT user_id) AS users FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2")
def day_users_from_hours(spark, sf_dir):
    """Daily distinct users rolled up from hourly bitmaps."""
    events = read(spark, sf_dir, "events")
    hours = written(sketches.distinct_states(events, {"event_type": F.col("event_type"), "hour": F.date_trunc("hour", "ts")}, "user_id"))
    days = sketches.merged_distinct(hours, {"event_type": F.col("event_type"), "day": F.date_trunc("day", "hour")})
    return ntz(sketches.distinct_counts(days, ["day", "event_type"], "users"), "day")


_UNIT = "(SELECT vec_id, embedding AS e, sqrt(list_sum(list_transform(embedding, lambda a: CAST(a AS DOUBLE) * CAST(a AS DOUBLE)))) AS n FROM embeddings)"


@query(f"""SELECT query, id, similarity, place FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY similarity DESC, id) AS place FROM (
 SELECT q.vec_id AS query, v.vec_id AS id, round(list_sum(list_transform(list_zip(q.e, v.e), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) / (q.n * v.n), 4) AS similarity
 FROM {_UNIT} q, {_UNIT} v WHERE q.vec_id % 100 = 0)) WHERE place <= 10""")
def vector_search_exact(spark, sf_dir):
    """The ten nearest vectors of every hundredth one, against all of them."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = vector_index.VectorIndex(vectors, "vec_id", "embedding").search(vectors.where("vec_id % 100 = 0"), "vec_id", "embedding", 10, probes=None)
    return found.withColumn("place", F.col("place").cast("bigint"))


@query("SELECT count(*) AS queries, 10 * count(*) AS found, true AS recall_90 FROM embeddings WHERE vec_id % 100 = 0")
def vector_search_recall(spark, sf_dir):
    """The same by the nearest lists only, and whether at least nine in ten of the exact result are found."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index, asked = vector_index.VectorIndex(vectors, "vec_id", "embedding"), vectors.where("vec_id % 100 = 0")
    near = written(index.search(asked, "vec_id", "embedding", 10, probes=index.probes_for(asked, "vec_id", "embedding", 10)))
    exact = index.search(asked, "vec_id", "embedding", 10, probes=None).select(F.col("query"), F.col("id"), F.lit(1).alias("hit"))
    met = exact.join(near.select("query", "id", F.lit(1).alias("got")), ["query", "id"], "left")
    share = met.agg(F.avg(F.coalesce("got", F.lit(0))).alias("recall"))
    return near.agg(F.countDistinct("query").alias("queries"), F.count("*").alias("found")).select("queries", "found", (share.scalar() >= 0.9).alias("recall_90"))


@query("""SELECT event_id, event_type AS service, CAST(json_extract_string(props, '$.k') AS INT) AS status_code, CASE WHEN value >= 50 THEN 'ERROR' ELSE 'INFO' END AS level,
 NULL::VARCHAR AS city, event_id % 7 = 3 AS broken FROM events""")
def variant_fields(spark, sf_dir):
    """Events as log documents, some cut off, stored as variants; fields come from the stored table."""
    e = read(spark, sf_dir, "events")
    level = F.when(F.col("value") >= 50, "ERROR").otherwise("INFO")
    nested = F.struct(F.struct(F.col("event_type").alias("name")).alias("service"), F.struct(level.alias("level")).alias("log"), F.struct(F.get_json_object("props", "$.k").cast("int").alias("status_code")).alias("http"))
    text = F.to_json(nested)
    broken = F.col("event_id") % 7 == 3
    cut = F.when(broken, F.left(text, F.length(text) - 1)).otherwise(text)
    stored = written(variants.parsed(e.select("event_id", text.alias("whole"), cut.alias("document_json"))))
    again = variants.parsed(stored.where("document is null").select("event_id", F.col("whole").alias("document_json")))
    fields = ["event_id", "service", "status_code", "level", "city"]
    good = stored.where("document is not null").select(*fields, F.lit(False).alias("broken"))
    return good.unionByName(again.join(stored.where("document_text is not null").select("event_id"), "event_id", "left_semi").select(*fields, F.lit(True).alias("broken")))


@query("""SELECT c_custkey, c_name, o_orderkey, o_orderdate FROM customer, LATERAL (SELECT o_orderkey, o_orderdate FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 3)""")
def latest_three_orders(spark, sf_dir):
    customer, orders = read(spark, sf_dir, "customer").select("c_custkey", "c_name"), read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    found = tables.first_of_each(customer, orders, {"c_custkey": "o_custkey"}, [F.desc("o_orderdate"), F.desc("o_orderkey")], 3)
    return found.select("c_custkey", "c_name", "o_orderkey", "o_orderdate")


@query("""SELECT event_type AS receiver, json_extract_string(props, '$.k') AS k, CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp, value FROM events""")
def decoded_by_table_function(spark, sf_dir):
    """Write requests numbered by their receiver, one for each type, and each sent twice, decoded by a table function over every receiver's payloads."""
    series = series_of(read(spark, sf_dir, "events"))
    hour = F.array_min("samples.timestamp")
    numbered = Window.partitionBy("receiver").orderBy(hour, F.element_at("labels", "k"))  # one row for each series and hour
    named = written(series.select(F.element_at("labels", "__name__").alias("receiver"), "labels", "samples").withColumn("number", F.row_number().over(numbered).cast("bigint")))
    payloads = metrics.write_payloads(named, "receiver", "number")
    found = tables.decoded(spark, payloads.unionByName(payloads))
    return found.select("receiver", F.element_at("labels", "k").alias("k"), "timestamp", "value")


_KIND = "CASE WHEN lang = 'en' THEN '.md' WHEN lang = 'fr' THEN '.html' WHEN lang = 'de' THEN '.bin' ELSE '' END"
_FILES = f"(SELECT source || '/' || doc_id || {_KIND} AS path, sha256(text) AS sha, doc_id, length(text) AS n FROM documents)"


@query(f"""SELECT path, state, error, regexp_replace(path, '[^A-Za-z0-9]+', '-', 'g') || '-' || substr(sha, 1, 16) = file_id AS own_id FROM (
 SELECT f.path, f.sha, CASE WHEN m.doc_id IS NOT NULL AND NOT good THEN 'removed' WHEN NOT good THEN 'unsupported' WHEN m.quality = 1 THEN 'skipped' WHEN f.n > 5000 THEN 'failed' ELSE 'indexed' END AS state,
  CASE WHEN good AND NOT coalesce(m.quality = 1, false) AND f.n > 5000 THEN 'too long' END AS error,
  CASE WHEN good AND coalesce(m.quality = 1, false) THEN 'known-' || f.doc_id WHEN good THEN regexp_replace(f.path, '[^A-Za-z0-9]+', '-', 'g') || '-' || substr(f.sha, 1, 16) END AS file_id
  FROM (SELECT *, path LIKE '%.md' OR path LIKE '%.html' AS good FROM {_FILES}) f LEFT JOIN labels m ON m.doc_id = f.doc_id)
 UNION ALL SELECT 'gone/' || item_id || '.txt', 'removed', NULL, NULL FROM benchmark""")
def corpus_sync(spark, sf_dir):
    """Documents as files against a manifest of the labelled ones, those of low quality with another hash, and of passages that are gone; long ones fail."""
    d, labels, items = (read(spark, sf_dir, n) for n in ("documents", "labels", "benchmark"))
    kind = F.when(F.col("lang") == "en", ".md").when(F.col("lang") == "fr", ".html").when(F.col("lang") == "de", ".bin").otherwise("")
    named = d.select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), kind).alias("path"), F.sha2("text", 256).alias("sha256"), "doc_id", F.length("text").alias("n"))
    known = named.join(labels.select("doc_id", "quality"), "doc_id").select(
        "path", F.when(F.col("quality") == 1, F.col("sha256")).otherwise("old").alias("sha256"), F.concat(F.lit("known-"), F.col("doc_id").cast("string")).alias("file_id")
    )
    gone = items.select(F.concat(F.lit("gone/"), F.col("item_id").cast("string"), F.lit(".txt")).alias("path"), F.lit("x").alias("sha256"), F.lit("y").alias("file_id"))
    plan = corpus.sync_plan(named.select("path", "sha256"), known.unionByName(gone))
    results = plan.where("action = 'index'").join(named.select("path", "n"), "path").select("path", F.when(F.col("n") > 5000, "too long").alias("error"))
    report = corpus.sync_report(plan, results)
    own = corpus.file_id(F.col("path"), F.col("sha256")) == F.col("file_id")
    return report.select("path", "state", "error", own.alias("own_id"))
