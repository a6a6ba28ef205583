"""The platform's views: functions from a base table to a summary.

Views over versioned tables expect the merged relation (operators.versions.merged), so a
row that was loaded twice counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.arguments import bounded_limit
from ledgerline.functions.expressions import best_effort_time, exact_mean, exact_sum, hour, json_text, latest_value, minute, p95
from ledgerline.operators.filters import recent
from ledgerline.operators.series import changes, increases


def event_summary(app_events: DataFrame, time: Column | None = None) -> DataFrame:
    """Events, users, mean latency and cost by hour and type; times that cannot be parsed are one null hour.

    ``time`` is given where the table has one that is no text.
    """
    return (
        app_events.groupBy(hour(best_effort_time(F.col("event_time")) if time is None else time).alias("hour"), "event_type")
        .agg(
            F.count("*").alias("events"),
            F.count_distinct("user_id").alias("users"),
            exact_mean(F.col("latency_ms"), 6).alias("avg_latency_ms"),
            F.sum("total_cost_usd").alias("total_cost_usd"),
        )
        .orderBy(F.desc_nulls_last("hour"), F.asc_nulls_last("event_type"))
    )


def inventory_summary(inventory: DataFrame) -> DataFrame:
    """Cars, by status, mean price and range of model years by city, warehouse and brand."""
    status = {"available_cars": "available", "reserved_cars": "reserved", "maintenance_cars": "maintenance"}
    return (
        inventory.groupBy("city", "warehouse_name", "brand")
        .agg(
            F.count("*").alias("cars"),
            *(F.count_if(F.col("stock_status") == v).alias(k) for k, v in status.items()),
            exact_mean(F.col("price_usd")).alias("avg_price_usd"),
            F.min("model_year").alias("oldest_model_year"),
            F.max("model_year").alias("newest_model_year"),
        )
        .orderBy("city", F.desc("cars"), "brand")
    )


def metric_summary(samples: DataFrame) -> DataFrame:
    """Count, range, mean and 95th percentile of each metric by minute. NaN marks a series as stale and is left out."""
    value = F.when(~F.isnan("value"), F.col("value"))
    return (
        samples.groupBy(minute(F.col("sample_time")).alias("minute"), "metric_name")
        .agg(
            F.count("*").alias("samples"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            exact_mean(value, 6).alias("avg_value"),
            p95(value).alias("p95_value"),
        )
        .orderBy(F.desc_nulls_last("minute"), "metric_name")
    )


def targets(samples: DataFrame) -> DataFrame:
    """Last, lowest and mean ``up`` of each scrape target."""
    return (
        samples.where(F.col("metric_name") == "up")
        .groupBy(json_text(F.col("labels_json"), "$.job").alias("job"), json_text(F.col("labels_json"), "$.instance").alias("instance"))
        .agg(
            F.max("sample_time").alias("last_sample_time"),
            latest_value(F.col("value"), F.col("sample_time")).alias("last_up"),
            F.min("value").alias("min_up"),
            exact_mean(F.col("value"), 6).alias("avg_up"),
        )
        .orderBy("last_up", "job", "instance")
    )


def index_summary(documents: DataFrame) -> DataFrame:
    """Documents and their first, last and last loaded time by source and index."""
    return (
        documents.groupBy("source_name", "index_name")
        .agg(
            F.count("*").alias("documents"),
            F.min("event_time").alias("first_event_time"),
            F.max("event_time").alias("last_event_time"),
            F.max("ingest_time").alias("last_ingest_time"),
        )
        .orderBy(F.desc("documents"), "source_name", "index_name")
    )


def document_timeline(documents: DataFrame) -> DataFrame:
    """Documents by hour, source and index."""
    return (
        documents.groupBy(hour(F.col("event_time")).alias("hour"), "source_name", "index_name")
        .agg(F.count("*").alias("documents"))
        .orderBy(F.desc_nulls_last("hour"), "source_name", "index_name")
    )


def document_producers(documents: DataFrame) -> DataFrame:
    """Who wrote the documents, which is in them: the source's name is only how they came here."""
    fields = {"labels_source": "$.labels.source", "service": "$.service", "host": "$.host", "environment": "$.environment"}
    named = documents.select("index_name", *(json_text(F.col("document_json"), p).alias(n) for n, p in fields.items()))
    return named.groupBy("index_name", *fields).agg(F.count("*").alias("documents"))


def log_fields(documents: DataFrame) -> DataFrame:
    """Typed fields of log documents, in place of the raw JSON."""
    j = F.col("document_json")
    return documents.select(
        "index_name",
        "document_id",
        "event_time",
        *(json_text(j, f"$.{n}").alias(n) for n in ("service", "level", "message", "incident", "error_code", "trace_id", "user_id")),
        json_text(j, "$.http.path").alias("path"),
        F.get_json_object(j, "$.http.status_code").try_cast("int").alias("status_code"),
        F.get_json_object(j, "$.http.latency_ms").try_cast("int").alias("latency_ms"),
        json_text(j, "$.geo.city").alias("city"),
    )


def label_values(samples: DataFrame, metric: str, label: str) -> DataFrame:
    """The values that a label of a metric takes."""
    value = F.get_json_object("labels_json", f"$.{label}")
    return samples.where(F.col("metric_name") == metric).select(value.alias("label_value")).where("label_value is not null").distinct().orderBy("label_value")


def latest_samples(samples: DataFrame, limit: object = None, metric: str | None = None) -> DataFrame:
    """The latest samples of each metric, or of one; of one time those of the least fingerprint first.

    At most ``limit`` of each are kept while they are read, so a metric of very many samples is not sorted in one task.
    """
    kept = samples if metric is None else samples.where(F.col("metric_name") == metric)
    most = bounded_limit(limit, 20, 200)
    ranked = kept.withColumn("__first", F.struct((-F.unix_micros("sample_time")).alias("t"), "fingerprint", "value"))
    spread = ranked.withColumn("__part", F.pmod(F.xxhash64("fingerprint", "sample_time"), F.lit(256)))
    near = spread.withColumn("__n", F.row_number().over(Window.partitionBy("metric_name", "__part").orderBy("__first"))).where(F.col("__n") <= most)
    best = near.withColumn("__n", F.row_number().over(Window.partitionBy("metric_name").orderBy("__first"))).where(F.col("__n") <= most)
    return best.select(*samples.columns)


#: Fixed value: the job whose target is the exporter of the metrics itself.
EXPORTER = "synthetic-exporter"


def label(name: str) -> Column:
    return json_text(F.col("labels_json"), f"$.{name}")


def services(samples: DataFrame) -> DataFrame:
    """Samples of the services that are watched: those of the exporter's own target go, as it is up when they are down."""
    return samples.where((label("job") != EXPORTER) & (label("service") != ""))


def availability(samples: DataFrame, span: str = "6 hours") -> DataFrame:
    """Share of up samples by service over the last span of the data; the exporter's own target is no service."""
    up = recent(services(samples.where(F.col("metric_name") == "synthetic_service_up")), "sample_time", span)
    return up.groupBy(label("service").alias("service")).agg(exact_mean(F.col("value"), 4).alias("availability"), F.count("*").alias("samples")).orderBy("availability", "service")


def gauge_by(samples: DataFrame, metric: str, by: str, span: str = "6 hours") -> DataFrame:
    """Last, mean and highest value of a gauge by a label over the last span of the data."""
    kept = recent(samples.where(F.col("metric_name") == metric), "sample_time", span)
    return (
        kept.groupBy(label(by).alias(by))
        .agg(
            latest_value(F.col("value"), F.col("sample_time"), F.col("fingerprint")).alias("last"),
            exact_mean(F.col("value"), 6).alias("mean"),
            F.max("value").alias("highest"),
            F.count("*").alias("samples"),
        )
        .orderBy(by)
    )


def counter_by(samples: DataFrame, metric: str, by: str, span: str = "6 hours") -> DataFrame:
    """What a counter gained by a label over the last span of the data, resets taken into account."""
    kept = recent(samples.where(F.col("metric_name") == metric), "sample_time", span)
    grown = increases(kept.select("fingerprint", "sample_time", "value", label(by).alias(by)), ["fingerprint"])
    return grown.groupBy(by).agg(F.round(exact_sum(F.col("increase")), 3).alias("gained"), F.count("*").alias("samples")).orderBy(by)


def transitions(samples: DataFrame, metric: str = "synthetic_service_up", span: str = "24 hours") -> DataFrame:
    """When each target went up or down over the last span of the data."""
    kept = recent(services(samples.where(F.col("metric_name") == metric)), "sample_time", span)
    moved = changes(kept.select(label("instance").alias("instance"), label("service").alias("service"), "sample_time", "value"), ["instance", "service"])
    turned = moved.where("before is not null").withColumn("state", F.when(F.col("value") > 0, "up").otherwise("down"))
    return turned.select("instance", "service", F.col("sample_time").alias("at"), "state").orderBy("at", "instance")
