"""Dashboard panels: their queries and their descriptions as plain dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.arguments import title
from ledgerline.functions.expressions import best_effort_time, exact_mean, hour, share
from ledgerline.operators.ranking import group_quantile

def total_events(e: DataFrame) -> DataFrame:
    return e.agg(F.count("*").alias("total_events"))

def error_events(e: DataFrame) -> DataFrame:
    return e.agg(F.count_if(F.col("event_type") == "error").alias("errors"))

def events_by_type_over_time(e: DataFrame, time: Column | None = None) -> DataFrame:
    time = best_effort_time(F.col("event_time")) if time is None else time
    counted = e.where(time.isNotNull()).groupBy(hour(time).alias("time"), "event_type").agg(F.count("*").alias("value"))
    return counted.orderBy("time", "event_type")

def event_type_share(e: DataFrame) -> DataFrame:
    return e.groupBy("event_type").agg(F.count("*").alias("value")).orderBy(F.desc("value"), "event_type")

def latest_events(e: DataFrame, n: int = 50) -> DataFrame:
    """The newest events; Spark keeps n rows a task and never sorts the table."""
    shown = ("id", "event_time", "user_id", "event_type", "route", "model_name", "status_code", "latency_ms")
    return e.select(*shown).orderBy(F.desc("id")).limit(n)

def routes(e: DataFrame, *more: Column) -> DataFrame:
    """Events, errors and latency of each route. Routes are few and large, so the percentile is found in buckets."""
    known = e.where("route is not null")
    facts = (F.count("*").alias("events"), F.count_if(F.col("status_code") >= 400).alias("errors"), exact_mean(F.col("latency_ms")).alias("avg_latency_ms"))
    slow = group_quantile(known, "route", "latency_ms", 0.95, "p95_latency_ms")
    counted = known.groupBy("route").agg(*facts, *more).join(slow, "route", "left")
    return counted.withColumn("error_rate", share(F.col("errors"), F.col("events")))

def problem_routes(e: DataFrame) -> DataFrame:
    """Error rate and latency by route, best first as the dashboard has it."""
    return routes(e).select("route", "error_rate", "events", "errors", "avg_latency_ms", "p95_latency_ms").orderBy("error_rate", F.asc_nulls_last("p95_latency_ms"), "route")

def problem_route_details(e: DataFrame) -> DataFrame:
    shown = ("route", "events", "users", "errors", "avg_latency_ms", "p95_latency_ms", "error_rate")
    return routes(e, F.count_distinct("user_id").alias("users")).select(*shown).orderBy("error_rate", F.asc_nulls_last("p95_latency_ms"), "route")

def model_cost(e: DataFrame) -> DataFrame:
    tokens = F.coalesce("prompt_tokens", F.lit(0)) + F.coalesce("completion_tokens", F.lit(0))
    return (
        e.where("model_name is not null")
        .groupBy("model_name")
        .agg(F.sum("total_cost_usd").alias("total_cost_usd"), F.sum(tokens).alias("total_tokens"), exact_mean(F.col("latency_ms")).alias("avg_latency_ms"))
        .orderBy(F.desc_nulls_last("total_cost_usd"), "model_name")
    )

PANELS = {
    "Total Events": ("stat", total_events),
    "Errors": ("stat", error_events),
    "Events by Type over Time": ("timeseries", events_by_type_over_time),
    "Event Type Share": ("piechart", event_type_share),
    "Latest Events": ("table", latest_events),
    "Problem Routes by Error Rate": ("barchart", problem_routes),
    "Problem Routes Details": ("table", problem_route_details),
    "Model Cost by Model Name": ("barchart", model_cost),
}

def result_format(kind: str) -> int:
    """0 for time series, 1 for everything shown as rows."""
    return 0 if kind in ("time_series", "timeseries") else 1

def panel(name: str, kind: str, result: DataFrame) -> dict:
    """A panel's description. A time series needs a column ``time``; without one it becomes a bar chart."""
    if kind == "timeseries" and "time" not in result.columns:
        kind = "barchart"
    return {"title": title(name, "Panel"), "type": kind, "format": result_format(kind), "columns": result.columns}

def dashboard(name: str, panels: list[dict]) -> dict:
    placed = [p | {"id": i + 1, "gridPos": {"x": 12 * (i % 2), "y": 8 * (i // 2), "w": 12, "h": 8}} for i, p in enumerate(panels)]
    return {"title": title(name, "Dashboard"), "refresh": "30s", "time": {"from": "now-24h", "to": "now"}, "panels": placed}

def rows_of(result: DataFrame, form: str = "json", most: int = 1000) -> list[str]:
    """A result of at most ``most`` rows as JSON rows or tab-separated lines; a larger one raises."""
    shown = result.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})) if form == "json" else result
    rows = shown.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows: aggregate or limit them")
    if form == "json":
        return [r[0] for r in rows]
    return ["\t".join(result.columns), *("\t".join("" if v is None else str(v) for v in r) for r in rows)]
