"""Reproducible demonstration data, made by Spark from row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.expressions import text_hash
from ledgerline.operators.joins import first_interval, numbered

# Fixed values of the event seed.
EVENT_TYPES = ("page_view", "chat_message", "tool_call", "model_completion", "error")
ROUTES = ("/", "/chat", "/agents", "/settings", "/api/completions")
MODELS = ("qwen2.5:7b", "qwen2.5:14b", "qwen3:14b", "local-vision-model")

# Fixed values of the inventory: cities with warehouse, currency and demand; models with body and base price; colours.
CITIES = [("Tokyo", "Tokyo Bay Auto Hub", "JPY", 1.12), ("Moscow", "Moscow North Vehicle Depot", "RUB", 0.91), ("Minsk", "Minsk Central Car Storage", "BYN", 0.78)]
CARS = [
    ("Toyota", "Corolla", "sedan", 22100), ("Toyota", "RAV4", "suv", 31900), ("Toyota", "Camry", "sedan", 28700), ("Nissan", "Qashqai", "suv", 27600),
    ("Nissan", "Leaf", "hatchback", 29900), ("Honda", "Civic", "sedan", 25400), ("Honda", "CR-V", "suv", 33600), ("Mazda", "CX-5", "suv", 30400),
    ("Mazda", "Mazda3", "hatchback", 24600), ("BMW", "X5", "suv", 66900), ("BMW", "320i", "sedan", 45900), ("Mercedes-Benz", "C-Class", "sedan", 48700),
    ("Mercedes-Benz", "GLC", "suv", 57900), ("Audi", "A4", "sedan", 43800), ("Audi", "Q5", "suv", 53200), ("Volkswagen", "Tiguan", "suv", 34900),
    ("Volkswagen", "Golf", "hatchback", 29200), ("Kia", "Sportage", "suv", 30900), ("Hyundai", "Tucson", "suv", 31700), ("Geely", "Monjaro", "suv", 36200),
]
COLORS = [("White",), ("Black",), ("Silver",), ("Blue",), ("Red",), ("Graphite",)]

# Fixed values of the metric scenario: targets, and incidents by minutes of the day.
TARGETS = [
    ("db", "postgresql", "db-postgres-primary", "postgresql", "postgresql-primary:5432", "platform", "data"),
    ("db", "mysql", "db-mysql-orders", "mysql", "mysql-orders-1:3306", "orders", "data"),
    ("db", "mysql", "db-mysql-billing", "mysql", "mysql-billing-1:3306", "billing", "data"),
    ("db", "mongodb", "db-mongodb-users", "mongodb", "mongodb-users-1:27017", "identity", "data"),
    ("db", "mongodb", "db-mongodb-events", "mongodb", "mongodb-events-1:27017", "analytics", "data"),
    ("service", None, "api-gateway", "service", "api-gateway-1:8080", "platform", "edge"),
    ("service", None, "auth-service", "service", "auth-service-1:8080", "identity", "app"),
    ("service", None, "payment-service", "service", "payment-service-1:8080", "billing", "app"),
    ("service", None, "orders-service", "service", "orders-service-1:8080", "orders", "app"),
    ("service", None, "notification-service", "service", "notification-service-1:8080", "messaging", "app"),
]
INCIDENTS = [
    ("payment_gateway_degradation", "payment-service", "critical", 570, 625),
    ("mysql_billing_crash_loop", "db-mysql-billing", "critical", 785, 808),
    ("mongodb_events_disk_pressure", "db-mongodb-events", "warning", 1020, 1155),
    ("postgres_checkpoint_saturation", "db-postgres-primary", "warning", 135, 190),
    ("notification_queue_backlog", "notification-service", "warning", 1260, 1340),
]
# Fixed values of the metric scenario: a service's requests a minute, latency in seconds, share of errors and routes.
SERVICES = [
    ("api-gateway", 420.0, 0.18, 0.002, ["/api/v1/search", "/api/v1/profile", "/api/v1/checkout"]),
    ("auth-service", 95.0, 0.11, 0.0015, ["/login", "/refresh", "/oauth/callback"]),
    ("payment-service", 55.0, 0.28, 0.004, ["/charge", "/refund", "/webhook/provider"]),
    ("orders-service", 120.0, 0.22, 0.0025, ["/orders", "/orders/{id}", "/cart/checkout"]),
    ("notification-service", 38.0, 0.35, 0.003, ["/send", "/templates/render", "/delivery-status"]),
]
# Fixed values of the metric scenario: an engine's connections, query time in seconds and share of the disk in use.
ENGINES = [("postgresql", 82.0, 0.045, 0.54), ("mysql", 64.0, 0.035, 0.54), ("mongodb", 48.0, 0.055, 0.62)]
ENVIRONMENT = "synthetic-prod"

# Fixed values of the log scenario: services with host and paths.
LOG_SERVICES = [
    ("api-gateway", "edge-01", ["/api/search", "/api/orders", "/api/cars", "/api/login"]),
    ("checkout-service", "app-01", ["/checkout", "/payment/authorize", "/orders/confirm"]),
    ("inventory-service", "app-02", ["/inventory/reserve", "/inventory/release", "/inventory/search"]),
    ("payment-service", "app-03", ["/payment/charge", "/payment/refund", "/payment/status"]),
    ("notification-service", "app-04", ["/notifications/email", "/notifications/sms", "/notifications/push"]),
]
LOG_CITIES = ("Minsk", "Moscow", "Tokyo")
METHODS = ("GET", "POST", "PUT")
AGENTS = ("desktop-web", "mobile-ios", "mobile-android", "partner-api")


def pick(values, index: Column) -> Column:
    """The value at an index that wraps around."""
    return F.get(F.array(*(F.lit(v) for v in values)), (index % len(values)).cast("int"))


def app_events(spark: SparkSession, n: int = 1000, end: str = "2026-05-24 12:00:00", seed: int = 1) -> DataFrame:
    """The event seed: a row per minute before the end. Latency, tokens and cost are random, with a seed."""
    g = F.col("id")
    return spark.range(1, n + 1).select(
        g,
        F.date_format(F.lit(end).cast("timestamp") - F.make_dt_interval(mins=g.cast("int")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("event_time"),
        F.concat(F.lit("user_"), g % 25 + 1).alias("user_id"),
        F.concat(F.lit("session_"), g % 80 + 1).alias("session_id"),
        pick(EVENT_TYPES, g).alias("event_type"),
        pick(ROUTES, g).alias("route"),
        F.when(g % 17 == 0, 500).when(g % 11 == 0, 429).otherwise(200).alias("status_code"),
        (50 + F.rand(seed) * 2500).cast("int").alias("latency_ms"),
        pick(MODELS, g).alias("model_name"),
        (50 + F.rand(seed + 1) * 1500).cast("int").alias("prompt_tokens"),
        (20 + F.rand(seed + 2) * 1200).cast("int").alias("completion_tokens"),
        (F.rand(seed + 3) * 0.08).cast("decimal(12,6)").alias("total_cost_usd"),
        F.to_json(F.struct(F.lit("seed").alias("source"), F.lit("local").alias("environment"), F.md5(g.cast("string")).alias("request_id"))).alias("metadata"),
        F.current_timestamp().alias("ingest_time"),
    )


def car_inventory(spark: SparkSession, n: int = 3000, batch: str = "demo", end: str = "2026-05-24 12:00:00") -> DataFrame:
    """Cars from three small tables that row numbers run through in turn; the joins are equi-joins on a place."""
    g = F.col("id")
    rows = spark.range(1, n + 1).withColumns({"ci": (g - 1) % 3, "mo": (g - 1) % 20, "co": (g - 1) % 6})
    cities = numbered(CITIES, "city string, warehouse_name string, currency string, demand double", spark).withColumnRenamed("place", "ci")
    cars = numbered(CARS, "brand string, model string, body_type string, base int", spark).withColumnRenamed("place", "mo")
    colors = numbered(COLORS, "color string", spark).withColumnRenamed("place", "co")
    year = 2020 + g % 6
    before = lambda **x: F.date_format(F.lit(end).cast("timestamp") - F.make_dt_interval(**x), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    joined = rows.join(F.broadcast(cities), "ci").join(F.broadcast(cars), "mo").join(F.broadcast(colors), "co")
    about = F.struct(
        F.lit("generator").alias("source"), F.lit(batch).alias("batch_id"), F.col("currency").alias("local_currency"),
        (g % 13 != 0).alias("inspection_passed"), F.char(65 + g % 5).alias("storage_zone"), "city",
    )
    price = F.col("base").cast("decimal(12,2)") * F.col("demand").cast("decimal(4,2)") * (1 + (year - 2020).cast("decimal(4,0)") * F.lit(0.035).cast("decimal(4,3)"))
    return joined.select(
        g, F.lit(batch).alias("batch_id"), before(mins=g.cast("int")).alias("inventory_time"), "city", "warehouse_name", "brand", "model",
        year.cast("int").alias("model_year"), "body_type", "color", F.upper(F.substring(F.md5(F.concat(F.lit(batch + "-"), g)), 1, 17)).alias("vin"),
        F.when(g % 19 == 0, "maintenance").when(g % 7 == 0, "reserved").otherwise("available").alias("stock_status"),
        F.round(price, 2).cast("decimal(12,2)").alias("price_usd"),
        F.when(year >= 2024, g % 9000).otherwise(12000 + g * 37 % 95000).alias("mileage_km"),
        before(days=(g % 120).cast("int")).alias("arrived_at"), F.to_json(about).alias("metadata"), F.current_timestamp().alias("ingest_time"),
    )


def counter(per_minute: Column, time: Column, start: Column) -> Column:
    """A counter's reading: a rate for every minute since 1970 and where it started, never below 0."""
    return F.greatest(F.lit(0.0), F.floor(F.unix_seconds(time) / 60) * per_minute + start)


def scenario(spark: SparkSession, hours: int, end: str) -> DataFrame:
    """Every target at every minute of the span, with its service's or engine's fixed values and the incident that is on."""
    last = F.unix_seconds(F.lit(end).cast("timestamp"))
    times = spark.range(0, hours * 60 + 1).select(F.timestamp_seconds(last - (hours * 60 - F.col("id")) * 60).alias("sample_time"))
    columns = "kind string, engine string, service string, job string, instance string, team string, tier string"
    targets = numbered(TARGETS, columns, spark).drop("place")
    services = numbered(SERVICES, "service string, requests double, latency double, errors double, routes array<string>", spark).drop("place")
    engines = numbered(ENGINES, "engine string, base_connections double, base_query double, base_disk double", spark).drop("place")
    planned = spark.createDataFrame([(s, i, v) for i, s, v, _, _ in INCIDENTS], "service string, planned string, severity string")
    described = targets.join(services, "service", "left").join(engines, "engine", "left").join(planned, "service", "left")
    spans = numbered([(s, i, a, b) for i, s, _, a, b in INCIDENTS], "service string, incident string, start int, stop int", spark)
    # Ten targets: every time meets each of them once, from one array.
    every = described.groupBy().agg(F.collect_list(F.struct(*described.columns)).alias("every"))
    spread = times.withColumn("every", every.scalar()).select("sample_time", F.explode("every").alias("t")).select("sample_time", "t.*")
    at = F.hour("sample_time") * 60 + F.minute("sample_time")
    return first_interval(spread, F.broadcast(spans), "service", at, "start", "stop", "place").drop("place", "start", "stop")


def service_metrics(spark: SparkSession, hours: int = 72, end: str = "2026-05-24 12:00:00") -> DataFrame:
    """(metric_name, labels, sample_time, value): 115 samples of ten families each minute.

    Availability and incidents of all targets; connections, query time, lag, disk, restarts and log events of databases; requests
    and latency by route, restarts and log events of services.
    """
    time, service, engine = F.col("sample_time"), F.col("service"), F.col("engine")
    on = lambda name: F.coalesce(F.col("incident") == name, F.lit(False))
    busy, crashed, full, slow, queue = (on(name) for name, *_ in INCIDENTS)
    at = F.hour(time) * 60 + F.minute(time)
    wave = lambda phase: (F.sin((at + phase) / 1440 * 2 * F.pi()) + 1) / 2
    jitter = lambda name, size: F.sin((text_hash(name) + F.floor(F.unix_seconds(time) / 60) * 17) * 0.013) * size
    named = lambda what: F.concat(service, F.lit(f":{what}"))
    length, zero = F.length(service), F.lit(0.0)

    def sample(metric: str, value: Column, **labels: str | Column) -> Column:
        own = F.create_map(*(x for k, v in labels.items() for x in (F.lit(k), v if isinstance(v, Column) else F.lit(v)))) if labels else F.create_map().cast("map<string,string>")
        return F.struct(F.lit(metric).alias("metric_name"), own.alias("own"), value.cast("double").alias("value"))

    def log(level: str, event: str | Column, rate: Column, start: int) -> Column:
        return sample("synthetic_log_events_total", counter(rate, time, length * start), level=level, event=event)

    up = F.when(crashed, zero).otherwise(1.0)
    query = F.when(crashed, zero).otherwise(
        F.greatest(F.lit(0.005), F.col("base_query") * F.when(slow, 6.0).when(full, 3.8).otherwise(1.0) + jitter(named("query"), 0.008))
    )
    lag = F.greatest(zero, F.when(slow, 45.0).when(full, 18.0).otherwise(1.5) + F.abs(jitter(named("lag"), 3.0)))
    disk = F.col("base_disk") + F.when(full, 0.28).otherwise(0.0) + wave(180) * 0.05 + F.abs(jitter(named("disk"), 0.015))
    connections = F.rint(F.col("base_connections") + wave(-240) * 26 + jitter(named("conn"), 6.0))
    of_engine = {"db_engine": engine}
    database = F.array(
        sample("synthetic_db_connections", F.when(crashed, zero).otherwise(connections), **of_engine, state="active"),
        sample("synthetic_db_query_duration_seconds_p95", query, **of_engine),
        sample("synthetic_db_replication_lag_seconds", F.when(crashed, 180.0).otherwise(lag), **of_engine),
        sample("synthetic_db_disk_usage_ratio", F.least(F.lit(0.98), disk), **of_engine, mount="/var/lib/data"),
        sample("synthetic_process_restarts_total", counter(F.when(crashed, 1 / 60).otherwise(0.0), time, length), reason="crash_loop"),
        log("error", F.when(crashed, "database_unavailable").otherwise("slow_query"), F.when(crashed, 20.0).when(query > 0.2, 3.0).otherwise(0.2), 11),
        log("info", "healthcheck_ok", F.when(crashed, 0.0).otherwise(12.0), 13),
    )
    rate = F.greatest(F.lit(1.0), F.col("requests") * (0.65 + wave(-360) * 0.7) * F.when(busy, 1.45).otherwise(1.0) + jitter(service, F.col("requests") * 0.04))
    errors = (
        F.when(busy, 0.18 + F.abs(jitter(service, 0.025)))
        .when(queue, 0.045 + F.abs(jitter(service, 0.012)))
        .otherwise(F.greatest(zero, F.col("errors") + F.abs(jitter(named("err"), F.col("errors")))))
    )
    each = rate / F.size("routes")
    requests = lambda r, status, share, salt: sample("synthetic_http_requests_total", counter(each * share, time, F.length(r) * salt), route=r, status_class=status)
    weight = lambda r: F.when(r == "/checkout", 1.7).when(r == "/login", 1.2).when(r == "/send", 1.6).otherwise(1.0)
    latency = lambda r: F.greatest(
        F.lit(0.01), F.col("latency") * weight(r) * F.when(busy, 8.0).when(queue, 3.2).otherwise(1.0) + jitter(F.concat(service, F.lit(":"), r, F.lit(":lat")), 0.025)
    )
    by_route = F.transform(
        "routes",
        lambda r: F.array(requests(r, "2xx", 1 - errors, 1), requests(r, "5xx", errors, 7), sample("synthetic_http_request_duration_seconds_p95", latency(r), route=r)),
    )
    ill = F.col("incident").isNotNull()
    application = F.array(
        log("error", F.when(ill, "request_failed").otherwise("handled_exception"), rate * errors, 19),
        log("warn", F.when(ill, "degraded_dependency").otherwise("retry"), rate * F.when(ill, 0.07).otherwise(0.003), 23),
        log("info", "request_completed", rate * 0.96, 29),
        sample(
            "synthetic_process_restarts_total", counter(F.when(ill, 0.08).otherwise(0.0002), time, length * 31),
            reason=F.when(ill, "oom_or_probe_failure").otherwise("rolling_deploy"),
        ),
    )
    both = F.array(sample("synthetic_service_up", up, component_kind=F.col("kind")))
    incident = F.array(sample("synthetic_incident_active", ill.cast("double"), incident=F.col("planned"), severity=F.col("severity")))
    of_kind = F.when(F.col("kind") == "db", database).otherwise(F.concat(F.flatten(by_route), application))
    samples = F.concat(both, F.when(F.col("planned").isNotNull(), incident).otherwise(F.slice(incident, 1, 0)), of_kind)
    common = F.create_map(*(x for n in ("job", "instance", "service", "team", "tier") for x in (F.lit(n), F.col(n))), F.lit("environment"), F.lit(ENVIRONMENT))
    rows = scenario(spark, hours, end).select("sample_time", common.alias("common"), F.explode(samples).alias("s"))
    return rows.select("s.metric_name", F.map_concat("common", "s.own").alias("labels"), "sample_time", "s.value")


def log_documents(spark: SparkSession, n: int = 720, hours: int = 72, end: str = "2026-05-24 12:00:00", prefix: str = "nginx-logs") -> DataFrame:
    """(_index, _id, _source) of log documents spread evenly over the hours before the end."""
    q = F.col("id")
    step = hours * 3_600_000 // max(n, 1)
    rows = spark.range(n).withColumn("time", F.timestamp_millis(F.unix_millis(F.lit(end).cast("timestamp")) - hours * 3_600_000 + q * step))
    service = pick([s for s, _, _ in LOG_SERVICES], q)
    hour, minute = F.hour("time"), F.minute("time")
    incident = (
        F.when((service == "payment-service") & hour.isin(10, 11), "payment_latency_spike")
        .when((service == "inventory-service") & (hour == 15) & (minute < 40), "inventory_db_lock_contention")
        .when((service == "notification-service") & (hour == 2) & (minute < 30), "notification_queue_backlog")
        .otherwise("none")
    )
    rows = rows.withColumns({"service": service, "incident": incident})
    spike, lock, backlog = (F.col("incident") == x for x in ("payment_latency_spike", "inventory_db_lock_contention", "notification_queue_backlog"))
    crash = (F.col("incident") == "none") & (q % 97 == 0)
    cases = [(spike & (q % 5 == 0), 503, "error", "PAYMENT_PROVIDER_TIMEOUT", "payment provider timeout"), (spike, 200, "warn", "", "payment latency above threshold"),
             (lock & (q % 6 == 0), 409, "warn", "INVENTORY_LOCK_TIMEOUT", "inventory lock contention"), (backlog & (q % 4 == 0), 429, "error", "QUEUE_BACKLOG", "notification queue backlog"),
             (backlog, 200, "warn", "", "notification worker delayed"), (crash, 500, "error", "UNHANDLED_EXCEPTION", "unexpected application error")]
    outcome = F.struct(F.lit(200).alias("status"), F.lit("info").alias("level"), F.lit("").alias("code"), F.lit("request completed").alias("message"))
    for when, status, level, code, message in reversed(cases):
        outcome = F.when(when, F.struct(F.lit(status).alias("status"), F.lit(level).alias("level"), F.lit(code).alias("code"), F.lit(message).alias("message"))).otherwise(outcome)
    more = F.when(spike, 900 + q % 7 * 120).when(lock, 650 + q % 11 * 60).when(backlog, 300 + q % 5 * 80).when(crash, 450).otherwise(0)
    turn = F.floor(q / len(LOG_SERVICES)).cast("bigint")
    path = F.get(F.array(*(pick(p, turn) for _, _, p in LOG_SERVICES)), (q % len(LOG_SERVICES)).cast("int"))
    rows = rows.withColumns({"o": outcome, "index": F.concat(F.lit(prefix), F.date_format("time", "-yyyy.MM.dd"))})
    source = F.struct(
        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("@timestamp"), F.lit("synthetic").alias("environment"), "service",
        pick([h for _, h, _ in LOG_SERVICES], q).alias("host"), F.col("o.level").alias("level"), F.col("o.message").alias("message"),
        F.struct(pick(METHODS, q).alias("method"), path.alias("path"), F.col("o.status").alias("status_code"), (40 + q * 17 % 180 + more).alias("latency_ms"), pick(AGENTS, q).alias("user_agent")).alias("http"),
        F.struct(pick(LOG_CITIES, q).alias("city")).alias("geo"),
        F.concat(F.lit("trc-"), F.date_format("time", "yyyyMMddHHmm"), F.lit("-"), F.lpad(q.cast("string"), 6, "0")).alias("trace_id"),
        F.concat(F.lit("user-"), 1000 + q % 250).alias("user_id"), "incident", F.col("o.code").alias("error_code"),
        F.struct(F.when(F.col("service").isin("api-gateway", "inventory-service"), "platform").otherwise("product").alias("team"), F.lit("synthetic-lab").alias("source")).alias("labels"),
    )
    return rows.select(F.col("index").alias("_index"), F.concat("index", F.lit("-"), F.lpad(q.cast("string"), 8, "0")).alias("_id"), F.to_json(source).alias("_source"))
