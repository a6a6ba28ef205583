"""Schemas, keys and versions of the tables that the platform keeps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, INT, TEXT, DOUBLE, TIME = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.TimestampType()


def _struct(required: dict[str, T.DataType], optional: dict[str, T.DataType] | None = None, order: str = "") -> T.StructType:
    optional = optional or {}
    names = order.split() if order else [*required, *optional]
    return T.StructType([T.StructField(n, (required | optional)[n], n in optional) for n in names])


APP_EVENTS = _struct(
    {"id": LONG, "event_time": TEXT, "user_id": TEXT, "session_id": TEXT, "event_type": TEXT, "metadata": TEXT, "ingest_time": TIME},
    {"route": TEXT, "status_code": INT, "latency_ms": INT, "model_name": TEXT, "prompt_tokens": INT, "completion_tokens": INT, "total_cost_usd": T.DecimalType(12, 6)},
    "id event_time user_id session_id event_type route status_code latency_ms model_name prompt_tokens completion_tokens total_cost_usd metadata ingest_time",
)
INVENTORY = _struct(
    {
        "id": LONG, "batch_id": TEXT, "inventory_time": TEXT, "city": TEXT, "warehouse_name": TEXT, "brand": TEXT, "model": TEXT, "model_year": INT,
        "body_type": TEXT, "color": TEXT, "vin": TEXT, "stock_status": TEXT, "price_usd": T.DecimalType(12, 2), "mileage_km": LONG, "arrived_at": TEXT,
        "metadata": TEXT, "ingest_time": TIME,
    }
)
SAMPLES = _struct(
    {"metric_name": TEXT, "labels_json": TEXT, "fingerprint": TEXT, "sample_time": TIME, "value": DOUBLE, "source": TEXT, "ingest_mode": TEXT, "ingest_time": TIME}
)
DOCUMENT_EVENTS = _struct(
    {"source_name": TEXT, "index_name": TEXT, "document_id": TEXT, "event_time": TIME, "ingest_time": TIME, "document_json": TEXT, "version": LONG}
)
OFFSETS = _struct({"source_name": TEXT, "checkpoint_name": TEXT, "last_event_time": TIME, "last_document_id": TEXT, "updated_at": TIME})


@dataclass(frozen=True)
class Table:
    """A base table: rows that agree in ``key`` are versions of one row where ``version`` is set."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    version: str | None = None
    month_of: str | None = None


TABLES = {
    t.name: t
    for t in (
        Table("app_events_raw", APP_EVENTS, ("event_time", "id")),
        Table("car_inventory_raw", INVENTORY, ("city", "brand", "model", "id")),
        Table("prometheus_samples", SAMPLES, ("metric_name", "fingerprint", "sample_time", "source", "ingest_mode"), "ingest_time", "sample_time"),
        Table("elasticsearch_events_raw", DOCUMENT_EVENTS, ("source_name", "index_name", "event_time", "document_id"), "version", "event_time"),
        Table("ingestion_offsets", OFFSETS, ("source_name", "checkpoint_name"), "updated_at"),
    )
}

#: The type that each relational source type becomes; others become strings.
SOURCE_TYPES = {
    "bigint": "bigint", "integer": "int", "smallint": "smallint", "boolean": "boolean", "real": "float", "double precision": "double",
    "numeric": "decimal(18,6)", "date": "date", "timestamp": "timestamp", "timestamp with time zone": "timestamp", "timestamp without time zone": "timestamp",
}


def table_from_source(columns: list[tuple[str, str, bool]]) -> T.StructType:
    """A schema from (name, source type, nullable) rows of a source's catalog."""
    parsed = [(n, T._parse_datatype_string(SOURCE_TYPES.get(t.lower(), "string")), null) for n, t, null in columns]
    return T.StructType([T.StructField(*row) for row in parsed])
