"""Change-data capture: envelopes to rows, and topics to tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

KINDS = ("postgres", "mysql", "mongodb")


@dataclass(frozen=True)
class ChangeSource:
    """One captured database. ``tables`` are the ones captured; a missing required value is an error."""

    kind: str
    folder: str
    tables: tuple[str, ...]
    topics: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"no such kind of source: {self.kind!r}")
        missing = [n for n in ("folder", "tables") if not getattr(self, n)]
        if missing:
            raise ValueError(f"missing settings: {', '.join(missing)}")

    def routes(self) -> dict[str, str]:
        """Topic to table; without a map the table of the topic's last part."""
        return self.topics or {f"{self.kind}.{t}": t.rpartition(".")[2] for t in self.tables}


def topic_map(text: str) -> dict[str, str]:
    """``topic=table,topic=table`` as a dictionary."""
    pairs = [p.partition("=") for p in text.split(",") if p.strip()]
    if any(not a.strip() or not b.strip() for a, _, b in pairs):
        raise ValueError(f"not topic=table pairs: {text!r}")
    return {a.strip(): b.strip() for a, _, b in pairs}


def flat_rows(envelopes: DataFrame, schema: StructType, order: str = "lsn") -> DataFrame:
    """Rows of (op, before, after JSON, order): the image after, or before for a delete, with __deleted."""
    image = F.when(F.col("op") == "d", F.coalesce("before", "after")).otherwise(F.col("after"))
    row = F.from_json(image, schema)
    named = envelopes.where("op is not null").select(row.alias("r"), (F.col("op") == "d").cast("string").alias("__deleted"), F.col(order).alias("__order"))
    return named.where("r is not null").select("r.*", "__deleted", "__order")


def plain_json(document: Column) -> Column:
    """A document's JSON: out of a JSON text if it is in one, and without the wrappers that say a value's type."""
    inner = F.when(F.ltrim(document).startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), document, F.lit("}")), "$.v")).otherwise(document)
    numbers = F.regexp_replace(inner, r'\{\s*"\$number(?:Long|Int|Double|Decimal)"\s*:\s*"?(-?[0-9.eE+-]+)"?\s*\}', "$1")
    return F.regexp_replace(numbers, r'\{\s*"\$(?:oid|date)"\s*:\s*("(?:[^"\\]|\\.)*"|-?[0-9]+)\s*\}', "$1")


def document_rows(envelopes: DataFrame, schema: StructType, order: str = "lsn") -> DataFrame:
    """The same for documents, whose images are JSON texts inside the envelope's JSON."""
    before = F.coalesce("before", F.get_json_object("after", "$.before"))
    return flat_rows(envelopes.withColumns({"before": plain_json(before), "after": plain_json(F.col("after"))}), schema, order)


def change_stream(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """Landed change files as a stream: what is there first, then what comes."""
    return spark.readStream.schema(schema).json(folder)


def routed(df: DataFrame, routes: dict[str, str], topic: str = "topic") -> dict[str, DataFrame]:
    """A frame for each table. A topic without a table raises when the frame runs."""
    known = F.col(topic).isin(*routes)
    safe = df.where(F.when(known, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no table for topic "), F.col(topic))).cast("boolean")))
    return {table: safe.where(F.col(topic).isin(*(t for t, x in routes.items() if x == table))).drop(topic) for table in set(routes.values())}
