"""Metric samples from pushed payloads, range queries, debug JSON and exposition text."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.expressions import canonical_labels, fingerprint, millis

#: Bytes that one pushed payload may have.
MOST_BODY = 50 * 1024 * 1024
SERIES = "labels map<string,string>, timestamp long, value double"


def varint(data: bytes, at: int) -> tuple[int, int]:
    """(number, next position) of a base-128 number."""
    number = shift = 0
    while True:
        if at >= len(data) or shift > 63:
            raise ValueError("broken number in payload")
        byte = data[at]
        number |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return number, at


def uncompressed(block: bytes) -> bytes:
    """A raw snappy block: its length, then what pyarrow's codec decodes."""
    if not block:
        return b""
    size, _ = varint(block, 0)
    if size > 8 * MOST_BODY:
        raise ValueError("payload is too large")
    try:
        return pa.decompress(block, decompressed_size=size, codec="snappy", asbytes=True)
    except (OSError, pa.ArrowInvalid) as e:
        raise ValueError(f"broken snappy block: {e}") from None


def fields(data: bytes) -> Iterator[tuple[int, int, object]]:
    """(number, wire type, value) of each field of a protobuf message."""
    at = 0
    while at < len(data):
        tag, at = varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind in (1, 5):
            width = 8 if kind == 1 else 4
            value, at = data[at : at + width], at + width
            if len(value) < width:
                raise ValueError("payload ends in a field")
        elif kind == 2:
            size, at = varint(data, at)
            value, at = data[at : at + size], at + size
            if len(value) < size:
                raise ValueError("payload ends in a field")
        else:
            raise ValueError(f"wire type {kind} is not supported")
        yield tag >> 3, kind, value


def write_request(data: bytes) -> Iterator[tuple[dict[str, str], int, float]]:
    """(labels, milliseconds, value) of each sample of an uncompressed write request; unknown fields are skipped."""
    for number, kind, series in fields(data):
        if (number, kind) != (1, 2):
            continue
        labels: dict[str, str] = {}
        samples = []
        for inner, inner_kind, value in fields(series):
            if (inner, inner_kind) == (1, 2):
                pair = {n: v.decode("utf-8", "replace") for n, k, v in fields(value) if k == 2}
                labels[pair.get(1, "")] = pair.get(2, "")
            elif (inner, inner_kind) == (2, 2):
                sample = {n: (k, v) for n, k, v in fields(value)}
                reading = struct.unpack("<d", sample[1][1])[0] if sample.get(1, (0, 0))[0] == 1 else 0.0
                time = sample[2][1] if sample.get(2, (1, 0))[0] == 0 else 0
                samples.append((time - (1 << 64) if time >= 1 << 63 else time, reading))
        for time, reading in samples:
            yield labels, time, reading


def _decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for body in batch["content"]:
            rows = list(write_request(uncompressed(bytes(body))))
            yield pd.DataFrame(rows, columns=["labels", "timestamp", "value"])


def pushed_series(payloads: DataFrame) -> DataFrame:
    """(labels, timestamp, value) rows of a column ``content`` of compressed write requests, batch or stream."""
    too_large = F.raise_error(F.format_string("a payload has %d bytes, over %d", F.length("content"), F.lit(MOST_BODY))).cast("binary")
    content = F.when(F.length("content") <= MOST_BODY, F.col("content")).when(F.length("content") > MOST_BODY, too_large)
    return payloads.select(content.alias("content")).where("content is not null").mapInPandas(_decoded, SERIES)


def _number(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _message(tag: int, body: bytes) -> bytes:
    return _number(tag << 3 | 2) + _number(len(body)) + body


def _encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        bodies = []
        for labels, samples in zip(batch["labels"], batch["samples"]):
            pairs = b"".join(_message(1, _message(1, k.encode()) + _message(2, v.encode())) for k, v in sorted(dict(labels).items()))
            readings = b"".join(_message(2, b"\x09" + struct.pack("<d", s["value"]) + b"\x10" + _number(s["timestamp"] % 2**64)) for s in samples)
            bodies.append(pa.compress(_message(1, pairs + readings), codec="snappy", asbytes=True))
        yield batch.drop(columns=["labels", "samples"]).assign(content=bodies)


def write_payloads(series: DataFrame, *kept: str) -> DataFrame:
    """``kept`` columns and ``content``, a compressed write request for each row of (labels, samples array of timestamp and value): what pushed_series() reads."""
    columns = "".join(f"`{c}` {series.schema[c].dataType.simpleString()}, " for c in kept)
    return series.select(*kept, "labels", "samples").mapInPandas(_encoded, f"{columns}content binary")


def landed_payloads(spark: SparkSession, folder: str, stream: bool = False) -> DataFrame:
    """Files of a landing folder, one payload each."""
    reader = spark.readStream if stream else spark.read
    schema = "path string, modificationTime timestamp, length long, content binary"
    return reader.format("binaryFile").schema(schema).load(folder)


def sample_rows(series: DataFrame, ingest_mode: str = "remote_write", source: str = "prometheus", unnamed: str = "unknown_metric") -> DataFrame:
    """Rows of prometheus_samples from (labels, timestamp, value)."""
    labels = canonical_labels(F.col("labels"))
    return series.select(
        F.coalesce(F.try_element_at("labels", F.lit("__name__")), F.lit(unnamed)).alias("metric_name"),
        labels.alias("labels_json"),
        fingerprint(labels).alias("fingerprint"),
        F.timestamp_millis("timestamp").alias("sample_time"),
        F.col("value").cast("double").alias("value"),
        F.lit(source).alias("source"),
        F.lit(ingest_mode).alias("ingest_mode"),
        millis(F.current_timestamp()).alias("ingest_time"),
    )


#: What a backfill asks for unless told otherwise.
BACKFILL_QUERY, BACKFILL_STEP = "up", "60s"


def backfill_request(body: dict | None = None, now: datetime | None = None) -> dict:
    """queries, start, end and step of a backfill: by default the last hour, up to now, of one query."""
    given = body or {}
    several = given.get("queries")
    stamp = lambda t: t.strftime("%Y-%m-%dT%H:%M:%SZ")
    now = now or datetime.now(UTC)
    return {
        "queries": several if isinstance(several, list) and several else [given.get("query") or BACKFILL_QUERY],
        "start": given.get("start") or stamp(now - timedelta(hours=1)),
        "end": given.get("end") or stamp(now),
        "step": given.get("step") or BACKFILL_STEP,
    }


RANGE_RESULT = "array<struct<metric:map<string,string>,values:array<array<string>>>>"


def range_rows(results: DataFrame) -> DataFrame:
    """Rows of prometheus_samples from a table of (query, body): one range-query answer each.

    A series without a name takes the query's text as its name. An answer whose status is not
    ``success`` raises.
    """
    shape = f"status string, data struct<result:{RANGE_RESULT}>"
    parsed = results.select("query", F.from_json("body", shape).alias("b"))
    answered = F.when(F.col("b.status") == "success", F.col("b.data.result")).otherwise(
        F.raise_error(F.concat(F.lit("range query failed: "), F.col("query"))).cast(RANGE_RESULT)
    )
    series = parsed.select("query", F.explode(answered).alias("s"))
    named = F.when(F.map_contains_key("s.metric", "__name__"), F.col("s.metric")).otherwise(
        F.map_concat("s.metric", F.create_map(F.lit("__name__"), F.col("query")))
    )
    points = series.select(named.alias("labels"), F.explode("s.values").alias("v"))
    return sample_rows(
        points.select("labels", (F.get("v", F.lit(0)).cast("double") * 1000).cast("bigint").alias("timestamp"), F.get("v", F.lit(1)).try_cast("double").alias("value")),
        "backfill",
    )


def backfill_details(results: DataFrame) -> DataFrame:
    """(query, inserted): samples that each query's answer holds."""
    return (
        results.select("query", F.from_json("body", f"data struct<result:{RANGE_RESULT}>").alias("b"))
        .select("query", F.explode_outer("b.data.result").alias("s"))
        .groupBy("query")
        .agg(F.coalesce(F.sum(F.size("s.values")), F.lit(0)).alias("inserted"))
    )


def debug_rows(spark: SparkSession, body: str, allowed: bool = False) -> DataFrame:
    """Rows of prometheus_samples from a parsed push, for tests; off unless allowed."""
    if not allowed:
        raise PermissionError("debug input is off")
    data = json.loads(body)
    rows = [(dict(s.get("labels") or {}), int(x["timestamp"]), float(x["value"])) for s in data.get("timeseries", []) for x in s.get("samples", [])]
    return sample_rows(spark.createDataFrame(rows, SERIES), str(data.get("ingest_mode") or "debug_json"))


#: A sample line: name, labels in braces, value, optional seconds.
LINE = r"^([a-zA-Z_:][\w:]*)(?:\{(.*)\})?\s+(\S+)(?:\s+([\d.]+))?\s*$"
LABEL = r'([a-zA-Z_]\w*)="((?:[^"\\]|\\.)*)"'


def _plain(value: Column) -> Column:
    """A label's value without escapes; a character that is in no text keeps double backslashes apart from the rest."""
    apart = F.replace(value, F.lit("\\\\"), F.lit("\x00"))
    for escaped, char in (('\\"', '"'), ("\\n", "\n"), ("\x00", "\\")):
        apart = F.replace(apart, F.lit(escaped), F.lit(char))
    return apart


def exposition_lines(samples: DataFrame) -> DataFrame:
    """``value``, a line of exposition text for each row of (metric_name, labels, value, sample_time); empty labels go."""
    escaped = lambda v: F.replace(F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    pairs = F.transform(
        F.filter(F.array_sort(F.map_entries("labels")), lambda e: F.length(e["value"]) > 0), lambda e: F.concat(e["key"], F.lit('="'), escaped(e["value"]), F.lit('"'))
    )
    return samples.select(F.format_string("%s{%s} %s %d", "metric_name", F.array_join(pairs, ","), F.col("value").cast("string"), F.unix_seconds(F.col("sample_time").cast("timestamp"))).alias("value"))


def fault(line: Column) -> Column:
    """What is wrong with a line of exposition text; null for a sample, a comment or a blank line."""
    names = F.regexp_extract_all(F.regexp_extract(line, LINE, 2), F.lit(LABEL), F.lit(1))
    reading = F.lower(F.regexp_extract(line, LINE, 3))
    number = reading.try_cast("double").isNotNull() | reading.isin("nan", "+inf", "-inf", "inf")
    return (
        F.when(line.isNull() | line.startswith("#") | line.rlike(r"^\s*$"), None)
        .when(F.regexp_extract(line, LINE, 1) == "", "no sample")
        .when(F.size(F.array_distinct(names)) < F.size(names), "a label twice")
        .when(~number, "no number")
    )


def bad_lines(lines: DataFrame) -> DataFrame:
    """(value, fault) of the lines that exposition_rows() leaves out, comments and blank lines aside."""
    return lines.withColumn("fault", fault(F.col("value"))).where("fault is not null").select("value", "fault")


def exposition_rows(lines: DataFrame, ingest_mode: str = "backfill") -> DataFrame:
    """Rows of prometheus_samples from exposition text (column ``value``); comments go, and so do lines with a fault: see bad_lines()."""
    v = F.col("value")
    lines = lines.where(fault(v).isNull())
    name = F.regexp_extract(v, LINE, 1)
    names = F.regexp_extract_all(F.regexp_extract(v, LINE, 2), F.lit(LABEL), F.lit(1))
    values = F.transform(F.regexp_extract_all(F.regexp_extract(v, LINE, 2), F.lit(LABEL), F.lit(2)), _plain)
    seconds = F.regexp_extract(v, LINE, 4).try_cast("double")
    parsed = lines.where(~v.startswith("#") & (name != "")).select(
        F.map_concat(F.create_map(F.lit("__name__"), name), F.map_from_arrays(names, values)).alias("labels"),
        F.coalesce((seconds * 1000).cast("bigint"), F.unix_millis(F.current_timestamp())).alias("timestamp"),
        F.regexp_extract(v, LINE, 3).try_cast("double").alias("value"),
    )
    return sample_rows(parsed, ingest_mode)
