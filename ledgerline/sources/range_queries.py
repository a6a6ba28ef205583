"""Range queries of a metric server as a table: a partition for each query and stretch of steps.

Stretches lie on the grid of steps from the start, and none holds a step of another, so their answers together are the answer to the whole range. A stretch has
at most POINTS steps, as servers refuse longer ones.
"""

from __future__ import annotations

import json
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline.sources.metrics import BACKFILL_STEP, backfill_request

#: Steps of one request at most.
POINTS = 11_000
SECONDS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604_800}


def seconds(step: str) -> float:
    """Seconds of a step such as 60s, 1m30s or 15."""
    parts = re.findall(r"([0-9.]+)(ms|[smhdw])", step)
    if "".join(n + u for n, u in parts) == step and parts:
        return sum(float(n) * SECONDS[u] for n, u in parts)
    return float(step)


def moment(text: str) -> float:
    """Seconds since 1970 of a time as it is written in a request: a number, or a date and time."""
    try:
        return float(text)
    except ValueError:
        return datetime.fromisoformat(text.replace("Z", "+00:00")).timestamp()


@dataclass
class Stretch(InputPartition):
    query: str
    start: float
    end: float

    def __post_init__(self):
        self.value = None


class RangeReader(DataSourceReader):
    """Options: url, queries (a JSON list), start, end, step, points (steps of a request), attempts at a request that fails with the server's fault."""

    def __init__(self, options: dict[str, str]):
        self.url, self.queries = options["url"].rstrip("/"), json.loads(options["queries"])
        self.start, self.end, self.step = moment(options["start"]), moment(options["end"]), options.get("step", BACKFILL_STEP)
        self.points, self.attempts = min(int(options.get("points", POINTS)), POINTS), int(options.get("attempts", "3"))
        if self.points < 1 or seconds(self.step) <= 0 or self.attempts < 1:
            raise ValueError("points, step and attempts must be positive")

    def partitions(self) -> list[Stretch]:
        width = seconds(self.step)
        steps = int((self.end - self.start) / width + 1e-9) + 1 if self.end >= self.start else 0
        firsts = range(0, steps, self.points)
        return [Stretch(q, self.start + k * width, self.start + (min(k + self.points, steps) - 1) * width) for q in self.queries for k in firsts]

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark reads once where there are no partitions
            return
        asked = urllib.parse.urlencode({"query": partition.query, "start": f"{partition.start:.3f}", "end": f"{partition.end:.3f}", "step": self.step})
        body = self._get(f"{self.url}/api/v1/query_range?{asked}")
        yield pa.RecordBatch.from_arrays([pa.array([partition.query]), pa.array([body])], ["query", "body"])

    def _get(self, url: str) -> str:
        for attempt in range(1, self.attempts + 1):
            try:
                with urllib.request.urlopen(url, timeout=120) as answer:
                    return answer.read().decode()
            except urllib.error.HTTPError as e:
                if e.code < 500 or attempt == self.attempts:
                    raise RuntimeError(f"{e.code} for {url}: {e.read().decode(errors='replace')[:200]}") from None
            except urllib.error.URLError:
                if attempt == self.attempts:
                    raise
            time.sleep(0.2 * 2**attempt)
        raise AssertionError("no attempt")


class RangeQueries(DataSource):
    @classmethod
    def name(cls) -> str:
        return "range_queries"

    def schema(self) -> StructType:
        return StructType([StructField("query", StringType()), StructField("body", StringType())])

    def reader(self, schema: StructType) -> RangeReader:
        return RangeReader(dict(self.options))


def range_answers(spark: SparkSession, url: str, body: dict | None = None, points: int = POINTS, attempts: int = 3) -> DataFrame:
    """(query, body) of the answers to a backfill request, for range_rows(): a row for each query and stretch."""
    asked = backfill_request(body)
    spark.dataSource.register(RangeQueries)
    options = {"url": url, "queries": json.dumps(asked["queries"]), "start": str(asked["start"]), "end": str(asked["end"]), "step": str(asked["step"]), "points": str(points), "attempts": str(attempts)}
    return spark.read.format("range_queries").options(**options).load()
