"""A record of what was run: one row for each query or program, appended to a folder."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import SparkSession

#: Characters of a value that a record shows, and of a program's source.
MOST_SHOWN, MOST_SOURCE_SHOWN = 8000, 600
SCHEMA = "name string, started timestamp, ended timestamp, level string, message string, input string, output string"


def shortened(value: Any, most: int = MOST_SHOWN) -> Any:
    """The value, or the start of its JSON where that is long."""
    try:
        text = json.dumps(value, ensure_ascii=False)
    except TypeError:
        text = str(value)
    return value if len(text) <= most else {"truncated": True, "chars": len(text), "preview": text[:most]}


def without_source(arguments: dict) -> dict:
    """A call's arguments with the start of a program's source in place of all of it."""
    source = arguments.get("source_code")
    return arguments if source is None else arguments | {"source_code": {"chars": len(str(source)), "preview": str(source)[:MOST_SOURCE_SHOWN]}}


class Trace:
    """Appends records to Parquet files. What goes wrong with a record does not touch the call it is about."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def record(self, name: str, started: datetime, given: Any, output: Any, level: str = "DEFAULT", message: str | None = None) -> bool:
        shown = [json.dumps(shortened(x), ensure_ascii=False, default=str) for x in (given, output)]
        try:
            row = (name, started, datetime.now(UTC), level, message, *shown)
            self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)
        except Exception as e:
            print(f"no record of {name}: {e}")
            return False
        return True

    def call(self, name: str, work: Callable[..., Any], **given: Any) -> Any:
        """work(**given), recorded with its answer or its error, which is raised again."""
        started = datetime.now(UTC)
        try:
            answer = work(**given)
        except Exception as e:
            self.record(name, started, without_source(given), {"error": str(e)}, "ERROR", str(e))
            raise
        self.record(name, started, without_source(given), answer)
        return answer
