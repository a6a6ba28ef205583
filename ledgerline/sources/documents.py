"""Log documents: range scans, rows of elasticsearch_events_raw, and bulk files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.expressions import best_effort_time, millis


def document_time(document_json: Column, field: str = "@timestamp", otherwise: Column | None = None) -> Column:
    """A top-level field as a time; where it is missing or no time, the time of loading.

    Dots in the field's name are part of the name, so a nested path finds nothing.
    """
    found = best_effort_time(F.get_json_object(document_json, f"$['{field}']"))
    return millis(F.coalesce(found, F.current_timestamp() if otherwise is None else otherwise))


def hit_rows(hits: DataFrame, source_name: str, version: int, field: str = "@timestamp") -> DataFrame:
    """Rows of elasticsearch_events_raw from (_index, _id, _source as JSON text)."""
    return hits.select(
        F.lit(source_name).alias("source_name"),
        F.col("_index").alias("index_name"),
        F.col("_id").alias("document_id"),
        document_time(F.col("_source"), field).alias("event_time"),
        millis(F.current_timestamp()).alias("ingest_time"),
        F.col("_source").alias("document_json"),
        F.lit(version).cast("bigint").alias("version"),
    )


def range_scan(documents: DataFrame, start, end, pattern: str = "*") -> DataFrame:
    """Documents of the indexes that fit a pattern with start <= event_time < end."""
    like = pattern.replace("%", r"\%").replace("_", r"\_").replace("*", "%")
    in_time = (F.col("event_time") >= F.lit(start)) & (F.col("event_time") < F.lit(end))
    return documents.where(F.col("index_name").like(like) & in_time)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, block, value) of the lines of text files that are not blank; a block is the part of a file that one task reads."""
    text = spark.read.option("lineSep", "\n").text(path)
    read = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.rtrim("value", F.lit("\r")).alias("value"))
    return read.where(~F.col("value").rlike(r"^\s*$")).withColumn("block", F.xxhash64("file", "start"))


def _openings(lines: DataFrame) -> dict[int, str | None]:
    """By block: the action whose document is the block's first line; None where it starts with an action.

    Lines of a file count on from block to block, even ones are actions. One number for each block comes to the driver, and the last line
    of the block before where that is an action.
    """
    blocks = lines.withColumn("__at", F.monotonically_increasing_id()).groupBy("file", "start", "block").agg(F.count("*").alias("n"), F.max_by("value", "__at").alias("last"))
    in_file = Window.partitionBy("file").orderBy("start")  # one row for each block
    before = F.coalesce(F.sum("n").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = blocks.select("file", "block", before.alias("before"), (before + F.col("n")).alias("upto"), F.lag("last").over(in_file).alias("action"), F.lead("block").over(in_file).isNull().alias("is_last"))
    open_files = ends.where(F.col("is_last") & (F.col("upto") % 2 == 1)).select("file").first()
    if open_files:
        raise ValueError(f"the last action of {open_files[0]} has no document")
    rows = ends.select("block", F.when(F.col("before") % 2 == 1, F.col("action")).alias("action")).collect()
    found = {r["block"]: r["action"] for r in rows}
    if len(found) < len(rows):
        raise RuntimeError("two blocks of files have one hash")
    return found


def _pairs(openings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, waiting = None, None
        for batch in batches:
            values, blocks = batch.column("value"), batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
            for first, end in zip(edges, edges[1:]):
                if first == end:
                    continue
                if blocks[first] != current:  # an action at the end of the block before belongs to the opening of its next
                    current = int(blocks[first])
                    if current not in openings.value:
                        raise RuntimeError("files were split in another way when their lines were counted")
                    waiting = openings.value[current]
                lines = values.slice(first, end - first)
                if waiting is not None:
                    lines = pa.concat_arrays([pa.array([waiting], lines.type), lines])
                waiting = lines[-1].as_py() if len(lines) % 2 else None
                whole = np.arange(0, len(lines) - len(lines) % 2, 2)
                yield pa.RecordBatch.from_arrays([lines.take(pa.array(whole)), lines.take(pa.array(whole + 1))], ["action", "_source"])

    return run


def bulk_hits(spark: SparkSession, path: str) -> DataFrame:
    """(_index, _id, _source) of bulk files, in which a line for the action (index or create) and one for the document alternate.

    Which a line is, its place in the file says, never what it holds: documents may hold any text. A first pass counts the lines of each
    part of a file that one task reads, so that a second one knows with which kind its part starts and, for a document, its action;
    documents are not shuffled. Blank lines do not count. A line that is no action where one must stand, a document that is no JSON, and a last action without
    a document raise. A file without lines, or none, gives no row. What goes to the tasks is one number, and at most one action, for each part of a file.
    """
    lines = _lines(spark, path)
    openings = spark.sparkContext.broadcast(_openings(lines))
    pairs = lines.select("block", "value").mapInArrow(_pairs(openings), "action string, _source string")
    named = F.coalesce(F.get_json_object("action", "$.index"), F.get_json_object("action", "$.create"))
    wrong = lambda what, c: F.raise_error(F.concat(F.lit(f"no {what}: "), F.substring(c, 1, 80))).cast("string")
    action = F.coalesce(named, wrong("action", "action")).alias("action")
    document = F.when(F.get_json_object("_source", "$").isNotNull(), F.col("_source")).otherwise(wrong("document", "_source")).alias("_source")
    return pairs.select(action, document).select(F.get_json_object("action", "$._index").alias("_index"), F.get_json_object("action", "$._id").alias("_id"), "_source")


def ordered(documents: DataFrame, field: str, *then: str) -> DataFrame:
    """Documents by a field that some tables do not have: it is null there; nulls come last."""
    known = documents if field in documents.columns else documents.withColumn(field, F.lit(None).cast("string"))
    return known.orderBy(F.asc_nulls_last(field), *then)
