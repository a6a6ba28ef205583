"""Incremental loads: intervals with overlap, checkpoints, and streams into tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.versions import latest_checkpoint
from ledgerline.schemas import OFFSETS

LOOKBACK = timedelta(seconds=120)


def interval(start: datetime | None, end: datetime, lookback: timedelta = LOOKBACK) -> tuple[datetime, datetime]:
    """The given interval, or the one of ``lookback`` before its end if it is empty or has no start."""
    return (start, end) if start is not None and start < end else (end - lookback, end)


def run_micro_batch(
    source: DataFrame,
    offsets: DataFrame,
    end: datetime,
    write: Callable[[DataFrame], None],
    source_name: str,
    checkpoint_name: str,
    time: str = "event_time",
    id: str = "document_id",
    lookback: timedelta = LOOKBACK,
) -> DataFrame:
    """Loads [checkpoint - lookback, end) and returns the offsets with the new checkpoint.

    The rows are written before the checkpoint moves, so a crash in between repeats the
    interval; versions collapse repeats. Without a row nothing is written and the checkpoint stays. ``write`` must write, not only plan to. A
    record that comes later than the lookback after the last one seen is not loaded.
    """
    last = latest_checkpoint(offsets, source_name, checkpoint_name).select("last_event_time").first()
    start = (last["last_event_time"] if last else end) - lookback
    batch = source.where((F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(end)))
    if batch.isEmpty():
        return offsets
    seen = Observation()
    write(batch.observe(seen, F.max(F.struct(time, id)).alias("top")))  # the last record is noted while the rows are written
    top = seen.get["top"]
    row = [(source_name, checkpoint_name, top[0], top[1], end)]
    return offsets.unionByName(offsets.sparkSession.createDataFrame(row, OFFSETS))


def stream_into(df: DataFrame, path: str, checkpoint: str, name: str, once: bool = True, every: str = "30 seconds", partition: str | None = None) -> StreamingQuery:
    """Appends a stream to Parquet files, exactly once; ``once`` takes what is there and ends."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).queryName(name)
    if partition:
        writer = writer.partitionBy(partition)
    return writer.trigger(availableNow=True).start() if once else writer.trigger(processingTime=every).start()


def stream_routed(df: DataFrame, routes: dict[str, str], folder: str, checkpoint: str, name: str, once: bool = True) -> StreamingQuery:
    """Appends each topic's rows to its table's folder, at least once: replays are collapsed by key when read."""
    from ledgerline.sources.changes import routed

    def put(batch: DataFrame, _: int) -> None:
        kept = batch.persist()
        try:
            for table, rows in routed(kept, routes).items():
                rows.write.mode("append").parquet(f"{folder}/{table}")
        finally:
            kept.unpersist()

    writer = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).queryName(name)
    return writer.trigger(availableNow=True).start() if once else writer.trigger(processingTime="30 seconds").start()


def start_or_replace(df: DataFrame, name: str, start: Callable[[DataFrame], StreamingQuery], instead_of: Iterable[str] = ()) -> StreamingQuery:
    """Starts a named stream after stopping one of that name, and those named in ``instead_of``: sources of which one may be active."""
    gone = {name, *instead_of}
    for query in df.sparkSession.streams.active:
        if query.name in gone:
            query.stop()
            query.awaitTermination()
    return start(df)


def without_repeats(df: DataFrame, key: list[str], time: str, late: str = "2 minutes") -> DataFrame:
    """A stream without repeated keys; state is kept for the time that records may be late."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def tumbling(df: DataFrame, time: str, length: str, keys: list[str], late: str = "2 minutes") -> DataFrame:
    """Counts per window and key, for streams (closed windows come out) and tables alike."""
    source = df.withWatermark(time, late) if df.isStreaming else df
    counted = source.groupBy(F.window(time, length), *keys).agg(F.count("*").alias("events"))
    return counted.select(F.col("window.start").alias("window_start"), *keys, "events")
