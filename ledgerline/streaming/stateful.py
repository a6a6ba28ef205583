"""Sessions and counters over a stream, with late rows reported.

Keys share groups by their hash, and a group's rows are kept in blocks of Arrow data: open sessions, or the samples that the watermark has not passed, by their time, and the last one of each key
before them. So a batch costs a few calls to the state for a group, not some for each row, and a task holds a piece of the rows that come and some hours of those that become final.
One event-time timer a group, which Spark's watermark moves, wakes it when the watermark has passed a session or a sample: that is final. A row that comes when the
watermark has passed its time is late: it comes out as such and is in no other result, so results and late rows together are all rows. Spark itself drops late rows before a
stateful operator by the mark that a watermark leaves on its column, so the operator gets the time as another column.

Each partition of a state has a store that every batch loads and commits, rows or none, so ``started`` gives a stream no more of them than there are groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

SESSION = "kind string, key string, first long, last long, events long, at long, id long"
SAMPLE = "kind string, key string, at long, id long, value double, increase double"
#: Groups that keys are dealt to: part of a stream's state, so not to be changed under a checkpoint.
GROUPS = 64
#: Rows that a task gathers before it puts them into the state or makes them final, and microseconds of samples that share a block.
HELD, SLOT = 250_000, 6 * 3_600_000_000


def _packed(frame: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(block: Any) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(block)).read_pandas()


def _frame(schema: str, kind: str, **columns: Any) -> pd.DataFrame:
    """Rows of one kind; columns that are not given are null."""
    rows = len(columns["key"])
    kinds = {"string": "object", "long": "Int64", "double": "Float64"}
    given = {"kind": [kind] * rows, **columns}
    return pd.DataFrame({n: given[n] if n in given else pd.array([None] * rows, dtype=kinds[t]) for n, t in (c.split() for c in schema.split(", "))})


def _ids(frame: pd.DataFrame) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(frame["id"].to_numpy(np.int64), frame["no_id"].to_numpy(bool))


def _keys(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's key, keys by number); null is a key."""
    codes, keys = pd.factorize(rows["key"], use_na_sentinel=False)
    return codes, np.array([None if pd.isna(k) else k for k in keys], object)


class Finals(StatefulProcessor):
    """What both processors share: late rows out, a timer for what is to become final. Times are microseconds."""

    schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.due = handle.getValueState("due", "at long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        held: list[pd.DataFrame] = []
        for frame in rows:
            late = frame["at"] < watermark
            if late.any():
                yield self.late(frame[late])
            held.append(frame[~late])
            if sum(map(len, held)) >= HELD:
                self.keep(pd.concat(held))
                held = []
        if sum(map(len, held)):
            self.keep(pd.concat(held))

    def late(self, rows: pd.DataFrame) -> pd.DataFrame:
        given = {"key": rows["key"].to_numpy(), "at": rows["at"].to_numpy(), "id": _ids(rows)}
        return _frame(self.schema, "late", **given, **({"value": rows["value"].to_numpy()} if "value" in rows else {}))

    def keep(self, rows: pd.DataFrame) -> None:
        raise NotImplementedError

    def wake(self, after: int) -> None:
        """A timer for when the watermark has passed a time; a group has one, the earliest that was asked for."""
        at, due = int(after) // 1000 + 1, self.due.get()
        if due is None or at < due[0]:
            if due is not None:
                self.handle.deleteTimer(due[0])
            self.handle.registerTimer(at)
            self.due.update((at,))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self.due.clear()
        yield from self.finals(timerValues.getCurrentWatermarkInMs() * 1000)

    def finals(self, watermark: int) -> Iterator[pd.DataFrame]:
        """What the watermark has passed, taken out of the state."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class Sessions(Finals):
    """(key, at, id) to the sessions of each key: runs of rows with less than ``gap`` between neighbours."""

    schema = SESSION

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.open = handle.getListState("open", "data binary")

    def joined(self, parts: pd.DataFrame) -> pd.DataFrame:
        """(key, first, last, events) of parts of sessions, with those that belong together as one."""
        codes, keys = _keys(parts)
        order = np.lexsort((parts["first"].to_numpy(), codes))
        codes, (first, last, events) = codes[order], (parts[c].to_numpy()[order] for c in ("first", "last", "events"))
        upto = pd.Series(last).groupby(codes).cummax().to_numpy()
        fresh = np.ones(len(codes), bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (first[1:] >= upto[:-1] + self.gap)
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(codes)) - 1
        return pd.DataFrame({"key": keys[codes[starts]], "first": first[starts], "last": upto[ends], "events": np.add.reduceat(events, starts)})

    def keep(self, rows: pd.DataFrame) -> None:
        parts = self.joined(pd.DataFrame({"key": rows["key"].to_numpy(), "first": rows["at"].to_numpy(), "last": rows["at"].to_numpy(), "events": np.ones(len(rows), np.int64)}))
        self.open.appendValue((_packed(parts),))
        self.wake(parts["last"].min() + self.gap)

    def finals(self, watermark: int) -> Iterator[pd.DataFrame]:
        blocks = [_unpacked(data) for (data,) in self.open.get()]
        if not blocks:
            return
        found = self.joined(pd.concat(blocks))
        done = found["last"] + self.gap <= watermark
        self.open.clear()
        if not done.all():
            self.open.appendValue((_packed(found[~done]),))
            self.wake(found["last"][~done].min() + self.gap)
        if done.any():
            yield _frame(SESSION, "session", **{c: found[c][done].to_numpy() for c in found.columns})


class Increases(Finals):
    """(key, at, id, value) to what each counter gained since the sample before; after a reset the value itself."""

    schema = SAMPLE

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.waiting = handle.getMapState("waiting", "slot long, part long", "data binary")
        self.parts = handle.getValueState("parts", "next long")
        self.last = handle.getValueState("last", "data binary")

    def put(self, rows: pd.DataFrame) -> None:
        """Rows into the blocks of their slots, which are numbered as they come."""
        slots = rows["at"].to_numpy() // SLOT
        order = np.argsort(slots, kind="stable")
        rows, slots = rows.iloc[order], slots[order]
        part = self.parts.get()[0] if self.parts.exists() else 0
        for start, end in zip(starts := np.flatnonzero(np.append(True, slots[1:] != slots[:-1])), np.append(starts[1:], len(slots))):
            self.waiting.updateValue((int(slots[start]), part), (_packed(rows.iloc[start:end]),))
        self.parts.update((part + 1,))

    def keep(self, rows: pd.DataFrame) -> None:
        self.put(rows[["key", "at", "id", "no_id", "value"]])
        self.wake(rows["at"].min())

    def finals(self, watermark: int) -> Iterator[pd.DataFrame]:
        places = sorted(self.waiting.keys())
        later = [slot * SLOT for slot, _ in places if slot * SLOT >= watermark]
        before: dict = {}
        if self.last.exists():
            last = _unpacked(self.last.get()[0])
            before = dict(zip(last["key"].to_numpy(object, na_value=None), last["value"].tolist()))
        blocks: list[pd.DataFrame] = []
        passed = [place for place in places if place[0] * SLOT < watermark]
        for place, after in zip(passed, [*passed[1:], None]):
            blocks.append(_unpacked(self.waiting.getValue(place)[0]))
            self.waiting.removeKey(place)
            if after and (after[0] == place[0] or sum(map(len, blocks)) < HELD):  # a slot is never parted
                continue
            rows, blocks = pd.concat(blocks), []
            done = rows["at"] < watermark
            if not done.all():
                self.put(rows[~done])
                later.append(rows["at"][~done].min())
            if done.any():
                yield self.grown(rows[done], before)
        if before:
            self.last.update((_packed(pd.DataFrame({"key": pd.Series(list(before), dtype=object), "value": list(before.values())})),))
        if later:
            self.wake(min(later))

    def grown(self, rows: pd.DataFrame, before: dict) -> pd.DataFrame:
        """Samples in the order of key, time and id with what they gained; ``before`` has the last value of each key and is brought up to date."""
        rows = rows.drop_duplicates(["key", "at", "id", "no_id"], keep="last")
        codes, names = _keys(rows)
        order = np.lexsort((rows["id"].to_numpy(), rows["no_id"].to_numpy(), rows["at"].to_numpy(), codes))
        rows, codes = rows.iloc[order], codes[order]
        values = rows["value"].to_numpy(np.float64)
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        previous, unknown = np.append(0.0, values[:-1]), np.zeros(len(rows), bool)
        for start in starts:
            name = names[codes[start]]
            unknown[start] = name not in before
            previous[start] = before.get(name, 0.0)
        for end in np.append(starts[1:], len(rows)) - 1:
            before[names[codes[end]]] = float(values[end])
        gained = np.where(values >= previous, values - previous, values)
        return _frame(SAMPLE, "sample", key=names[codes], at=rows["at"].to_numpy(), id=_ids(rows), value=values, increase=pd.arrays.FloatingArray(gained, unknown))


def _final(stream: DataFrame, key: str, time: str, late: str, id: str, columns: dict[str, str], processor: Finals) -> DataFrame:
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    number = F.col(id).cast("bigint")
    named = stream.where(F.col(time).isNotNull()).select(
        F.col(key).cast("string").alias("key"), F.col(time).cast("timestamp").alias("__time"), F.coalesce(number, F.lit(0)).alias("id"), number.isNull().alias("no_id"), *(F.col(c).cast(t).alias(c) for c, t in columns.items())
    )
    unmarked = named.withWatermark("__time", late).withColumn("at", F.unix_micros("__time")).drop("__time")
    dealt = unmarked.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(GROUPS)))
    return dealt.groupBy("group").transformWithStateInPandas(processor, processor.schema, "Append", "EventTime")


def started(spark: SparkSession, writer: DataStreamWriter) -> StreamingQuery:
    """Starts a stream of sessions or increases with at most as many partitions as there are groups; one that goes on from a checkpoint keeps those it has there."""
    name = "spark.sql.shuffle.partitions"
    given = spark.conf.get(name)
    spark.conf.set(name, str(min(int(given), GROUPS)))  # a stream takes the settings that hold when it starts
    try:
        return writer.start()
    finally:
        spark.conf.set(name, given)


def stream_sessions(stream: DataFrame, key: str, time: str, id: str, gap_seconds: int = 1800, late: str = "10 minutes") -> DataFrame:
    """(kind, key, session_start, last_event, events, at, id) as a stream: sessions that are final, and late rows.

    ``kind`` is session, with start, end and number, or late, with the row's time and id. Null keys are one key, rows without a time are left out.
    """
    found = _final(stream, key, time, late, id, {}, Sessions(gap_seconds * 1_000_000))
    return found.select("kind", "key", F.timestamp_micros("first").alias("session_start"), F.timestamp_micros("last").alias("last_event"), "events", F.timestamp_micros("at").alias("at"), "id")


def stream_increases(stream: DataFrame, key: str, time: str, id: str, value: str, late: str = "10 minutes") -> DataFrame:
    """(kind, key, at, id, value, increase) as a stream: samples that are final, in the order of time and id, and late ones, whose increase is null.

    Samples of one key, time and id are one sample; those without a time or a value are left out.
    """
    known = stream.where(F.col(value).isNotNull()).select(F.col(key).alias("key"), F.col(time).alias("time"), F.col(id).alias("id"), F.col(value).alias("value"))
    found = _final(known, "key", "time", late, "id", {"value": "double"}, Increases())
    return found.withColumn("at", F.timestamp_micros("at"))
