"""Stores that are read in pages: slices of a key as partitions, and in each a cursor that goes on after the last row of a page.

A store gives the pages of a slice in the order of (key, id). A search answers ``page``, the first rows after a given row, until one is short; files are read once for a slice,
whose rows go to the task's own temporary folder as sorted runs and are merged, so a task holds pieces and never a slice. Slices are half open and leave no key out, rows without a key have a slice of
their own, and a slice that is read again gives the same rows: what changes in between is kept out by the store's snapshot. Comparisons with the key
become the slices' bounds.
"""

from __future__ import annotations

import json
import tempfile
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal
from functools import cached_property
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

PAGE, SLICES = 1000, 8
HITS = ("_index", "_id", "_source")
#: Bytes of rows that are sorted at once, and of a batch of a file or a run.
RUN, BATCH = 32 << 20, 2 << 20


@dataclass
class Slice(InputPartition):
    """Keys from ``low`` on to before ``high`` (including it where ``closed``); rows without a key where both are None."""

    low: Any
    high: Any
    closed: bool = False
    snapshot: str = ""

    def __post_init__(self):
        self.value = None


class FilePages:
    """Parquet files as a store. Row groups outside a slice are not read, those inside in batches.

    Options: path, key and id, by which rows are told apart.
    """

    def __init__(self, options: dict[str, str]):
        self.path, self.key, self.id = options["path"], options["key"], options["id"]

    @cached_property
    def files(self) -> ds.Dataset:
        return ds.dataset(self.path, format="parquet")

    def schema(self) -> StructType:
        return from_arrow_schema(self.files.schema, prefer_timestamp_ntz=True)

    def snapshot(self) -> str:
        """The files that are there: those that come later are not read."""
        return json.dumps(sorted(self.files.files))

    def bounds(self) -> tuple[Any, Any, bool]:
        """Least and greatest key, and whether rows without one are there; from the files' statistics where they have them."""
        low = high = None
        missing = False
        for part in self.files.get_fragments():
            for group in part.row_groups:
                of = group.statistics.get(self.key) if group.statistics else None
                chunk = None
                if not of or of.get("min") is None:
                    chunk = part.subset(row_group_ids=[group.id]).to_table(columns=[self.key])[self.key]
                    of = pc.min_max(chunk).as_py()
                counted = part.metadata.row_group(group.id).column(self.files.schema.get_field_index(self.key)).statistics
                missing |= bool(counted.null_count) if counted and counted.has_null_count else True
                low = of["min"] if low is None or of["min"] is not None and of["min"] < low else low
                high = of["max"] if high is None or of["max"] is not None and of["max"] > high else high
        return low, high, missing

    def batches(self, at: Slice, needed: list[str]) -> Iterator[pa.Table]:
        """The rows of a slice as they lie, a batch at a time."""
        key, schema = ds.field(self.key), pa.schema([self.files.schema.field(c) for c in needed])
        inside = key.is_null() if at.low is None else (key >= at.low) & ((key <= at.high) if at.closed else (key < at.high))
        files = ds.dataset(json.loads(at.snapshot), format="parquet", schema=self.files.schema, filesystem=self.files.filesystem) if at.snapshot else self.files
        for part in files.get_fragments():
            groups = [g for g in part.subset(inside, schema=self.files.schema).row_groups if g.num_rows]
            if not groups:
                continue
            rows = max(64, min(1 << 16, BATCH * sum(g.num_rows for g in groups) // max(1, sum(g.total_byte_size for g in groups))))
            with files.filesystem.open_input_file(part.path) as source, pq.ParquetFile(source, buffer_size=1 << 20) as file:
                there = [c for c in needed if c in file.schema_arrow.names]
                for batch in file.iter_batches(rows, [g.id for g in groups], there, use_threads=False):
                    table = pa.table({f.name: batch[f.name].cast(f.type) if f.name in there else pa.nulls(batch.num_rows, f.type) for f in schema}, schema)
                    found = table.filter(inside)
                    if found.num_rows:
                        yield found

    def pages(self, at: Slice, size: int, columns: list[str]) -> Iterator[pa.Table]:
        order = [(self.key, "ascending"), (self.id, "ascending")]
        with tempfile.TemporaryDirectory(prefix="paged-") as folder:
            runs: list[str] = []
            held: list[pa.Table] = []
            for batch in self.batches(at, list(dict.fromkeys([*columns, self.key, self.id]))):
                held.append(batch)
                if sum(t.nbytes for t in held) >= RUN:
                    runs.append(stored(pa.concat_tables(held).sort_by(order), f"{folder}/{len(runs)}"))
                    held = []
            last = [pa.concat_tables(held).sort_by(order)] if held else []
            if runs and last:
                runs.append(stored(last.pop(), f"{folder}/{len(runs)}"))
            yield from in_pages((t.select(columns) for t in (merged(runs, order) if runs else last)), size)


def stored(run: pa.Table, path: str) -> str:
    with pa.OSFile(path, "wb") as sink, pa.ipc.new_file(sink, run.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(run, max_chunksize=max(64, BATCH * run.num_rows // max(1, run.nbytes)))
    return path


def merged(runs: list[str], order: list[tuple[str, str]]) -> Iterator[pa.Table]:
    """The rows of sorted runs in one order, with about a batch of each run in memory.

    The last row of each batch is marked while its run goes on: what is sorted before the first marked row, and that row, nothing that is not read yet comes before.
    """
    files = [pa.OSFile(path) for path in runs]
    readers = [pa.ipc.open_file(f) for f in files]
    batches = [iter(range(r.num_record_batches)) for r in readers]
    waiting: list[pa.Table] = []
    more = list(range(len(runs)))
    while more or waiting:
        for k in more:
            at = next(batches[k], None)
            if at is not None:
                table = pa.table(readers[k].get_batch(at))
                ends = pa.array([None] * (table.num_rows - 1) + [k if at + 1 < readers[k].num_record_batches else None], pa.int32())
                waiting.append(table.append_column("__run", ends))
        if not waiting:
            break
        rows = pa.concat_tables(waiting).sort_by(order)
        marked = pc.indices_nonzero(pc.is_valid(rows["__run"]))
        upto = marked[0].as_py() + 1 if len(marked) else rows.num_rows
        yield rows.slice(0, upto).drop_columns("__run")
        more = [rows["__run"][upto - 1].as_py()] if len(marked) else []
        waiting = [rows.slice(upto).combine_chunks()] if upto < rows.num_rows else []
    for f in files:
        f.close()


def in_pages(tables: Iterator[pa.Table] | list[pa.Table], size: int) -> Iterator[pa.Table]:
    """The same rows in tables of ``size`` rows, the last one aside."""
    held: pa.Table | None = None
    for table in tables:
        held = table if held is None else pa.concat_tables([held, table])
        whole = held.num_rows // size * size
        for start in range(0, whole, size):
            yield held.slice(start, size)
        held = held.slice(whole).combine_chunks()
    if held is not None and held.num_rows:
        yield held


class SearchPages:
    """A document store's search over HTTP: one point in time for all slices, and pages by ``search_after``.

    Options: url, index, key (a time, @timestamp), start and end (both or none), keepalive, attempts at a page that fails with the server's fault.
    """

    def __init__(self, options: dict[str, str]):
        self.url, self.index, self.key = options["url"].rstrip("/"), options["index"], options.get("key", "@timestamp")
        self.keep, self.attempts = options.get("keepalive", "5m"), int(options.get("attempts", "3"))
        self.low, self.high = options.get("start"), options.get("end")

    def schema(self) -> StructType:
        return StructType([StructField(n, StringType()) for n in HITS])

    def _ask(self, path: str, body: dict | None = None) -> dict:
        data = json.dumps(body or {}).encode()
        for attempt in range(1, self.attempts + 1):
            try:
                request = urllib.request.Request(f"{self.url}/{path}", data, {"Content-Type": "application/json"}, method="POST")
                with urllib.request.urlopen(request, timeout=180) as answer:
                    return json.load(answer)
            except urllib.error.HTTPError as e:
                if e.code < 500 and e.code != 429 or attempt == self.attempts:
                    raise
            except urllib.error.URLError:
                if attempt == self.attempts:
                    raise
            time.sleep(0.2 * 2**attempt)
        raise ValueError("attempts must be at least 1")

    def snapshot(self) -> str:
        return self._ask(f"{self.index}/_pit?keep_alive={self.keep}")["id"]

    def bounds(self) -> tuple[Any, Any, bool]:
        if self.low and self.high:
            ends = [datetime.fromisoformat(x.replace("Z", "+00:00")) for x in (self.low, self.high)]
            return ends[0], ends[1], False
        found = self._ask(f"{self.index}/_search", {"size": 0, "aggs": {"low": {"min": {"field": self.key}}, "high": {"max": {"field": self.key}}, "none": {"missing": {"field": self.key}}}})["aggregations"]
        low, high = (None if found[k]["value"] is None else datetime.fromtimestamp(found[k]["value"] / 1000).astimezone() for k in ("low", "high"))
        return low, high, found["none"]["doc_count"] > 0

    def page(self, at: Slice, after: tuple | None, size: int, columns: list[str]) -> tuple[pa.Table, tuple | None]:
        if at.low is None:
            inside: dict = {"bool": {"must_not": [{"exists": {"field": self.key}}]}}
        else:
            inside = {"range": {self.key: {"gte": at.low.isoformat(), "lte" if at.closed else "lt": at.high.isoformat()}}}
        body = {"size": size, "query": {"bool": {"filter": [inside]}}, "sort": [{self.key: "asc"}, {"_shard_doc": "asc"}], "pit": {"id": at.snapshot, "keep_alive": self.keep}}
        if after is not None:
            body["search_after"] = list(after)
        hits = self._ask("_search", body)["hits"]["hits"]
        made = {"_index": [h["_index"] for h in hits], "_id": [h["_id"] for h in hits], "_source": [json.dumps(h["_source"], ensure_ascii=False, separators=(",", ":")) for h in hits]}
        return pa.table({c: pa.array(made[c], pa.string()) for c in columns}), hits and tuple(hits[-1]["sort"]) or None

    def pages(self, at: Slice, size: int, columns: list[str]) -> Iterator[pa.Table]:
        after, short = None, False
        while not short:
            page, after = self.page(at, after, size, columns)
            short = page.num_rows < size
            yield page


STORES = {"files": FilePages, "search": SearchPages}


def between(low: Any, high: Any, n: int) -> list[Any]:
    """Up to n + 1 ascending bounds from ``low`` to ``high``, about equally far apart; text is not divided."""
    if low == high or n < 2 or isinstance(low, (str, bytes)):
        return [low, high]
    step: Any
    if isinstance(low, datetime):
        step = (high - low) / n
        inner = [low + step * k for k in range(1, n)]
    elif isinstance(low, date):
        inner = [low + timedelta(days=(high - low).days * k // n) for k in range(1, n)]
    else:
        inner = [low + (high - low) * k // n if isinstance(low, (int, Decimal)) else low + (high - low) * k / n for k in range(1, n)]
    return sorted({low, *inner, high})


class PagedReader(DataSourceReader):
    """Options: store (files or search), slices, pagesize, and those of the store."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.store = STORES[options.get("store", "files")](options)
        self.slices, self.size = int(options.get("slices", SLICES)), int(options.get("pagesize", PAGE))
        if self.slices < 1 or self.size < 1:
            raise ValueError("slices and pagesize must be at least 1")
        self.columns = schema.fieldNames()
        self.least: Any = None
        self.most: Any = None
        self.known = False  # whether a filter leaves rows without a key out

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons with the key narrow the slices; Spark still applies all of them."""
        for f in filters:
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) and f.attribute == (self.store.key,) and f.value is not None:
                self.known = True
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.least = f.value if self.least is None else max(self.least, f.value)
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.most = f.value if self.most is None else min(self.most, f.value)
            yield f

    def partitions(self) -> list[Slice]:
        low, high, missing = self.store.bounds()
        snapshot = self.store.snapshot()
        out = [Slice(None, None, False, snapshot)] if missing and not self.known else []
        if low is not None:
            low, high = (low if self.least is None else max(low, self.least)), (high if self.most is None else min(high, self.most))
            if low <= high:
                ends = between(low, high, self.slices)
                out += [Slice(a, b, k == len(ends) - 2, snapshot) for k, (a, b) in enumerate(zip(ends, ends[1:]))]
        return out or [Slice(None, None, False, snapshot)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        for page in self.store.pages(partition, self.size, self.columns):
            yield from page.combine_chunks().to_batches()


class Paged(DataSource):
    """``spark.read.format("paged")``: see PagedReader for options."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> StructType:
        return STORES[self.options.get("store", "files")](self.options).schema()

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(dict(self.options), schema)


def read_pages(spark: SparkSession, **options: str) -> DataFrame:
    """A table of a store that is read in pages, with filters on the key pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Paged)
    return spark.read.format("paged").options(**options).load()
