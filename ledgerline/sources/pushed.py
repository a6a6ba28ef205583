"""Payloads that are pushed to a landing folder, and the stream that reads them with offsets of its own.

Each receiver writes its payloads as files with numbers that count on, so an offset is a number for each receiver: all files below it have
been read. A file appears under its name only when it is whole. A batch is the files between two offsets, whatever comes meanwhile, so a batch that is
repeated after a crash reads the same files; files go when the batch that read them has been committed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "receiver string, number long, content binary"
#: Fixed value: bytes of a payload at most.
MOST_BODY = 50 * 1024 * 1024
#: Files that one task reads, and files of a batch at most; the rest waits for the next one.
FILES, BATCH = 64, 4096


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def _numbers(store: fs.FileSystem, folder: str) -> dict[str, list[int]]:
    """The numbers of whole payloads that are there, by receiver, ascending."""
    out: dict[str, list[int]] = {}
    for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True)):
        if info.type == fs.FileType.File and info.base_name.endswith(".body"):
            receiver = info.path.rstrip("/").split("/")[-2]
            out.setdefault(receiver, []).append(int(info.base_name.removesuffix(".body")))
    return {r: sorted(n) for r, n in sorted(out.items())}


class Receiver:
    """Appends payloads under one name. One process owns a name at a time; a new one goes on where the last stopped."""

    def __init__(self, uri: str, name: str):
        if not name or "/" in name:
            raise ValueError(f"not a receiver's name: {name!r}")
        self.store, folder = _folder(uri)
        self.folder = f"{folder.rstrip('/')}/{name}"
        self.store.create_dir(self.folder, recursive=True)
        found = _numbers(self.store, self.folder).get(name, [])
        self.next = max([n + 1 for n in found] + [self._committed()])

    def _committed(self) -> int:
        """What a stream has read and deleted, from the marks that it leaves."""
        marks = [i.base_name for i in self.store.get_file_info(fs.FileSelector(self.folder)) if i.base_name.endswith(".read")]
        return max((int(m.removesuffix(".read")) for m in marks), default=0)

    def append(self, body: bytes) -> int:
        """The payload's number, when it is safe."""
        if len(body) > MOST_BODY:
            raise ValueError(f"a payload of {len(body)} bytes, more than {MOST_BODY}")
        part = f"{self.folder}/{uuid.uuid4().hex}.part"
        with self.store.open_output_stream(part) as out:
            out.write(body)
        self.store.move(part, f"{self.folder}/{self.next:020d}.body")
        self.next += 1
        return self.next - 1


@dataclass
class Files(InputPartition):
    receiver: str
    numbers: list[int]

    def __post_init__(self):
        self.value = None


class PushedReader(DataSourceStreamReader):
    """Options: path, the landing folder; batch, files at most in a batch."""

    def __init__(self, options: dict[str, str]):
        self.path, self.batch = options["path"], int(options.get("batch", BATCH))
        self.at: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """One more than each receiver's last number before a gap. A batch ends when it is full, but a reader that has just started does not know what
        has been read before it, so it takes all that is there: an end must never lie before the start.
        """
        store, folder = _folder(self.path)
        now, left = {}, self.batch
        for receiver, numbers in _numbers(store, folder).items():
            known = self.at.get(receiver)
            upto = numbers[0] if known is None else known
            for n in numbers:
                if n == upto and (left > 0 or known is None):
                    upto, left = upto + 1, left - 1
            now[receiver] = upto
        self.at |= now
        return dict(self.at)

    def partitions(self, start: dict, end: dict) -> list[Files]:
        store, folder = _folder(self.path)
        self.at |= {r: max(n, self.at.get(r, 0)) for r, n in end.items()}
        out = []
        for receiver, upto in sorted(end.items()):
            # A receiver that the start does not know begins with its first file: none is deleted before it is committed.
            first = start.get(receiver)
            if first is None:
                first = min(_numbers(store, f"{folder.rstrip('/')}/{receiver}").get(receiver, [upto]))
            numbers = list(range(first, upto))
            out += [Files(receiver, numbers[k : k + FILES]) for k in range(0, len(numbers), FILES)]
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, folder = _folder(self.path)
        for n in partition.numbers:
            with store.open_input_stream(f"{folder.rstrip('/')}/{partition.receiver}/{n:020d}.body") as f:
                body = f.read()
            yield pa.RecordBatch.from_arrays([pa.array([partition.receiver]), pa.array([n], pa.int64()), pa.array([body], pa.binary())], ["receiver", "number", "content"])

    def commit(self, end: dict) -> None:
        """Deletes what has been read, after a mark that keeps a receiver from using a number again."""
        store, folder = _folder(self.path)
        for receiver, numbers in _numbers(store, folder).items():
            upto = end.get(receiver, 0)
            gone = [n for n in numbers if n < upto]
            if gone:
                own = f"{folder.rstrip('/')}/{receiver}"
                store.open_output_stream(f"{own}/{upto:020d}.read").close()
                for n in gone:
                    store.delete_file(f"{own}/{n:020d}.body")
                for info in store.get_file_info(fs.FileSelector(own)):
                    if info.base_name.endswith(".read") and int(info.base_name.removesuffix(".read")) < upto:
                        store.delete_file(info.path)


class Pushed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pushed"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> PushedReader:
        return PushedReader(dict(self.options))


def pushed_stream(spark: SparkSession, path: str, batch: int = BATCH) -> DataFrame:
    """(receiver, number, content) of the payloads of a landing folder, each exactly once."""
    spark.dataSource.register(Pushed)
    return spark.readStream.format("pushed").option("path", path).option("batch", str(batch)).load()


def push_all(payloads: DataFrame, path: str, column: str = "content") -> None:
    """Appends the payloads of a table, each task as a receiver of its own.

    A task's try writes beside the landing folder; the tries that Spark counts move into it, so a payload of a task that is repeated comes once.
    """
    staged = f"{path.rstrip('/')}-staged"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        receiver = None
        for batch in batches:
            for body in batch.column(0).to_pylist():
                receiver = receiver or Receiver(staged, uuid.uuid4().hex)
                receiver.append(body)
        names = [receiver.folder.rpartition("/")[2]] if receiver else []
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    names = [r["name"] for r in payloads.select(column).where(F.col(column).isNotNull()).mapInArrow(send, "name string").collect()]  # one for each task
    store, folder = _folder(path)
    _, aside = _folder(staged)
    store.create_dir(folder, recursive=True)
    for name in names:
        store.move(f"{aside}/{name}", f"{folder.rstrip('/')}/{name}")
