"""Fill-in-middle: a text's prefix, middle and suffix put into another order.

Cuts fall between units, which are code points or the matches of a pattern. While units are counted, every SPACING of them a
checkpoint is kept: how many units, bytes and code points lie before it. A cut is then found by a binary search in the checkpoints and a
short scan on from there, and the three parts are slices of the text's bytes, which are never decoded for a second time.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table, text_or_empty

#: Units between two checkpoints, and bytes that are looked at in one step.
SPACING, STEP = 1024, 1 << 16
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: In a hundred: texts that are cut, and of these the ones whose suffix comes first.
CUT, SUFFIX_FIRST = 90, 20


class Index:
    """Checkpoints of a text: (units, bytes, code points) before every SPACING-th unit, and the counts of all."""

    def __init__(self, text: bytes, unit: re.Pattern[str] | None = None, spacing: int = SPACING):
        self.text, self.unit, self.spacing = memoryview(text), unit, spacing
        self.units, self.bytes, self.points = [0], [0], [0]
        if unit is None:
            self._count_points()
        else:
            self._count_units()

    def _count_points(self) -> None:
        raw, seen = np.frombuffer(self.text, np.uint8), 0
        for first in range(0, len(raw), STEP):
            starts = np.flatnonzero((raw[first : first + STEP] & 0xC0) != 0x80)
            marks = np.arange(-seen % self.spacing, len(starts), self.spacing)
            for k in marks[marks + seen > 0]:
                self._mark(seen + int(k), first + int(starts[k]), seen + int(k))
            seen += len(starts)
        self.n, self.length = seen, seen

    def _count_units(self) -> None:
        text = str(self.text, "utf-8")
        self.n, self.length = 0, len(text)
        for found in self.unit.finditer(text):
            if found.end() > found.start():
                if self.n and self.n % self.spacing == 0:
                    passed = text[self.points[-1] : found.start()]
                    self._mark(self.n, self.bytes[-1] + len(passed.encode()), found.start())
                self.n += 1

    def _mark(self, units: int, bytes: int, points: int) -> None:
        self.units.append(units)
        self.bytes.append(bytes)
        self.points.append(points)

    def cut(self, units: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the unit of that number, counted from 1; 0 is the start, the last one the text's end."""
        if units >= self.n:
            return len(self.text), self.length
        if units <= 0:
            return 0, 0
        at = bisect_right(self.units, units - 1) - 1
        left, start, points = units - self.units[at], self.bytes[at], self.points[at]
        stop = self.bytes[at + 1] if at + 1 < len(self.bytes) else len(self.text)
        if self.unit is None:
            starts = np.flatnonzero((np.frombuffer(self.text[start:stop], np.uint8) & 0xC0) != 0x80)
            return (start + int(starts[left]) if left < len(starts) else stop), points + left
        part = str(self.text[start:stop], "utf-8")
        for found in self.unit.finditer(part):
            if found.end() > found.start():
                left -= 1
                if not left:
                    return start + len(part[: found.end()].encode()), points + found.end()
        raise AssertionError("fewer units than were counted")


def draws(doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits from a document's id; a null id counts as an empty one."""
    found = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(found[8 * k : 8 * k + 8], 16) for k in range(4)]


def transform(text: bytes, drawn: list[int], unit: re.Pattern[str] | None = None, spacing: int = SPACING) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix and middle, output). Plain texts come out as they are, without counts.

    Plain are empty texts, those that hold a mark, and a tenth of the others by the third draw.
    """
    index = Index(text, unit, spacing)
    if not text or drawn[2] % 100 >= CUT or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return index.n, "plain", None, None, text
    (first, before), (second, upto) = (index.cut(k) for k in sorted(h % (index.n + 1) for h in drawn[:2]))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if drawn[3] % 100 < SUFFIX_FIRST:
        return index.n, "spm", before, upto - before, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return index.n, "psm", before, upto - before, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text that an output was made of."""
    if form == "plain":
        return output
    ahead, middle = output.split(MIDDLE)
    if form == "spm":
        suffix, prefix = ahead.removeprefix(SUFFIX).split(PREFIX)
    else:
        prefix, suffix = ahead.removeprefix(PREFIX).split(SUFFIX)
    return prefix + middle + suffix


def _run(unit: str | None, spacing: int, last: list[tuple[str, pa.DataType, Callable]]):
    """Arrow batches of (doc_id, text) to doc_id, n, form, prefix_chars, middle_chars and columns made of (output, form)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = None if unit is None else re.compile(unit)
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", *(n for n, _, _ in last)]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), *(k for _, k, _ in last)]
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                n, form, prefix, middle, output = transform(text.as_py(), draws(doc_id), pattern, spacing)
                rows.append((doc_id, n, form, prefix, middle, *(f(output, form) for _, _, f in last)))
            columns = list(zip(*rows)) or [()] * len(names)  # a batch may be empty
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))


HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def fill_in_middle(docs: DataFrame, unit: str | None = None, spacing: int = SPACING) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and ``output`` of every row of ``docs`` (doc_id, text).

    ``unit`` is a pattern without look-around whose matches, empty ones aside, are the units; without it they are code points. What stands between
    matches goes with the unit after it, and with the last part at the end. Null and empty texts are plain and have no units; repeated rows and
    rows of one id come out as often as they are, with the same draws; a null id draws like an empty one. Further columns of ``docs`` are left out, whatever
    their names; an empty table gives an empty one. Texts are cut whole, one at a time in memory.
    """
    return _narrow(docs).mapInArrow(_run(unit, spacing, [("output", pa.string(), lambda output, form: output.decode())]), f"{HEAD}, output string")


def restored(made: DataFrame) -> DataFrame:
    """Adds ``text`` to rows with ``output`` and ``form``: the text as it was, by DataFrame functions alone."""
    p, s, m = (mark.decode() for mark in (PREFIX, SUFFIX, MIDDLE))
    ahead, middle = F.substring_index("output", m, 1), F.substring_index("output", m, -1)
    prefix = F.when(F.col("form") == "spm", F.substring_index(ahead, p, -1)).otherwise(F.replace(F.substring_index(ahead, s, 1), F.lit(p), F.lit("")))
    suffix = F.when(F.col("form") == "spm", F.replace(F.substring_index(ahead, p, 1), F.lit(s), F.lit(""))).otherwise(F.substring_index(ahead, s, -1))
    return made.withColumn("text", F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat(prefix, middle, suffix)))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fill_in_middle() of all documents by code points, with hashes of the output and of the text that is rebuilt from it."""
    sha = lambda x: hashlib.sha256(x).hexdigest()
    last = [("output_sha256", pa.string(), lambda output, form: sha(output)), ("restored_sha256", pa.string(), lambda output, form: sha(restore(output, form)))]
    return _narrow(table(spark, sf_dir, "documents")).mapInArrow(_run(None, SPACING, last), f"{HEAD}, output_sha256 string, restored_sha256 string")
