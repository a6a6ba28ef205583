"""Token counts that follow edits.

A document's tokens are counted in segments of whole pre-tokens, and a tree of sums
stands over the segments. An edit re-encodes the segments it touches and their
neighbours on either side, and updates the sums above them. Segments are cut before a single space
between two other characters, where the pre-tokeniser's pattern always starts a
new pre-token whatever stands around it; so the counts of segments add up to that of
the whole text, before and after edits.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table, text_or_empty

#: Characters of a segment, where the text has a place to cut.
SEGMENT = 1024
CUT = re.compile(r"(?<=\S) (?=\S)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("given", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """Parts of the text, of ``size`` characters or somewhat more, cut only where a pre-token must start."""
    out, start = [], 0
    while len(text) - start > size:
        found = CUT.search(text, start + size)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.start()
    if start < len(text):
        out.append(text[start:])
    return out


class SegmentTree:
    """Segments of one text and the sums of their token and character counts."""

    def __init__(self, text: str, count, size: int = SEGMENT):
        self.count, self.size, self.encoded = count, size, 0
        self.parts = segments(text, size)
        self._build([self._counted(p) for p in self.parts])

    def _counted(self, part: str) -> int:
        self.encoded += len(part)
        return self.count(part)

    def _build(self, tokens: list[int]) -> None:
        self.levels = [[(t, len(p)) for t, p in zip(tokens, self.parts)] or [(0, 0)]]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append([(sum(x[0] for x in low[i : i + 2]), sum(x[1] for x in low[i : i + 2])) for i in range(0, len(low), 2)])

    @property
    def tokens(self) -> int:
        return self.levels[-1][0][0]

    @property
    def length(self) -> int:
        return self.levels[-1][0][1]

    def find(self, position: int) -> tuple[int, int]:
        """(segment that holds the position, where it starts), by descent through the sums."""
        at, start = 0, 0
        for level in reversed(self.levels[:-1]):
            at *= 2
            if at + 1 < len(level) and position >= start + level[at][1]:
                start += level[at][1]
                at += 1
        return at, start

    def replace(self, start: int, end: int, new: str) -> None:
        """Puts ``new`` for the characters from start to end, both held within the text."""
        start = min(max(start, 0), self.length)
        end = min(max(end, start), self.length)
        if not self.parts:
            self.parts = segments(new, self.size)
            self._build([self._counted(p) for p in self.parts])
            return
        low, low_start = self.find(start)
        high, high_start = self.find(end)
        if low:  # one segment of context before
            low -= 1
            low_start -= len(self.parts[low])
        high_end = high_start + len(self.parts[high])
        if high + 1 < len(self.parts):  # and one after
            high += 1
            high_end += len(self.parts[high])
        old = "".join(self.parts[low : high + 1])
        fresh = segments(old[: start - low_start] + new + old[end - low_start :], self.size)
        # The seams: a cut is safe only between two other characters around a single space.
        tokens = [t for t, _ in self.levels[0]]
        while low and not self._seam(self.parts[low - 1], fresh[0] if fresh else ""):
            low -= 1
            fresh = segments(self.parts[low] + "".join(fresh), self.size)
        while high + 1 < len(self.parts) and not self._seam(fresh[-1] if fresh else "", self.parts[high + 1]):
            high += 1
            fresh = segments("".join(fresh) + self.parts[high], self.size)
        counted = [self._counted(p) for p in fresh]
        same = len(fresh) == high + 1 - low
        self.parts[low : high + 1] = fresh
        if same:
            self._update(low, counted)
        else:
            self._build(tokens[:low] + counted + tokens[high + 1 :])

    @staticmethod
    def _seam(left: str, right: str) -> bool:
        return bool(left) and len(right) > 1 and CUT.match(left[-1] + right[:2], 1) is not None

    def _update(self, low: int, counted: list[int]) -> None:
        high = low + len(counted)
        self.levels[0][low:high] = [(t, len(p)) for t, p in zip(counted, self.parts[low:high])]
        for below, level in zip(self.levels, self.levels[1:]):
            low, high = low // 2, (high + 1) // 2
            for i in range(low, high):
                pair = below[2 * i : 2 * i + 2]
                level[i] = (sum(x[0] for x in pair), sum(x[1] for x in pair))


def _counts(path: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(path)
        count = lambda s: len(encoder.encode_ordinary(s))
        for batch in batches:
            out: list[tuple] = []
            for text, edits in zip(batch.column("__text"), batch.column("__edits")):
                tree = SegmentTree(text.as_py(), count, size)
                before, tree.encoded = tree.tokens, 0
                for e in edits.as_py() or ():
                    tree.replace(e["start"], e["end"], e["new"] or "")
                out.append((before, tree.tokens, len(tree.parts), tree.length, tree.encoded, [t for t, _ in tree.levels[0]] if tree.parts else []))
            names = [c for c in batch.schema.names if not c.startswith("__")]
            made = ["n_tokens", "n_tokens_edited", "n_segments", "n_chars_edited", "n_chars_encoded_again"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), *(pa.array([r[j] for r in out], pa.int64()) for j in range(5)), pa.array([r[5] for r in out], pa.list_(pa.int64()))],
                [*names, *made, "segment_tokens"],
            )

    return run


def count_tokens(docs: DataFrame, path: str | None = None, size: int = SEGMENT) -> DataFrame:
    """doc_id, token counts before and after edits, and the tree's leaves, for every row.

    ``docs`` has doc_id, text and edits, array<struct<start:int,end:int,new:string>> of code points, applied in
    order, each to the text that the one before left; places outside the text count as its ends, null edits as none.
    Null and empty texts have no tokens. Repeated rows come out as often as they are; an empty table gives an empty one; further columns are not
    passed on, whatever their names. Whole texts of any length; no shuffle.
    """
    narrow = docs.select("doc_id", text_or_empty(F.col("text")).alias("__text"), F.col("edits").alias("__edits"))
    schema = (
        "doc_id long, n_tokens long, n_tokens_edited long, n_segments long, n_chars_edited long, n_chars_encoded_again long, "
        "segment_tokens array<bigint>"
    )
    return narrow.mapInArrow(_counts(path or default_vocabulary(), size), schema)


def sample_edits(text: str = "text") -> Column:
    """Three edits that depend on the text only: words put in at a third, forty characters taken out at a half, a new end."""
    n = F.length(F.coalesce(F.col(text), F.lit("")))
    edit = lambda s, e, new: F.struct(s.cast("int").alias("start"), e.cast("int").alias("end"), F.lit(new).alias("new"))
    return F.array(
        edit(F.floor(n / 3), F.floor(n / 3), " some new words, 12"),
        edit(F.floor(n / 2), F.floor(n / 2) + 40, ""),
        edit(F.greatest(n - 25, F.lit(0)), n + 1000, " the end.\n"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count_tokens() of all documents, each with the three edits of sample_edits()."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs.withColumn("edits", sample_edits())).drop("segment_tokens")
