"""Benchmark passages in documents, found by a suffix automaton of the benchmark's items.

Words are normalised: A-Z in lower case, everything else in ASCII but digits and letters parts words. One generalised suffix automaton holds every
run of words of the items of a block. A document's words stream through it; after each word it knows the longest run
that ends there and stands in an item. Where that reaches the window, or covers a shorter item wholly, the words of the window are hit. A word that
no item has leads back to the start, so only stretches of known words long enough for the shortest window are streamed.

Automata are broadcast: a block holds BLOCK_WORDS words of items, one round of a job BLOCKS blocks, so what is sent has a bound. A larger
benchmark takes further rounds over the documents, and no document is ever shuffled.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.common import stash, table

WINDOW = 10
BLOCK_WORDS, BLOCKS = 200_000, 8
#: Lower-case letters, digits and bytes of other characters as they are, capitals in lower case, the rest white.
PLAIN = bytes(b if b >= 0x80 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def normal(text: bytes) -> bytes:
    """The same number of bytes, with words in lower case and spaces between."""
    return text.translate(PLAIN)


class Automaton:
    """The generalised suffix automaton of lists of word numbers.

    State 0 is the start. ``window_state`` is the state of the last ``window`` words of a state's longest run (-1 if it is shorter), ``short_state`` the nearest
    state on the way to the start, the state itself included, that is a whole item of fewer words (-1: none).
    """

    def __init__(self, items: list[tuple[str, list[int]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int]] = []
        self.whole: dict[int, set[str]] = {}
        for k, (name, words) in enumerate(items):
            last, path = 0, []
            for w in words:
                last = self._extend(last, w)
                path.append(last)
            # The start of an item up to a place is the longest run of the state of that place, which is found again as splits move runs.
            ends += [(s, k) for s in path]
            if words and len(words) < window:
                self.whole.setdefault(last, set()).add(name)
        self.names = [name for name, _ in items]
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        self.window_state, self.short_state = [-1] * len(self.link), [-1] * len(self.link)
        for s in order:
            above = self.link[s]
            self.window_state[s] = self.window_state[above] if self.window_state[above] >= 0 else s if self.length[s] >= window else -1
            self.short_state[s] = s if s in self.whole else self.short_state[above]
        self._owners(ends)
        self.least = min((min(len(words), window) for _, words in items if words), default=0)

    def _extend(self, last: int, w: int) -> int:
        found = self.next[last].get(w)
        if found is not None:
            if self.length[found] == self.length[last] + 1:
                return found
            return self._split(last, found, w)
        new = self._state(self.length[last] + 1, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def _split(self, p: int, q: int, w: int) -> int:
        """The shorter runs of q, up to those that p leads to, become a state of their own."""
        clone = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[clone], self.link[q] = self.link[q], clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _state(self, length: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _owners(self, ends: list[tuple[int, int]]) -> None:
        """Lays states out so that those below one in the tree of links are a slice, with the items that end in them."""
        below: list[list[int]] = [[] for _ in self.link]
        for s in range(1, len(self.link)):
            below[self.link[s]].append(s)
        here: list[list[int]] = [[] for _ in self.link]
        for s, k in ends:
            here[s].append(k)
        self.first, self.last, self.owner = [0] * len(self.link), [0] * len(self.link), []
        waiting = [(0, False)]
        while waiting:
            s, done = waiting.pop()
            if done:
                self.last[s] = len(self.owner)
                continue
            self.first[s] = len(self.owner)
            self.owner += here[s]
            waiting.append((s, True))
            waiting += [(x, False) for x in below[s]]
        self.known: dict[int, frozenset[str]] = {}

    def items(self, state: int) -> frozenset[str]:
        """Names of the items that hold a state's runs."""
        if state not in self.known:
            self.known[state] = frozenset(self.names[k] for k in set(self.owner[self.first[state] : self.last[state]]))
        return self.known[state]

    def matches(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest run that ends at each word."""
        following, link, length, state, n = self.next, self.link, self.length, 0, 0
        for w in words:
            to = following[state].get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = following[state].get(w)
            if to is not None:
                state, n = to, n + 1
            yield state, n

    def found(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str], int]:
        """(hit spans of words, names of items with a window in them, length of the longest run) of words that are all known."""
        spans: list[tuple[int, int]] = []
        windows: set[int] = set()
        shorts: set[int] = set()
        longest, window = 0, self.window
        for at, (state, n) in enumerate(self.matches(words), 1):
            if n > longest:
                longest = n
            if n >= window:
                windows.add(self.window_state[state])
                spans.append((at - window, at))
            s = self.short_state[state]
            if s == state and n < self.length[s]:
                s = self.short_state[self.link[s]]
            if s >= 0:
                spans.append((at - min(self.length[s], n), at))
                while s >= 0 and s not in shorts:
                    shorts.add(s)
                    s = self.short_state[self.link[s]]
        return spans, set().union(*map(self.items, windows), *map(self.whole.__getitem__, shorts)), longest


@dataclass
class Block:
    """A block of items: the numbers of their words and their automaton."""

    numbers: dict[bytes, int]
    automaton: Automaton

    def scan(self, words: list[bytes], hit: np.ndarray, owners: set[str]) -> int:
        """Marks the hit words and adds the items; returns the length of the longest run."""
        least = self.automaton.least
        if not least or len(words) < least:
            return 0
        numbers = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (numbers >= 0).view(np.int8), [0]))))
        longest = 0
        for start, stop in zip(edges[::2], edges[1::2]):
            if stop - start >= least:
                spans, names, n = self.automaton.found(numbers[start:stop].tolist())
                longest = max(longest, n)
                for a, b in spans:
                    hit[start + a : start + b] = True
                owners |= names
        return longest


def block_of(items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> Block:
    numbers: dict[bytes, int] = {}
    coded = [(name, [numbers.setdefault(w, len(numbers)) for w in words]) for name, words in items]
    return Block(numbers, Automaton(coded, window))


def blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The blocks of ``items`` (item_id, text), one at a time at the driver; a block is a set of whole items."""
    words = F.size(F.split(F.trim(F.col("text")), r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"))
    placed = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("-")).alias("name"), F.col("text").cast("binary").alias("text"), words.alias("words")).where("text is not null")
    total = placed.agg(F.sum("words")).first()[0] or 0
    parts = max(1, ceil(total / block_words))
    spread = placed.withColumn("part", F.pmod(F.xxhash64("name", "text"), F.lit(parts)))
    for part in range(parts):
        found = [(r["name"], normal(bytes(r["text"])).split()) for r in spread.where(F.col("part") == part).select("name", "text").collect()]
        yield block_of(sorted(found), window)


def _marked(sent: list, finish: Callable[..., pa.RecordBatch]):
    """Streams each text through a round's blocks; ``finish`` makes the output of a batch, its words, marks, owners and longest runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normal(x.as_py() or b"").split() for x in batch.column("text").cast(pa.binary())]
            marks, owners, longest = [np.zeros(len(x), bool) for x in texts], [set() for _ in texts], [0] * len(texts)
            if "__hit" in batch.schema.names:  # of the rounds before
                marks = [_unpacked(bits, len(x)) for bits, x in zip(batch.column("__hit").to_pylist(), texts)]
                owners, longest = [set(x) for x in batch.column("__owners").to_pylist()], batch.column("__longest").to_pylist()
            for message in sent:
                block = pickle.loads(message.value) if len(sent) > 1 else _only(message)
                for i, words in enumerate(texts):
                    longest[i] = max(longest[i], block.scan(words, marks[i], owners[i]))
            yield finish(batch, texts, marks, [sorted(x) for x in owners], longest)

    return run


_loaded: list = [None, None]


def _only(message) -> Block:
    """The only block of a round stays in the worker's memory."""
    if _loaded[0] is not message:
        _loaded[:] = message, pickle.loads(message.value)
    return _loaded[1]


def _unpacked(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)


STATE = "__hit binary, __owners array<string>, __longest long"


def _carried(batch: pa.RecordBatch, texts, marks, owners, longest) -> pa.RecordBatch:
    names = [c for c in batch.schema.names if c not in ("__hit", "__owners", "__longest")]
    state = [pa.array([np.packbits(m).tobytes() for m in marks], pa.binary()), pa.array(owners, pa.list_(pa.string())), pa.array(longest, pa.int64())]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *state], [*names, "__hit", "__owners", "__longest"])


def scan(docs: DataFrame, items: DataFrame, finish: Callable[..., pa.RecordBatch], schema: StructType | str, window: int = WINDOW, block_words: int = BLOCK_WORDS, at_once: int = BLOCKS) -> DataFrame:
    """What ``finish`` makes of ``docs`` (with ``text``) when all blocks of ``items`` have gone over them.

    Rounds of ``at_once`` blocks follow each other; in between rows are written, so that the blocks of a round can go.
    """
    between = StructType([*docs.schema.fields, *StructType.fromDDL(STATE).fields])
    rows, sent = docs, []
    for k, block in enumerate(blocks(items, window, block_words)):
        if k and k % at_once == 0:
            rows = stash(rows.mapInArrow(_marked(sent, _carried), between))
            for message in sent:
                message.unpersist()
            sent = []
        sent.append(docs.sparkSession.sparkContext.broadcast(pickle.dumps(block, pickle.HIGHEST_PROTOCOL)))
    return rows.mapInArrow(_marked(sent, finish), schema)


def without_hits(raw: bytes, marks: np.ndarray) -> bytes:
    """A text without its marked words and what lies between two of them."""
    starts = np.flatnonzero(np.diff(np.concatenate(([0], (np.frombuffer(normal(raw), np.uint8) != 0x20).view(np.int8), [0]))))
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    out, at = [], 0
    for first, after in zip(edges[::2], edges[1::2]):
        out.append(raw[at : starts[2 * first]])
        at = starts[2 * after - 1]
    return b"".join([*out, raw[at:]])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = 0.5, longest: int | None = None) -> DataFrame:
    """``docs`` without spans of benchmark items, and without documents that are benchmark for the most part.

    A span of ``window`` words that stands in an item, or a whole shorter item, goes from the text; a document goes wholly where the spans cover more than the
    share ``coverage`` of its words or a common run reaches ``longest`` words (None: no such limit). Other columns, and the texts of clean documents, stay as
    they are. Null and empty texts are clean; repeated rows are judged alike; an empty table of documents or items changes nothing.
    """

    names = docs.columns

    def finish(batch, texts, marks, owners, runs):
        found = [int(m.sum()) for m in marks]
        kept = [n <= coverage * len(m) and (longest is None or run < longest) for n, m, run in zip(found, marks, runs)]
        old = batch.column("text").cast(pa.binary())
        new = pa.array([without_hits(old[i].as_py(), marks[i]) if n else old[i].as_py() for i, n in enumerate(found)], pa.binary()).cast(pa.string())
        columns = [new if c == "text" else batch.column(c) for c in names]
        return pa.RecordBatch.from_arrays(columns, names).filter(pa.array(kept, pa.bool_()))

    return scan(docs, items, finish, docs.schema, window)


def _digests(batch, texts, marks, owners, longest) -> pa.RecordBatch:
    hits = [int(m.sum()) for m in marks]
    columns = {
        "doc_id": batch.column("doc_id"),
        "n_words": pa.array([len(x) for x in texts], pa.int64()),
        "n_hit": pa.array(hits, pa.int64()),
        "n_items": pa.array([len(x) for x in owners], pa.int64()),
        "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in owners], pa.string()),
        "contaminated": pa.array([x > 0 for x in hits], pa.bool_()),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document.

    Null texts have no words; a null item_id is written as ``-``; items of one id count once. Long texts are streamed whole.
    """
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return scan(docs, table(spark, sf_dir, "benchmark"), _digests, schema)
