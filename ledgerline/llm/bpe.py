"""Byte-pair encoding and decoding with a given vocabulary of words with word ends.

The vocabulary file's path is a parameter; the file is read on each executor.
A text is normalised (NFC, lower case; white space only parts words), split into
words, and each word into parts: one symbol per byte at first, the last with the word
end. The parts of a word stand in one contiguous array of boundaries beside
the array of ranks of adjacent pairs; the lowest rank is found by a scan, its
boundary is deleted and the two neighbouring ranks are refreshed, until no pair
has a rank. In a short word a scan of a few numbers beats a heap. Runs of over SHORT bytes
without white space are no words of a language; there the same pairs are merged in the
same order, but found by a heap, as scans would take time with the square of the length.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from ledgerline.llm.common import table, text_or_empty

NEVER = 1 << 60
#: Unicode's White_Space, as the vocabulary file's pattern means it.
SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Words remembered by a task; others are encoded again when they recur. A worker's process outlives its task, so the task forgets them when it ends.
REMEMBERED = 200_000
#: Bytes of a word up to which its ranks are scanned.
SHORT = 96


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is a visible Latin-1 character, else the next free one from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, free = [], 256
    for b in range(256):
        if b in visible:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


class Bpe:
    """Encodes and decodes texts as the vocabulary file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        self.symbols = byte_symbols()
        split = next(x for x in data["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")["pattern"]["Regex"]
        self.special = [t["content"] for t in data["added_tokens"]]
        self.special_ids = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.word = regex.compile(split.replace(r"\s", SPACES))
        self.special_split = regex.compile("(" + "|".join(regex.escape(x) for x in self.special) + ")") if self.special else None
        self.pieces = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special_ids.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            if a in self.ids and b in self.ids and a + b in self.ids:
                self.ranks.setdefault((self.ids[a], self.ids[b]), (rank, self.ids[a + b]))
        self.known: dict[str, tuple[int, str, str]] = {}
        self.known_ids: dict[str, list[int]] = {}

    def parts(self, word: str) -> list[int]:
        """Ids of one word (no white space in it)."""
        raw = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        raw[-1] += self.end
        ids, ranks = [self.ids[x] for x in raw if x in self.ids], self.ranks
        if len(ids) > SHORT:
            return self._long(ids)
        pairs = [ranks.get(p, (NEVER, 0)) for p in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best[0] == NEVER:
                break
            i = pairs.index(best)
            ids[i] = best[1]
            del ids[i + 1], pairs[i]
            if i:
                pairs[i - 1] = ranks.get((ids[i - 1], ids[i]), (NEVER, 0))
            if i < len(pairs):
                pairs[i] = ranks.get((ids[i], ids[i + 1]), (NEVER, 0))
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        """What parts() makes of many symbols: the lowest rank first, the leftmost of equal ones."""
        ranks, n = self.ranks, len(ids)
        ahead, behind = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i, found[1], ids[i], ids[i + 1]) for i in range(n - 1) if (found := ranks.get((ids[i], ids[i + 1])))]
        heapify(heap)
        while heap:
            _, i, whole, left, right = heappop(heap)
            j = ahead[i]
            if j >= n or ids[i] != left or ids[j] != right:  # one of the two has been merged since
                continue
            ids[i], ids[j] = whole, -1
            ahead[i] = after = ahead[j]
            if after < n:
                behind[after] = i
                if found := ranks.get((whole, ids[after])):
                    heappush(heap, (found[0], i, found[1], whole, ids[after]))
            before = behind[i]
            if before >= 0 and (found := ranks.get((ids[before], whole))):
                heappush(heap, (found[0], before, found[1], ids[before], whole))
        return [x for x in ids if x >= 0]

    def _remember_ids(self, word: str) -> list[int]:
        if len(self.known_ids) >= REMEMBERED:
            self.known_ids.clear()
        ids = self.parts(word)
        if len(word) < 64:
            self.known_ids[word] = ids
        return ids

    def _remember(self, word: str) -> tuple[int, str]:
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        ids = self.parts(word)
        found = (len(ids), " ".join(map(str, ids)), " ".join(map(self.pieces.__getitem__, ids)))
        if len(word) < 64:
            self.known[word] = found
        return found

    def forget(self) -> None:
        self.known.clear()
        self.known_ids.clear()

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of the raw text between special tokens, and the special tokens."""
        if not self.special_split or "<|" not in text:
            yield text, False
            return
        for i, part in enumerate(self.special_split.split(text)):
            if part:
                yield part, bool(i % 2)

    def words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        return self.word.findall(lowered(text))

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, remember = self.known_ids, self._remember_ids
        for part, special in self.segments(text):
            if special:
                out.append(self.special_ids[part])
            else:
                for w in self.words(part):
                    out += known.get(w) or remember(w)
        return out

    def decode(self, ids: list[int]) -> str:
        """The pieces, joined by spaces: the file has no decoder to undo symbols and word ends."""
        return " ".join(self.pieces[i] for i in ids)

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, ids joined by spaces, decoded text)."""
        n, ids, pieces = 0, [], []
        known, remember = self.known, self._remember
        for part, special in self.segments(text):
            if special:
                n += 1
                ids.append(str(self.special_ids[part]))
                pieces.append(part)
                continue
            for w in self.words(part):
                got = known.get(w) or remember(w)
                n += got[0]
                ids.append(got[1])
                pieces.append(got[2])
        return n, " ".join(ids), " ".join(pieces)


def lowered(text: str) -> str:
    """Each character's lower case by itself: no rule that looks at its neighbours."""
    if text.isascii() or "Σ" not in text:
        return text.lower()
    return "σ".join(x.lower() for x in text.split("Σ"))


@lru_cache(maxsize=2)
def loaded(path: str) -> Bpe:
    return Bpe(path)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for text in batch.column("__text"):
                n, ids, decoded = bpe.digest(text.as_py())
                out[0].append(n)
                out[1].append(hashlib.sha256(ids.encode()).hexdigest())
                out[2].append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            keys = [batch.column(c) for c in batch.schema.names if c != "__text"]
            names = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())],
                [*names, "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        bpe.forget()

    return run


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            found = [np.array(bpe.encode(x.as_py() or ""), np.int32) for x in batch.column("__text")]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
            names = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), ids], [*names, "ids"])
        bpe.forget()

    return run


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            texts = pa.array([bpe.decode(x.as_py() or []) for x in batch.column("__ids")], pa.string())
            names = [c for c in batch.schema.names if c != "__ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), texts], [*names, "decoded"])

    return run


def encode(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ids array<int> instead of ``text``; no ids for null and empty texts.

    A column of the caller's named ids gives way to the new one; other columns and repeated rows stay, an empty table stays empty. Whole texts of any length, in Arrow batches, without a shuffle.
    """
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in (text, "ids")), F.col(text).alias("__text"))
    schema = kept.drop("__text").schema.add("ids", ArrayType(IntegerType()))
    return kept.mapInArrow(_encoded(path or default_vocabulary()), schema)


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` with decoded string instead of ``ids``; null and no ids give an empty string.

    A column of the caller's named decoded gives way to the new one; other columns and repeated rows stay.
    """
    kept = encoded.select(*(F.col(f"`{c}`") for c in encoded.columns if c not in (ids, "decoded")), F.col(ids).alias("__ids"))
    schema = kept.drop("__ids").schema.add("decoded", StringType())
    return kept.mapInArrow(_decoded(path or default_vocabulary()), schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row of ``docs`` (doc_id, text)."""
    kept = docs.select("doc_id", text_or_empty(F.col("text")).alias("__text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return kept.mapInArrow(_digests(path or default_vocabulary()), schema)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """digests() of all documents; null texts are encoded as empty ones."""
    return digests(table(spark, sf_dir, "documents"))
