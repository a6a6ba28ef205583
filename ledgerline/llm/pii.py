"""Personal data: fixed patterns, and a conditional random field for what they miss.

Base spans follow fixed rules for e-mail addresses, IP addresses, card numbers and
international phone numbers. A linear-chain conditional random field over
word-shape features, trained from a small labelled table, adds spans of other
identifiers. It decodes the neighbourhood of every word with a digit or an at
sign, wherever in the text it stands, by Viterbi in numpy over batches of such
neighbourhoods; a word without either never is an identifier, which the model is
given as a hard constraint.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table, text_or_empty

KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match cannot start inside a run of digits that another start has tried, so looking back changes nothing but the time.
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")
SPACE = re.compile(r"[\x20\x09-\x0D]+")
PUNCTUATION = ".,;:!?\"'()[]{}<>#*$%&|"
NAMED = re.compile(r"[\"']?[A-Za-z_][A-Za-z0-9_.-]{0,40}[\"']?(?:=|:(?!//))")
LONG = re.compile(r"[A-Za-z0-9_+/=-]+")
# Places where letters turn to digits or back, of which a random key has many.
SWITCH = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
#: Labels of the random field; the first is no identifier.
LABELS = ("other", "secret", "local_phone", "national_id")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed; positions are code points."""
    out = []
    if "@" in text:
        out += [(s, e, "email") for s, e in emails(text)]
    if TRIGGER.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def core_of(word: str) -> tuple[int, int]:
    """Where in a word its identifier would stand: without punctuation around it and without ``name=`` or ``name:`` before it."""
    named = NAMED.match(word)
    start = named.end() if named else 0
    core = word[start:].strip(PUNCTUATION)
    if not core:
        start, core = 0, word.strip(PUNCTUATION)
    at = word.find(core, start)
    return at, at + len(core)


def shape(word: str) -> str:
    """Runs of letters, hex digits and digits by kind and coarse length; other characters as they are."""
    start, end = core_of(word)
    core = word[start:end]
    if not core:
        return "punct"
    if len(core) >= 16 and re.fullmatch(r"[0-9a-fA-F]+", core) and re.search(r"[a-fA-F]", core):
        return "longhex"
    if re.fullmatch(r"[A-Z]{4}[A-Z0-9]{12,}", core) and re.search(r"[0-9]", core):
        return "longcaps"
    if len(core) >= 16 and LONG.fullmatch(core) and len(SWITCH.findall(core)) >= 4:
        return "longmix"
    out = re.sub(r"[^\W\d_]+", lambda m: "x" if m[0].islower() else "X", core)
    return re.sub(r"[0-9]+", lambda m: "d" + (str(len(m[0])) if len(m[0]) < 7 else "many"), out)[:24]


#: Words before a number that say what it counts or names.
COUNTED = frozenset(
    "page pages pp p journal vol volume volumes score scores line lines row rows seats section sections isbn issn part parts model flight room chapter chapters verse verses years year "
    "paragraph article figure table note issue edition series match matches width height ratio order item invoice ticket version".split()
)
NAMED_BY = frozenset("call calls phone phones tel telephone mobile cell fax dial ring contact number ssn security iban account konto passport taxpayer token key secret password bearer".split())


SECRET = re.compile(r"(?:^|[_-])(?:key|token|secret|passw|pwd|auth)|(?:key|token|secret|password|pwd)$")


def _class(word: str) -> str:
    plain = word.strip(PUNCTUATION).lower()
    return "counted" if plain in COUNTED else "named" if plain in NAMED_BY or SECRET.search(plain) else ""


def features(words: list[str], i: int) -> list[str]:
    """Of the word at i: its shape, its neighbours' shapes and their lower-case cue words."""
    at = lambda j: shape(words[j]) if 0 <= j < len(words) else "edge"
    cue = lambda j: words[j].strip(PUNCTUATION).lower()[:12] if 0 <= j < len(words) else ""
    before = [_class(words[j]) if j >= 0 else "" for j in (i - 1, i - 2)]
    said = before[0] or before[1]
    named = NAMED.match(words[i])
    own = named[0].strip("\"'=:").lower()[:12] if named else ""
    return ["bias", f"0={at(i)}", f"-1={at(i - 1)}", f"+1={at(i + 1)}", f"-1|0={at(i - 1)}|{at(i)}", f"w-1={cue(i - 1)}", f"c={said}", f"c|0={said}|{at(i)}", f"w-2={cue(i - 2)}", f"w0={own}", f"named={int(bool(own))}|{at(i)}", f"eq={int('=' in (words[i - 1] if i else ''))}"]


def labelled_table(rows: int = 720, seed: int = 7) -> list[tuple[str, str, str]]:
    """(text before, identifier or other number, label) examples from fixed templates; all words of the second have the label."""
    rng = random.Random(seed)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    h = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    k = lambda n: "".join(rng.choice("ABCDEFGHJKMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice(["an", "the", "re", "ou", "st", "ing", "da", "lo"]) for _ in range(rng.randint(1, 4)))
    w = lambda lower=w: lower().capitalize() if rng.random() < 0.3 else lower()
    one = lambda *of: rng.choice(of)
    x = lambda n: "".join(rng.choice("ABCDEFGHJKLMNPRSTUVWXYZ") for _ in range(n))
    kk = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    # Of the same shapes as identifiers; only what stands before tells.
    plain = lambda: one("page", "pages", "pp.", "journal", "vol.", "volume", "score", "scores", "lines", "rows", "seats", "section", "isbn", "issn", "part", "model", "flight", "room", "chapter", "verses", "years")
    made = [
        lambda: (one("token =", "api_key =", "secret =", "password =", "TOKEN ="), f'"{one(h(32), h(40), h(64), k(24), k(40))}"', "secret"),
        lambda: (one("key", "bearer", w()), one(h(40), f"sk_live_{k(24)}", f"key-{k(32)}", k(36)), "secret"),
        lambda: (w(), one("token", "api_key", "secret", "password", "access_token") + one('="{}"', "={}", ":{}", "='{}'").format(one(h(32), h(40), k(24))), "secret"),
        lambda: (one("call", "phone", "tel", "phone:", w(), w()), one(f"555-{d(4)}", f"{d(3)}-{d(4)}", f"{d(3)}.{d(4)}"), "local_phone"),
        lambda: (one("call", "phone", "mobile", "tel", w()), one(f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"{d(1)} {d(3)}-{d(4)}"), "local_phone"),
        lambda: (one("ssn", "SSN", "id", "ssn:", "security number", w()), f"{d(3)}-{d(2)}-{d(4)}", "national_id"),
        lambda: (one("version", "Version", "License, version", "BY-NC", w()), one("3.", "2.0.", "4.0.", "1.1", "v2", f"{d(1)}.{d(1)}.{d(2)}"), "other"),
        lambda: (one("page", "in", "the", w(), w()), one(d(1), d(2), d(3), "19" + d(2), "20" + d(2), d(5), d(9), f"{d(1)},{d(3)}"), "other"),
        lambda: (w(), one(f"{d(2)}%", f"${d(3)}", f"{d(1)}:{d(2)}", f"{d(4)}-{d(2)}-{d(2)}", f"{d(1)}-{d(1)}", f"x{d(1)}", f"{d(2)}-{d(2)}", f"19{d(2)}-20{d(2)}"), "other"),
        lambda: (w(), one(f"{d(2)}/{d(2)}/{d(4)}", f"{d(2)}.{d(2)}.{d(4)}", f"{d(3)}-{d(3)}", f"({d(4)})", f"[{d(2)}]", f"{d(2)}.{d(2)}", f"{d(4)} {d(4)}"), "other"),
        lambda: (one("commit", "sha256", "md5", "checksum", "digest"), one(h(32), h(40), h(64)), "other"),
        lambda: (w(), one("size", "width", "id", "page", "n", "ratio") + one("=", ":") + one(d(1), d(2), d(4), f"{d(1)}.{d(2)}"), "other"),
        lambda: (w(), one(f"{w()}.{d(2)}@mail{d(1)}.example.com", f"{d(2)}.{d(3)}.{d(2)}.{d(3)}", d(16), f"http://{w()}.com/{d(4)}/{w()}-{d(2)}"), "other"),
        lambda: (f"+{d(1)}", f"({d(3)})", "other"),
        lambda: (one(w(), f"{w()} {w()}"), one(f"{d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}"), "local_phone"),
        lambda: (w(), one(f"{d(16)} {d(16)}", f"{d(15)} {d(16)}", f"{d(16)}"), "other"),
        lambda: (f"{w()} {plain()}", one(f"{d(3)}-{d(4)}", f"{d(3)}-{d(4)}", f"{d(3)}.{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}-{d(2)}-{d(4)}"), "other"),
        lambda: (plain(), one(f"{d(3)}-{d(4)}", f"{d(3)}-{d(2)}-{d(4)}", f"{d(1)}-{d(3)}-{d(5)}", f"{x(1)}{d(7)}", f"{x(2)}{d(7)}", d(9)), "other"),
        lambda: (one("key", "id", "aws", w(), w()), f"{one('AKIA', 'ASIA', 'AROA')}{kk(16)}", "secret"),
        lambda: (one("iban", "IBAN", "account", "konto", w()), one(f"{x(2)}{d(20)}", f"{x(2)}{d(2)}{x(4)}{d(14)}", f"{x(2)}{d(2)} " + " ".join(d(4) for _ in range(4)) + f" {d(2)}", f"{x(2)}{d(2)} " + " ".join(d(4) for _ in range(5))), "national_id"),
        lambda: (one("passport", "passport no.", "passport number", "Passport"), one(f"{x(1)}{d(8)}", f"{x(2)}{d(7)}", d(9)), "national_id"),
        lambda: (one("call", "phone", "dial", "mobile", "tel", "fax"), one(f"{d(1)} {d(3)}-{d(4)}", f"{d(3)} {d(4)}", f"{d(3)} {d(3)} {d(4)}"), "local_phone"),
        lambda: (one("order", "item", "invoice", "ticket", "code", w()), one(f"{x(1)}{d(3)}", f"{x(2)}{d(4)}", f"{x(2)}-{d(4)}", f"{d(6)}", f"{d(4)} {d(4)}"), "other"),
    ]
    return [made[i % len(made)]() for i in range(rows)]


class Field:
    """Weights of a linear-chain conditional random field."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.index, self.emit, self.move = index, emit, move

    def scores(self, words: list[str]) -> np.ndarray:
        """One row of label scores for each word; -inf where a label is impossible."""
        out = np.zeros((len(words), len(LABELS)))
        for i, word in enumerate(words):
            out[i] = self.emit[[k for k in (self.index.get(x) for x in features(words, i)) if k is not None]].sum(0)
            if not TRIGGER.search(word):
                out[i, 1:] = -np.inf
        return out


def _forward(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    out = np.empty_like(scores)
    out[0] = scores[0]
    for t in range(1, len(scores)):
        out[t] = scores[t] + np.logaddexp.reduce(out[t - 1][:, None] + move, axis=0)
    return out


def train(rows: Iterable[tuple[str, str, str]], steps: int = 60, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Maximum conditional likelihood by gradient ascent (forward-backward), on a table that fits in memory."""
    rng = random.Random(1)
    fill = lambda: rng.choice(["the", "and", "Onan", "ereth", "with,", "lyes."])
    cases = []
    for before, what, label in rows:
        first, marked = [fill(), *before.split()], what.split()
        words = [*first, *marked, fill(), fill()]
        cases.append((words, np.array([0] * len(first) + [LABELS.index(label)] * len(marked) + [0, 0])))
    index: dict[str, int] = {}
    coded = np.array([[index.setdefault(x, len(index)) for x in features(words, i)] for words, _ in cases for i in range(len(words))])
    plain = np.array([not TRIGGER.search(w) for words, _ in cases for w in words])
    ends = np.cumsum([len(words) for words, _ in cases])
    field = Field(index, np.zeros((len(index), len(LABELS))), np.zeros((len(LABELS), len(LABELS))))
    for _ in range(steps):
        emit, move = -decay * field.emit, -decay * field.move
        every = field.emit[coded].sum(1)
        every[plain, 1:] = -1e9
        errors = np.empty_like(every)
        for (words, gold), end in zip(cases, ends):
            scores = every[end - len(words) : end]
            ahead = _forward(scores, field.move)
            back = _forward(scores[::-1], field.move.T)[::-1]
            whole = np.logaddexp.reduce(ahead[-1])
            error = -np.exp(ahead + back - scores - whole)
            error[np.arange(len(words)), gold] += 1
            errors[end - len(words) : end] = error / len(cases)
            pairs = np.exp(ahead[:-1, :, None] + field.move + back[1:, None, :] - whole)
            move -= pairs.sum(0) / len(cases)
            np.add.at(move, (gold[:-1], gold[1:]), 1 / len(cases))
        np.add.at(emit, coded.ravel(), np.repeat(errors, coded.shape[1], axis=0))
        field.emit += rate * 4 * emit
        field.move += rate * move
    return field


def viterbi(batch: list[np.ndarray], move: np.ndarray, cells: int = 1 << 20) -> list[np.ndarray]:
    """Best label paths of sequences of score rows, decoded together in padded groups of similar length."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(batch)
    order = sorted(range(len(batch)), key=lambda i: len(batch[i]))
    at = 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and (upto + 1 - at) * len(batch[order[upto]]) * move.shape[0] <= cells:
            upto += 1
        group = order[at:upto]
        longest = len(batch[group[-1]])
        scores = np.zeros((len(group), longest, move.shape[0]))
        lengths = np.array([len(batch[i]) for i in group])
        for row, i in enumerate(group):
            scores[row, : len(batch[i])] = batch[i]
        best, came = scores[:, 0], np.zeros((len(group), longest, move.shape[0]), np.int8)
        for t in range(1, longest):
            options = best[:, :, None] + move[None]
            came[:, t] = options.argmax(1)
            best = np.where((t < lengths)[:, None], options.max(1) + scores[:, t], best)
        label = best.argmax(1)
        paths = np.zeros((len(group), longest), np.int64)
        for t in range(longest - 1, -1, -1):
            inside = t < lengths
            paths[inside, t] = label[inside]
            if t:
                label = np.where(inside, came[np.arange(len(group)), t, label], label)
        for row, i in enumerate(group):
            out[i] = paths[row, : len(batch[i])]
        at = upto
    return out


def neighbourhoods(text: str, reach: int = 2) -> list[list[tuple[int, int]]]:
    """Spans of words around words with a digit or an at sign, joined where only white space lies between them."""
    hits: list[tuple[int, int]] = []
    at = 0
    while found := TRIGGER.search(text, at):
        start = end = found.start()
        while start > 0 and not SPACE.match(text, start - 1):
            start -= 1
        space = SPACE.search(text, end)
        end = space.start() if space else len(text)
        hits.append((start, end))
        at = end
    out: list[list[tuple[int, int]]] = []
    for k, (start, end) in enumerate(hits):
        before, stop = [], hits[k - 1][1] if k else 0
        left = start
        while len(before) < reach and left > stop:
            right = left
            while right > stop and SPACE.match(text, right - 1):
                right -= 1
            if right == stop:
                break
            left = right
            while left > stop and not SPACE.match(text, left - 1):
                left -= 1
            before.append((left, right))
        after, right = [], end
        limit = hits[k + 1][0] if k + 1 < len(hits) else len(text)
        while len(after) < reach and right < limit:
            gap = SPACE.match(text, right)
            begin = gap.end() if gap else right
            if begin >= limit:
                break
            nxt = SPACE.search(text, begin, limit)
            right = nxt.start() if nxt else limit
            after.append((begin, right))
        words = [*reversed(before), (start, end), *after]
        if out and not text[out[-1][-1][1] : words[0][0]].strip("\x20\t\n\x0b\x0c\r"):
            out[-1] += [w for w in words if w[0] >= out[-1][-1][1]]
        else:
            out.append(words)
    return out


def found_spans(texts: list[str], field: Field) -> list[list[tuple[int, int, str]]]:
    """All spans of each text: base spans, and the random field's, where they overlap none of them.

    Words that follow each other with one label are one identifier where one of them has too few digits to be one, as the groups of a long number have.
    """
    base = [base_spans(t) for t in texts]
    places, sequences, known = [], [], {}
    for i, text in enumerate(texts):
        for spans in neighbourhoods(text) if TRIGGER.search(text) else ():
            words = [text[s:e] for s, e in spans]
            key = "\x00".join(words)
            if key not in known:
                known[key] = field.scores(words)
            places.append((i, spans))
            sequences.append(known[key])
    extra: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for (i, spans), path in zip(places, viterbi(sequences, field.move) if sequences else []):
        before = 0
        for (start, end), label in zip(spans, path):
            if label:
                first, last = (start + x for x in core_of(texts[i][start:end]))
                if first < last and not any(first < e and s < last for s, e, _ in base[i]):
                    if before == label and extra[i] and _parts_of_one(texts[i], extra[i][-1][:2], (first, last)):
                        extra[i][-1] = (extra[i][-1][0], last, LABELS[label])
                    else:
                        extra[i].append((first, last, LABELS[label]))
            before = label
    rank = {k: n for n, k in enumerate((*KINDS, *LABELS))}
    return [sorted(b + x, key=lambda s: (s[0], rank[s[2]])) for b, x in zip(base, extra)]


#: Digits that an identifier of its own has at least.
WHOLE = 7


def _parts_of_one(text: str, one: tuple[int, int], two: tuple[int, int]) -> bool:
    """Whether two spans with nothing but space or brackets between them are one number: the second is short, or the first is."""
    digits = lambda span: sum("0" <= c <= "9" for c in text[slice(*span)])
    return not text[one[1] : two[0]].strip(" ()") and min(digits(one), digits(two)) < WHOLE


def _line(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _found(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = found_spans(batch.column("__text").to_pylist(), field)
            base = [[s for s in row if s[2] in KINDS] for row in spans]
            counts = [pa.array([sum(s[2] == k for s in row) for row in base], pa.int64()) for k in KINDS]
            names = [c for c in batch.schema.names if c != "__text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    *counts,
                    pa.array([hashlib.sha256(_line(row).encode()).hexdigest() for row in base]),
                    pa.array([_line(row) for row in spans], pa.string()),
                ],
                [*names, *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return run


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, counts of base spans, base_sha256 and spans of every row of ``docs`` (doc_id, text).

    Null and empty texts have no spans; repeated rows come out as often as they are; an empty table gives an empty one. Spans of one start are
    ordered by kind. Whole texts of any length; further columns are not passed on, whatever their names.
    """
    narrow = docs.select("doc_id", text_or_empty(F.col("text")).alias("__text"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return narrow.mapInArrow(_found(field or train(labelled_table())), schema)


def scrubbed(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at, shown = [], 0, -1
    for start, end, kind in spans:
        if start < shown:
            shown = max(shown, end)
            at = max(at, end)
            continue
        out += [text[at:start], f"[{kind.upper()}]"]
        at = shown = end
    return "".join([*out, text[at:]])


def _scrubbed(field: Field, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            spans = found_spans([t or "" for t in texts], field)
            clean = [None if t is None else scrubbed(t, s) for t, s in zip(texts, spans)]
            arrays = [pa.array(clean, pa.string()) if c == text else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    return run


def scrub(docs: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """``docs`` with all spans of ``text`` replaced; null texts stay null, other columns, whatever their names, and repeated rows as they are.

    Of spans that overlap the first one's kind stands for all. An empty table stays empty; texts of any length are read whole.
    """
    return docs.mapInArrow(_scrubbed(field or train(labelled_table()), text), docs.schema)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """find() in all documents."""
    return find(table(spark, sf_dir, "documents"))
