"""The processors of stateful streams against brute force, with a state that counts its calls."""

import math
import random
from types import SimpleNamespace

import numpy as np
import pandas as pd

from ledgerline.streaming import stateful


class Handle:
    """State in memory; every call to it and every timer is counted."""

    def __init__(self):
        self.calls, self.timers = 0, set()

    def called(self, result=None):
        self.calls += 1
        return result

    def getValueState(self, name, schema):
        held = []
        return SimpleNamespace(
            exists=lambda: self.called(bool(held)), get=lambda: self.called(held[0] if held else None), update=lambda v: self.called(held.__setitem__(slice(None), [v])), clear=lambda: self.called(held.clear())
        )

    def getListState(self, name, schema):
        held = []
        return SimpleNamespace(get=lambda: self.called(iter(list(held))), appendValue=lambda v: self.called(held.append(v)), clear=lambda: self.called(held.clear()))

    def getMapState(self, name, key, schema):
        held = {}
        return SimpleNamespace(
            iterator=lambda: self.called(iter(list(held.items()))), keys=lambda: self.called(iter(list(held))), getValue=lambda k: self.called(held.get(k)),
            updateValue=lambda k, v: self.called(held.__setitem__(k, v)), removeKey=lambda k: self.called(held.pop(k)),
        )

    def registerTimer(self, at):
        self.called(self.timers.add(at))

    def deleteTimer(self, at):
        self.called(self.timers.discard(at))


def run(processor, rounds):
    """All that comes out: of each (rows in pieces, watermark in ms), rows first, then timers that the watermark has passed."""
    handle, out = Handle(), []
    processor.init(handle)
    mark = 0
    for pieces, then in rounds:
        if pieces:
            out += processor.handleInputRows((0,), iter(pieces), SimpleNamespace(getCurrentWatermarkInMs=lambda m=mark: m))
        mark = then
        for at in sorted(t for t in handle.timers if t <= mark):
            handle.timers.discard(at)
            out += processor.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda m=mark: m), None)
    assert not handle.timers
    found = pd.concat(out).astype(object)
    return found.where([[v is not pd.NA and v is not None for v in row] for row in found.itertuples(index=False)], None), handle.calls


def pieces(rows, size=700):
    frame = pd.DataFrame(rows, columns=["key", "at", "id", "no_id", "value"])
    return [frame.iloc[k : k + size] for k in range(0, len(frame), size)]


def made(seed, n=6000):
    """Rows of a few keys, one of them null, over ten days, in any order; some without an id, some at the same time, one value no number."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        none = i % 500 == 3
        rows.append((rng.choice(["a", "b", None, "ü"]), rng.randrange(10 * 86_400) * 1_000_000 + rng.choice([0, 0, 7]), 0 if none else i + 2**60, none, math.nan if i == 77 else float(rng.randrange(50))))
    return rows


def test_increases_of_a_group(monkeypatch):
    rows, far = made(1), 10**9
    late = [("a", 5, 1, False, 3.0), (None, 6, 0, True, math.nan)]
    again = [(*rows[9][:4], 41.0)]  # the same sample again: the later value counts
    monkeypatch.setattr(stateful, "HELD", 1000)
    first, second = [r for r in rows if r[1] < 6 * 86_400_000_000], [r for r in rows if r[1] >= 5 * 86_400_000_000]
    early = [r for r in first if r not in second]
    if rows[9] in early:
        early += again
    else:
        second += again
    found, calls = run(stateful.Increases(), [(pieces(early), 3 * 86_400_000 + 5), (pieces(late), 5 * 86_400_000), (pieces(second), far), (None, far)])
    kept = {r[:4]: r[4] for r in [*rows, *again]}
    expected, before = [], {}
    for (key, at, id, none), value in sorted(kept.items(), key=lambda r: (str(r[0][0]), r[0][1], r[0][3], r[0][2])):
        b = before.get(key)
        expected.append((key, at, None if none else id, value, None if b is None else value - b if value >= b else value))
        before[key] = value
    tell = lambda r: tuple("nan" if isinstance(v, float) and math.isnan(v) else str(v) for v in r)
    samples = found[found["kind"] == "sample"][["key", "at", "id", "value", "increase"]]
    assert sorted(map(tell, samples.itertuples(index=False))) == sorted(map(tell, expected))
    assert [tell(r)[:4] for r in found[found["kind"] == "late"][["key", "at", "id", "value"]].itertuples(index=False)] == [("a", "5", "1", "3.0"), ("None", "6", "None", "nan")]
    assert calls < len(rows) / 4  # a state and a timer for each sample took more calls than rows


def test_sessions_of_a_group(monkeypatch):
    rows, far, gap = made(2), 10**9, 300_000_000
    monkeypatch.setattr(stateful, "HELD", 1000)
    late = [(None, 6, 4, False, 0.0)]
    day = 86_400_000
    early, second = [r for r in rows if r[1] < 5 * day * 1000], [r for r in rows if r[1] >= 5 * day * 1000]
    found, calls = run(stateful.Sessions(gap), [(pieces(early), 4 * day), (pieces(late), 5 * day), (pieces(second), far), (None, far)])
    expected = []
    for key in ("a", "b", None, "ü"):
        times = np.array(sorted(r[1] for r in rows if r[0] == key))
        for run_of in np.split(times, np.flatnonzero(np.diff(times) >= gap) + 1):
            expected.append((key, int(run_of[0]), int(run_of[-1]), len(run_of)))
    sessions = found[found["kind"] == "session"][["key", "first", "last", "events"]]
    assert sorted(map(str, sessions.itertuples(index=False, name=None))) == sorted(map(str, expected))
    assert list(found[found["kind"] == "late"][["key", "at", "id"]].itertuples(index=False, name=None)) == [(None, 6, 4)]
    assert calls < len(rows) / 4
