"""The processors of the ordered streams over large keys, with a state store in memory."""

import random
from types import SimpleNamespace

import numpy as np
import pandas as pd

from weir.streaming import gaps, ordered, steps


class Cells(dict):
    """A map state and a value state."""

    def getValue(self, k):
        return self.get_(k)

    def get_(self, k):
        return dict.get(self, k)

    def updateValue(self, k, v):
        self[k] = v

    def removeKey(self, k):
        self.pop(k, None)

    def get(self):
        return dict.get(self, "v")

    def update(self, v):
        self["v"] = v


class Handle:
    def __init__(self):
        self.states, self.timers = {}, []

    def getMapState(self, name, *_):
        return self.states.setdefault(name, Cells())

    def getValueState(self, name, *_):
        return self.states.setdefault(name, Cells())

    def registerTimer(self, ms):
        self.timers.append(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


def times(ms):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)


def expiry(ms):
    return SimpleNamespace(getExpiryTimeInMs=lambda: ms)


def plain_quota(rows, quota):
    last, out = {}, {}
    for us, seq, name, size in sorted(rows):
        dt = us - last.get(name, us)
        out[seq] = name in last and (dt == 0 or size * 1e6 / dt > quota)
        last[name] = us
    return out


def test_a_large_bucket_is_released_in_slices_and_keys_share_their_state(monkeypatch):
    monkeypatch.setattr(ordered, "RUN_ROWS", 64)
    monkeypatch.setattr(ordered, "PART_ROWS", 8)
    monkeypatch.setattr(ordered, "SLICE_ROWS", 32)
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 2000) * 1000, i, f"k{rnd.randint(0, 200)}", rnd.choice([1.0, 90.0])) for i in range(3000)]

    class Watched(steps.Quota):
        sizes = []

        def run(self, pdf):
            self.sizes.append(len(pdf))
            return super().run(pdf)

    step = Watched.__new__(Watched)
    step.quota, step.drop = 100.0, False
    handle = Handle()
    p = ordered.ordered_processor([step], 10**6, ["overflow"])
    p.init(handle)

    def frames():
        for at in range(0, len(rows), 20):
            some = rows[at:at + 20]
            yield pd.DataFrame({"weir_key": "0", "weir_row": [str(r[1]) for r in some], "weir_kind": ordered.DATA,
                                "weir_us": [r[0] for r in some], "weir_seq": [r[1] for r in some], "weir_untimed": False,
                                "weir_name": [r[2] for r in some], "weir_size": [r[3] for r in some]})

    assert list(p.handleInputRows(("0",), frames(), times(0))) == []
    out = pd.concat(p.handleExpiredTimer(("0",), times(10**9), expiry(10**6)))
    assert out["weir_row"].astype(int).tolist() == [r[1] for r in sorted(rows)]
    assert dict(zip(out["weir_row"].astype(int), out["overflow"])) == plain_quota(rows, 100.0)
    assert sum(step.sizes) == 3000 and max(step.sizes) < 1000 and len(step.sizes) > 5
    assert len(handle.states["weir_seen"]) <= steps.SLOTS and not handle.states["weir_buffer"] and not handle.states["weir_parts"]


def test_late_versions_older_than_the_known_one_are_passed_over():
    step = steps.InForce()
    step.open(Handle())

    def frame(*rows):
        return pd.DataFrame(rows, columns=["weir_us", "weir_seq", "weir_kind", "weir_row"])

    first = step.run(frame((1, 1, 1, "a"), (5, 2, 0, "v5"), (5, 3, 1, "b"), (7, 1, 0, "v7"), (7, 1, 1, "c")))
    assert first["version"].tolist() == [None, "v5", "v5", "v7", "v7"]
    second = step.run(frame((3, 1, 0, "v3"), (6, 9, 0, "v6"), (8, 1, 1, "d"), (9, 1, 0, "v9"), (9, 1, 1, "e")))
    assert second["version"].tolist()[2:] == ["v7", "v9", "v9"]


def test_gap_ranges_are_merged_as_often_as_they_double(monkeypatch):
    monkeypatch.setattr(gaps, "GATHER", 50)
    merges = []
    plain = gaps.merge_ranges
    monkeypatch.setattr(gaps, "merge_ranges", lambda *a: merges.append(len(a[0])) or plain(*a))
    rnd = random.Random(9)
    ids = [i for i in range(4000) if i % 7] + [4000]
    rnd.shuffle(ids)
    p = gaps.gap_processor()
    p.init(Handle())
    parts = [ids[i:i + 10] for i in range(0, len(ids), 10)]
    frames = (pd.DataFrame({"key": "{}", "lo": some, "hi": some, "since": np.array(some) * 1000}) for some in parts)
    assert list(p.handleInputRows(("{}",), frames, times(0))) == []
    out = pd.concat(p.handleExpiredTimer(("{}",), times(10**6), expiry(10**6)))
    assert out["first"].tolist() == out["last"].tolist() == list(range(0, 4000, 7))
    assert len(merges) < 15 < len(parts)
    late = pd.concat(p.handleInputRows(("{}",), iter([pd.DataFrame({"key": "{}", "lo": [7], "hi": [7], "since": [0]})]), times(10**6)))
    assert late[["first", "last", "late"]].values.tolist() == [[7, 7, True]]
    assert list(p.handleInputRows(("{}",), iter([pd.DataFrame({"key": "{}", "lo": [7], "hi": [7], "since": [0]})]), times(10**6))) == []
