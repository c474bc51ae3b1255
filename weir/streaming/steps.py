"""Steps for ``in_event_order``: the quota, the bounded tracker, the configuration in
force and the backlog behind a readiness gate, each with the rules of its batch twin."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from weir.functions.glob import glob_to_regex
from weir.operators.quota import ring_key, scan_ring
from weir.schema import DEFAULT_BACKLOG, DEFAULT_TRACKED_PATHS
from weir.streaming.ordered import _JSON, CONTROL, DATA, Step, pack_rows, unpack_rows

_TEXT = T.StructType([T.StructField("v", T.StringType())])


def over_quotas(codes, us, size, starts, quota: float):
    """``(overflow, last)`` of rows in time order: ``overflow`` by the key's row before, as nullable
    booleans (a rate is unknown where the size is), and the last time of each key. ``codes``: the
    keys, numbered from 0; ``starts``: the time each was last seen before (None: never)."""
    import numpy as np

    order = np.argsort(codes, kind="stable")
    code, at = codes[order], us[order]
    first = np.concatenate([[True], code[1:] != code[:-1]])
    seen = np.concatenate([[0], at[:-1]])
    known = [starts[c] for c in code[first].tolist()]
    seen[first] = [t if k is None else k for k, t in zip(known, at[first].tolist())]
    dt, some = at - seen, size[order]
    with np.errstate(divide="ignore", invalid="ignore"):
        rate = some * 1e6 / dt
    over = np.where((dt == 0) | (dt > 0) & (rate > quota), True, False).astype(object)
    over[(dt > 0) & np.isnan(some)] = None
    over[np.flatnonzero(first)[[k is None for k in known]]] = False
    out = np.empty(len(us), dtype=object)
    out[order] = over
    last = np.empty(len(starts), dtype=np.int64)
    last[code] = at
    return out, last


#: Slots that the last times of a shard's keys are dealt to.
SLOTS = 64


class Seen:
    """The time each key of a shard was last seen: a map ``slot -> keys, times``. What a timer
    releases reads and writes a slot at most once, however many keys it holds."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.slots = handle.getMapState(name, T.StructType([T.StructField("slot", T.IntegerType())]), T.StructType([
            T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("last", T.ArrayType(T.LongType()))]))
        self.read, self.changed = {}, set()

    def flags(self, names, us, size, quota: float):
        """``overflow`` of rows in time order, as ``over_quotas``; their times count as seen."""
        import zlib

        import pandas as pd

        codes, keys = pd.factorize(names)
        places, starts = [], []
        for k in keys:
            slot = zlib.crc32(k.encode("utf-8", "surrogatepass")) % SLOTS
            if slot not in self.read:
                known = self.slots.getValue((slot,))
                self.read[slot] = dict(zip(known[0], known[1])) if known else {}
            places.append(slot)
            starts.append(self.read[slot].get(k))
        flags, last = over_quotas(codes, us, size, starts, quota)
        for k, slot, t in zip(keys, places, last.tolist()):
            self.read[slot][k] = t
        self.changed.update(places)
        return flags

    def write(self) -> None:
        for slot in self.changed:
            self.slots.updateValue((slot,), (list(self.read[slot]), list(self.read[slot].values())))
        self.read, self.changed = {}, set()


class Quota(Step):
    """Q2/Q5: ``overflow`` by the key's previous event; ``drop`` keeps rows under it only."""

    adds = (("overflow", "boolean"),)

    def __init__(self, quota: float, size: str = "size", drop: bool = False, key: str = "path"):
        self.quota, self.drop = float(quota), drop
        self.needs = {"weir_name": F.to_json(F.struct(F.col(f"`{key}`").alias("k0")), _JSON),
                      "weir_size": F.col(f"`{size}`").cast("double")}

    def __getstate__(self):  # columns stay on the driver
        return {"quota": self.quota, "drop": self.drop}

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.seen = Seen(handle, "weir_seen")

    def run(self, rows):
        import numpy as np

        rows = rows.copy()
        data = (rows["weir_kind"] == DATA).to_numpy()
        flags = np.full(len(rows), None, dtype=object)
        if data.any():
            some = rows[data]
            flags[data] = self.seen.flags(some["weir_name"].to_numpy(dtype=object), some["weir_us"].to_numpy(dtype=np.int64),
                                          some["weir_size"].to_numpy(dtype=np.float64), self.quota)
        rows["overflow"] = flags
        if self.drop:
            rows = rows[~data | (flags == False)]  # noqa: E712 -- unknown is neither
        return rows

    def done(self) -> None:
        self.seen.write()


class Tracker(Step):
    """Q3: the quota with a ring of ``max_tracked`` keys per shard, replaced first in, first
    out; the ring outlives the micro-batches."""

    adds = (("overflow", "boolean"),)

    def __init__(self, quota: float, max_tracked: int = DEFAULT_TRACKED_PATHS, key: str = "path", size: str = "size"):
        self.quota, self.max_tracked = float(quota), int(max_tracked)
        self.needs = {"weir_name": ring_key(key), "weir_size": F.col(f"`{size}`").cast("double")}

    def __getstate__(self):
        return {"quota": self.quota, "max_tracked": self.max_tracked}

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getValueState("weir_ring", T.StructType([
            T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("last", T.ArrayType(T.LongType()))]))

    def run(self, rows):
        import numpy as np

        rows = rows.copy()
        data = (rows["weir_kind"] == DATA).to_numpy()
        known = self.ring.get()
        ring = {"keys": list(known[0]), "last": list(known[1])} if known else None
        some = rows[data]
        flags, ring = scan_ring(ring, some["weir_name"].tolist(), some["weir_us"].to_numpy(dtype=np.int64),
                                some["weir_size"].to_numpy(dtype=np.float64), self.quota, self.max_tracked)
        self.ring.update((ring["keys"], ring["last"]))
        over = np.full(len(rows), None, dtype=object)
        over[data] = flags
        rows["overflow"] = over
        return rows


class InForce(Step):
    """``version``, the configuration in force at each row's time, as JSON (null before the
    first): the last control row that is not later. Early versions wait in the buffer."""

    adds = (("version", "string"),)

    def open(self, handle: StatefulProcessorHandle) -> None:
        # Time, sequence and row of the version in force.
        self.now = handle.getValueState("weir_version", _TEXT)

    def run(self, rows):
        import json

        import numpy as np

        known = self.now.get()
        at, now = json.loads(known[0]) if known else (None, None)
        control = np.flatnonzero((rows["weir_kind"] == CONTROL).to_numpy())
        # Rows are in order: of versions that came late, those older than the one known come first.
        old = 0
        while at is not None and old < len(control) and _place(rows, control[old]) < at:
            old += 1
        control = control[old:]
        texts = np.concatenate([np.array([now], dtype=object), rows["weir_row"].to_numpy(dtype=object)[control]])
        versions = texts[np.searchsorted(control, np.arange(len(rows)), side="right")]
        if len(control):
            at, now = _place(rows, control[-1]), texts[-1]
        if at is not None:
            self.now.update((json.dumps([at, now]),))
        return rows.assign(version=versions)


def _place(rows, i: int) -> list:
    """Time and sequence of a row, as JSON holds them."""
    seq = rows["weir_seq"].iloc[i]
    return [int(rows["weir_us"].iloc[i]), seq if isinstance(seq, str) else int(seq)]


def _normal(path: str) -> str:
    """``operators.paths.normalize_path`` for one path."""
    stack: list[str] = []
    for part in path.split("/"):
        if part == "..":
            del stack[-1:]
        elif part not in ("", "."):
            stack.append(part)
    return "/" + "/".join(stack)


#: What a control row may say to the gate.
SETTINGS = ("ready", "excludes", "quota", "sleep_dirs", "active")


class Gate(Step):
    """Q6-Q8 with F2, F4 and Q1 in force: while the sink is not ready, rows spool into a bounded
    backlog (the newest ``n`` of the shard stay); when a control row opens it, the backlog is
    replayed first, and rows go on as they come. What leaves passes the filters in force at
    that moment: exclusion globs, sleeping directories, the quota of each path (measured
    along the rows that come to it).

    A control row is JSON with any of ``ready`` (boolean), ``excludes`` (globs), ``quota``
    (bytes a second; negative: none), ``sleep_dirs`` and ``active`` (drop what lies under them);
    what it leaves out or gives as null stays as it was. Adds ``replayed``, ``sent_at`` (when the
    row left: its own time, or the opening's) and ``place``, the order in which a shard's rows
    left."""

    adds = (("replayed", "boolean"), ("sent_at", "timestamp"), ("place", "long"))

    def __init__(self, n: int = DEFAULT_BACKLOG, path: str = "path", size: str = "size", prefix: str | None = None, **first):
        unknown = set(first) - set(SETTINGS)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        self.n = int(n)
        self.first = {"ready": False, "excludes": [], "quota": -1.0, "sleep_dirs": [], "active": False,
                      **{k: v for k, v in first.items() if v is not None}}
        text = lambda c: F.col(f"`{c}`").cast("string")
        self.needs = {"weir_path": text(path), "weir_size": F.col(f"`{size}`").cast("double"),
                      "weir_prefix": text(prefix) if prefix else F.lit(None).cast("string")}

    def __getstate__(self):
        return {"n": self.n, "first": self.first}

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.mode = handle.getValueState("weir_mode", T.StructType([
            T.StructField("settings", T.StringType()), T.StructField("place", T.LongType())]))
        # The backlog: numbered chunks of rows, the first of which may have lost rows in front.
        self.chunks = handle.getMapState("weir_chunks", T.StructType([T.StructField("no", T.LongType())]), T.StructType([
            T.StructField("n", T.LongType()), T.StructField("rows", T.BinaryType())]))
        self.ends = handle.getValueState("weir_ends", T.StructType([
            T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()), T.StructField("gone", T.LongType()),
            T.StructField("held", T.LongType())]))
        self.seen = Seen(handle, "weir_seen")

    def spool(self, rows) -> None:
        lo, hi, gone, held = self.ends.get() or (0, 0, 0, 0)
        rows = rows.iloc[max(0, len(rows) - self.n):]
        self.chunks.updateValue((hi,), (len(rows), pack_rows(rows)))
        hi, held = hi + 1, held + len(rows)
        while held > self.n:
            first = self.chunks.getValue((lo,))[0]
            drop = min(held - self.n, first - gone)
            gone, held = gone + drop, held - drop
            if gone == first:
                self.chunks.removeKey((lo,))
                lo, gone = lo + 1, 0
        self.ends.update((lo, hi, gone, held))

    def replay(self):
        lo, hi, gone, _ = self.ends.get() or (0, 0, 0, 0)
        for no in range(lo, hi):
            rows = unpack_rows(bytes(self.chunks.getValue((no,))[1])).iloc[gone:]
            self.chunks.removeKey((no,))
            gone = 0
            yield rows
        self.ends.clear()

    def filtered(self, rows, settings: dict):
        import numpy as np

        if settings["excludes"]:
            hit = re.compile("(?s:" + "|".join(f"(?:{glob_to_regex(p)})" for p in settings["excludes"]) + ")")
            rows = rows[[not (isinstance(p, str) and hit.fullmatch(p)) for p in rows["weir_path"].tolist()]]
        if settings["active"] and settings["sleep_dirs"]:
            under = tuple(_normal(d) for d in settings["sleep_dirs"])
            rows = rows[[not (isinstance(p, str) and _normal(p).startswith(under)) for p in rows["weir_prefix"].tolist()]]
        quota = float(settings["quota"])
        if quota < 0 or not len(rows):
            return rows
        us, size = rows["weir_us"].to_numpy(dtype=np.int64), rows["weir_size"].to_numpy(dtype=np.float64)
        names = np.array([p if isinstance(p, str) else "" for p in rows["weir_path"].tolist()], dtype=object)
        keep = self.seen.flags(names, us, size, quota) == False  # noqa: E712 -- unknown is neither
        return rows[keep]

    def run(self, rows):
        import json

        import pandas as pd

        known = self.mode.get()
        settings, place = (json.loads(known[0]), known[1]) if known else (dict(self.first), 0)
        out, at = [], 0

        def leave(some, when, replayed):
            nonlocal place
            some = self.filtered(some, settings).copy()
            some["replayed"] = replayed
            some["sent_at"] = pd.to_datetime(some["weir_us"] if when is None else [when] * len(some), unit="us")
            some["place"] = range(place, place + len(some))
            place += len(some)
            out.append(some)

        kinds = rows["weir_kind"].tolist()
        control = [i for i, k in enumerate(kinds) if k == CONTROL]
        for i in [*control, len(rows)]:
            some = rows.iloc[at:i]
            if len(some) and settings["ready"]:
                leave(some, None, False)
            elif len(some):
                self.spool(some)
            at = i + 1
            if i < len(rows):
                said, now = json.loads(rows["weir_row"].iloc[i]), _place(rows, i)
                if settings.get("at") is not None and now < settings["at"]:
                    continue  # came late, and newer ones are known
                was, settings["at"] = settings["ready"], now
                settings.update({k: said[k] for k in SETTINGS if said.get(k) is not None})
                if settings["ready"] and not was:
                    for held in self.replay():
                        leave(held, int(rows["weir_us"].iloc[i]), True)
        self.mode.update((json.dumps(settings), place))
        return pd.concat(out, ignore_index=True) if out else rows.iloc[:0].assign(replayed=None, sent_at=None, place=None)

    def done(self) -> None:
        self.seen.write()
