"""G2 on a stream: the ids that never arrived, as ranges.

Ids are issued in order of time, ``0, 1, 2, ...``; they may arrive in any order within
the watermark. A run of missing ids is final once the watermark has passed the time of an
id beyond it, and is then emitted, once. A task merges the ids of its share of a
micro-batch into ranges before the shuffle, and the state of a key is the sorted list of
ranges beyond the last final id, packed, so it grows with the open gaps and not with the
ids. A micro-batch's ranges are gathered until they are as many as the state's (``GATHER`` at
least) before they are merged into it, so the work does not grow with the square of either.

Ids that arrive behind the last final id are *late*: ids of an emitted gap come out as
ranges flagged ``late`` (a correction of that gap), repeats of received ids do not. The
ids behind the last gap are known when a closing row says so: an id ``n`` stands for "``n``
ids were sent" and counts as received itself, like the closing row of the batch operator.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from weir.streaming.ordered import DEFAULT_DELAY, PROVIDER, by_value

_NEVER = -(1 << 62)
#: Ranges gathered before they are merged into the state.
GATHER = 1 << 20
_RANGES = "key string, lo long, hi long, since long"


def merge_ranges(lo, hi, since):
    """Sorted disjoint ranges ``[lo, hi]`` of the same ids, neighbours joined; a range keeps
    the earliest time of its ids."""
    import numpy as np

    order = np.argsort(lo, kind="stable")
    lo, hi, since = lo[order], hi[order], since[order]
    reach = np.maximum.accumulate(hi)
    first = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1] + 1]))
    return lo[first], np.maximum.reduceat(hi, first), np.minimum.reduceat(since, first)


def _merge_task(batches: Iterator) -> Iterator:
    """Task: rows ``key, id, us`` -> ranges of each batch."""
    import pandas as pd

    for pdf in batches:
        out = []
        pdf = pdf[(pdf["id"] >= 0) & (pdf["us"] > _NEVER)]
        for key, g in pdf.groupby("key"):
            lo, hi, since = merge_ranges(g["id"].to_numpy(), g["id"].to_numpy(), g["us"].to_numpy())
            out.append(pd.DataFrame({"key": key, "lo": lo, "hi": hi, "since": since}))
        if out:
            yield pd.concat(out)


def _packed(arrays) -> tuple:
    return tuple(a.astype("<i8").tobytes() for a in arrays)


def _unpacked(row) -> list:
    import numpy as np

    return [np.frombuffer(bytes(b), dtype="<i8") for b in row]


def _lists(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.BinaryType()) for n in names])


def gap_processor() -> StatefulProcessor:
    class Gaps(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.ranges = handle.getValueState("weir_ranges", _lists("lo", "hi", "since"))
            # Ids up to ``done`` are final; ``gone`` are those of them that did not arrive.
            self.done = handle.getValueState("weir_done", T.StructType([T.StructField("id", T.LongType())]))
            self.gone = handle.getValueState("weir_gone", _lists("lo", "hi"))
            self.timer = handle.getValueState("weir_timer", T.StructType([T.StructField("ms", T.LongType())]))

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            done = self.done.get()
            done = done[0] if done else -1
            held = self.ranges.get()
            parts = _unpacked(held) if held else [np.empty(0, np.int64)] * 3
            fresh, n = [], 0
            for pdf in rows:
                lo, hi, since = (pdf[c].to_numpy(dtype=np.int64) for c in ("lo", "hi", "since"))
                behind = lo <= done
                if behind.any():
                    late = self.take_late(lo[behind], np.minimum(hi[behind], done))
                    if len(late):
                        yield pd.DataFrame({"key": key[0], "first": late[:, 0], "last": late[:, 1], "late": True})
                ahead = hi > done
                fresh.append((np.maximum(lo[ahead], done + 1), hi[ahead], since[ahead]))
                n += len(fresh[-1][0])
                if n >= max(GATHER, len(parts[0])):
                    parts, fresh, n = self.merged(parts, fresh), [], 0
            if n:
                parts = self.merged(parts, fresh)
            if len(parts[0]):
                self.keep(parts)

        @staticmethod
        def merged(parts, fresh) -> list:
            import numpy as np

            return list(merge_ranges(*(np.concatenate(some) for some in zip(parts, *fresh))))

        def keep(self, parts) -> None:
            self.ranges.update(_packed(parts))
            # One timer: when the first of the open ranges is due.
            due = int(parts[2].min()) // 1000 + 1
            old = self.timer.get()
            if old and old[0] != due:
                self.handle.deleteTimer(old[0])
            if not old or old[0] != due:
                self.handle.registerTimer(due)
                self.timer.update((due,))

        def take_late(self, lo, hi):
            """The late ids that an emitted gap holds, as ranges; the gap loses them."""
            import numpy as np

            gone = self.gone.get()
            if not gone:
                return np.empty((0, 2), np.int64)
            lo, hi, _ = merge_ranges(lo, hi, lo)
            late, left = [], []
            for a, b in zip(*(x.tolist() for x in _unpacked(gone))):
                at = a
                for x, y in zip(lo.tolist(), hi.tolist()):
                    if x > b or y < at:
                        continue
                    late.append((max(x, at), min(y, b)))
                    if x > at:
                        left.append((at, x - 1))
                    at = y + 1
                    if at > b:
                        break
                if at <= b:
                    left.append((at, b))
            if left:
                self.gone.update(_packed(np.array(left, dtype=np.int64).T))
            else:
                self.gone.clear()
            return np.array(late, dtype=np.int64).reshape(-1, 2)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            import numpy as np
            import pandas as pd

            old = self.timer.get()
            if old and old[0] == expiredTimerInfo.getExpiryTimeInMs():
                self.timer.clear()
            held = self.ranges.get()
            if not held:
                return
            lo, hi, since = _unpacked(held)
            passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) * 1000
            due = np.flatnonzero(since < passed)
            if not len(due):
                self.keep([lo, hi, since])
                return
            n = int(due[-1]) + 1
            done = self.done.get()
            before = np.concatenate([[done[0] if done else -1], hi[:n - 1]])
            gap = lo[:n] > before + 1
            first, last = before[gap] + 1, lo[:n][gap] - 1
            self.done.update((int(hi[n - 1]),))
            if len(first):
                gone = self.gone.get()
                both = zip(_unpacked(gone), (first, last)) if gone else ((first,), (last,))
                self.gone.update(_packed([np.concatenate(some) for some in both]))
                yield pd.DataFrame({"key": key[0], "first": first, "last": last, "late": False})
            if n < len(lo):
                self.keep([lo[n:], hi[n:], since[n:]])
            else:
                self.ranges.clear()

        def close(self) -> None:
            pass

    return Gaps()


def missing_ranges_stream(received: DataFrame, id_col: str = "id", ts: str = "ts", by: Sequence[str] = (),
                          delay: str = DEFAULT_DELAY) -> DataFrame:
    """``key, first, last, late``: per ``by`` (as JSON in ``key``; one key without it) the
    maximal runs of missing ids, each once it is final, and late ids of emitted runs. Ids that
    are null or negative and rows without a time count for nothing."""
    spark = received.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    q = lambda c: F.col(f"`{c}`")
    key = F.to_json(F.struct(*[q(c) for c in by])) if by else F.lit("{}")
    rows = received.withColumn("weir_time", q(ts).cast("timestamp")).withWatermark("weir_time", delay)
    # Rows that count for nothing still move the watermark: they are left out behind it, where
    # no filter is pushed.
    rows = rows.select(key.alias("key"), F.coalesce(q(id_col).cast("long"), F.lit(-1).cast("long")).alias("id"),
                       F.coalesce(F.unix_micros("weir_time"), F.lit(_NEVER)).alias("us"))
    by_value(__name__)
    ranges = rows.mapInPandas(_merge_task, _RANGES)
    return ranges.groupBy("key").transformWithStateInPandas(
        statefulProcessor=gap_processor(), outputStructType="key string, first long, last long, late boolean",
        outputMode="Append", timeMode="EventTime")
