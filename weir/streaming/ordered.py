"""Stateful operators in event order.

``in_event_order`` puts a reorder buffer in front of a chain of *steps*. The rows of a
key wait in the state store until the watermark has passed their time bucket; then the
bucket is sorted by ``(ts, seq)`` and handed to the steps, which keep what they need in
state of their own. Any interleaving of micro-batches inside the watermark therefore
gives the steps the rows in the same order, and gives what the batch operators give.

* The buffer is a map ``(bucket, part) -> rows`` (an Arrow stream each). A micro-batch sorts
  ``RUN_ROWS`` rows of a key at a time and appends them to their bucket in parts of
  ``PART_ROWS``, without rewriting older ones. One event-time timer per bucket releases it:
  its parts are merged in order of their first time and go to the steps in slices of about
  ``SLICE_ROWS``, so a bucket of any size is never held whole, only a slice and one part of
  each run (and the rows of one microsecond).
* Rows whose bucket has been released, and rows without a time, are *late*: they come
  out at once, flagged ``late``, and no step sees them. ``sinks.write_routed`` sends them
  to a sink of their own.
* Control rows (configuration versions, sink states) go through the same buffer: rows
  of a second stream, copied to every shard, that sort before data rows of their time.
  Early ones wait. One that comes late is given to the steps with the next bucket, and
  they take it if it is newer than what they know. The watermark follows the data
  stream alone: a silent control stream does not hold it, an early version not push it.
* A row's columns travel as one JSON value and come back with their own types, so the
  pandas side sees long, double and string columns only.

Whatever holds at the end of the input stays in the buffer until the watermark moves on.
The watermark belongs to the stream; a key that falls silent is released all the same.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DEFAULT_DELAY = "1 minute"
DEFAULT_BUCKET_MS = 1000
#: Timestamps keep their microseconds on the way through JSON.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_ROWS = T.StructType([T.StructField("rows", T.BinaryType())])
_PLACE = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("part", T.IntegerType())])
_BUCKET = T.StructType([T.StructField("bucket", T.LongType())])
#: The first time and the number of rows of each part of a bucket.
_PARTS = T.StructType([T.StructField("lows", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType()))])

RUN_ROWS = 1 << 16
PART_ROWS = 1 << 10
SLICE_ROWS = 1 << 15

DATA, CONTROL = 1, 0


class Step:
    """One operator over the rows of a key in event order.

    ``run`` gets a frame with the columns ``weir_us`` (time), ``weir_seq``, ``weir_kind``
    (``DATA`` or ``CONTROL``), ``weir_row`` (the row as JSON), those named by ``needs``
    and those added by earlier steps; it returns the rows that go on, with the columns of
    ``adds``. Control rows are passed on for later steps. The rows of one time come in one
    frame; ``done`` is called when all frames that a timer releases have been run."""

    #: Input columns: name -> expression over the input, of a type that pandas holds exactly.
    needs: dict[str, Column] = {}
    #: Output columns: (name, SQL type).
    adds: Sequence[tuple[str, str]] = ()

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Open the step's state."""

    def run(self, rows):
        raise NotImplementedError

    def done(self) -> None:
        """Write what ``run`` held back."""


def pack_rows(pdf) -> bytes:
    import pyarrow as pa

    table = pa.Table.from_pandas(pdf, preserve_index=False)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def unpack_rows(data: bytes):
    import pyarrow as pa

    return pa.ipc.open_stream(data).read_all().to_pandas()


def to_table(pdf):
    import pyarrow as pa

    return pa.Table.from_pandas(pdf, preserve_index=False)


def pack_table(table) -> bytes:
    import pyarrow as pa

    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def joined(tables: list):
    """Tables of the same columns; one that holds nulls only has a type of its own."""
    import pyarrow as pa

    return pa.concat_tables(tables, promote_options="permissive") if len(tables) > 1 else tables[0]


def ordered_processor(steps: Sequence[Step], bucket_ms: int, columns: Sequence[str]) -> StatefulProcessor:
    """The processor of ``in_event_order``; ``columns`` are those of its output."""
    width = int(bucket_ms)

    class InOrder(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.buffer = handle.getMapState("weir_buffer", _PLACE, _ROWS)
            self.parts = handle.getMapState("weir_parts", _BUCKET, _PARTS)
            for step in steps:
                step.open(handle)

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np

            passed = timerValues.getCurrentWatermarkInMs()
            held, n = {}, 0
            for pdf in rows:
                if not len(pdf):
                    continue
                us = pdf["weir_us"].to_numpy(dtype=np.int64)
                bucket = us // (width * 1000)
                untimed = pdf["weir_untimed"].to_numpy(dtype=bool)
                data = (pdf["weir_kind"] == DATA).to_numpy()
                late = ((bucket + 1) * width <= passed) | untimed
                if (late & data).any():
                    yield self.finish(pdf[late & data], True)
                bucket = np.where(late, passed // width, bucket)
                stays = ~late | ~data & ~untimed
                for b in np.unique(bucket[stays]).tolist():
                    chosen = pdf[stays & (bucket == b)].drop(columns=["weir_untimed", "weir_key"])
                    held.setdefault(b, []).append(to_table(chosen))
                    n += len(chosen)
                if n >= RUN_ROWS:
                    self.keep(held)
                    held, n = {}, 0
            self.keep(held)

        def keep(self, held: dict) -> None:
            """Append the rows of each bucket, sorted by time, in parts."""
            import numpy as np

            for b, tables in held.items():
                table = joined(tables)
                us = table["weir_us"].to_numpy()
                order = np.argsort(us, kind="stable")
                table, us = table.take(order), us[order]
                known = self.parts.getValue((b,))
                if not known:
                    self.handle.registerTimer((b + 1) * width)
                lows, sizes = (list(known[0]), list(known[1])) if known else ([], [])
                for at in range(0, len(us), PART_ROWS):
                    part = table.slice(at, PART_ROWS)
                    self.buffer.updateValue((b, len(lows)), (pack_table(part),))
                    lows.append(int(us[at]))
                    sizes.append(len(part))
                self.parts.updateValue((b,), (lows, sizes))

        def released(self, b: int):
            """The rows of a bucket in order, in slices; it is empty afterwards."""
            import numpy as np
            import pyarrow as pa

            lows, sizes = self.parts.getValue((b,))
            order = np.argsort(np.array(lows, dtype=np.int64), kind="stable").tolist()
            rest, at = None, 0
            while at < len(order) or rest is not None:
                tables, n = [] if rest is None else [rest], 0
                target = max(SLICE_ROWS, 0 if rest is None else len(rest))
                while at < len(order) and n < target:
                    i = order[at]
                    tables.append(pa.ipc.open_stream(bytes(self.buffer.getValue((b, i))[0])).read_all())
                    self.buffer.removeKey((b, i))
                    n, at = n + sizes[i], at + 1
                table, rest = joined(tables), None
                if at < len(order):
                    # Parts that are still to be read begin here.
                    ready = table["weir_us"].to_numpy() < lows[order[at]]
                    rest = table.filter(pa.array(~ready))
                    table = table.filter(pa.array(ready))
                    rest = rest if len(rest) else None
                if len(table):
                    pdf = table.to_pandas()
                    yield pdf.sort_values(["weir_us", "weir_kind", "weir_seq"], kind="stable").reset_index(drop=True)
            self.parts.removeKey((b,))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            passed = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            # Timers of one key may fire in any order; its buckets are released in theirs.
            due = sorted(b for (b,) in list(self.parts.keys()) if (b + 1) * width <= passed)
            for b in due:
                for pdf in self.released(b):
                    for step in steps:
                        pdf = step.run(pdf)
                    pdf = pdf[pdf["weir_kind"] == DATA]
                    if len(pdf):
                        yield self.finish(pdf, False)
            for step in steps if due else ():
                step.done()

        @staticmethod
        def finish(pdf, late: bool):
            out = pdf[["weir_row"]].copy()
            for c in columns:
                out[c] = pdf[c] if c in pdf.columns and not late else None
            out["late"] = late
            return out

        def close(self) -> None:
            pass

    return InOrder()


def by_value(*modules: str) -> None:
    """The runner of stateful processors does not see ``--py-files``: pickle the code."""
    for name in modules:
        cloudpickle.register_pickle_by_value(sys.modules[name])


def in_event_order(df: DataFrame, key: Sequence[str], steps: Sequence[Step], ts: str = "ts", seq: str = "seq",
                   delay: str = DEFAULT_DELAY, bucket_ms: int = DEFAULT_BUCKET_MS,
                   control: DataFrame | None = None, control_ts: str = "ts", control_seq: str | None = None,
                   shards: int | None = None) -> DataFrame:
    """The columns of ``df``, those the steps add, and ``late``.

    ``key``: the columns whose rows share state. With ``shards``, rows are grouped by a hash
    of ``key`` into so many shards instead, and every row of ``control`` (a stream whose
    columns reach the steps as JSON in ``weir_row``) goes to each. Null keys are one key."""
    spark = df.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    q = lambda c: F.col(f"`{c}`")
    whole = F.struct(*[q(c) for c in df.columns])
    if shards:
        name = F.pmod(F.xxhash64(*[q(c) for c in key]), F.lit(shards)).cast("string")
    else:
        name = F.to_json(F.struct(*[q(c).alias(f"k{i}") for i, c in enumerate(key)]), _JSON)
    integral = isinstance(df.schema[seq].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    rank = F.coalesce(q(seq).cast("long"), F.lit(-(1 << 63))) if integral else F.coalesce(q(seq).cast("string"), F.lit(""))
    needs = {n: c for s in steps for n, c in s.needs.items()}

    def staged(frame: DataFrame, rows: list[Column]) -> DataFrame:
        us = F.unix_micros("weir_time")
        return frame.select(*rows, F.coalesce(us, F.lit(0)).alias("weir_us"), us.isNull().alias("weir_untimed"))

    # The watermark follows the time; the column that goes on bears no mark of it, so Spark
    # does not drop late rows before they can be flagged.
    marked = df.withColumn("weir_time", q(ts).cast("timestamp")).withWatermark("weir_time", delay)
    rows = staged(marked, [name.alias("weir_key"), rank.alias("weir_seq"), F.lit(DATA).alias("weir_kind"),
                              F.to_json(whole, _JSON).alias("weir_row"), *[c.alias(n) for n, c in needs.items()]])
    if control is not None:
        if not shards:
            raise ValueError("control rows go to every shard: say how many")
        # Without a sequence, versions of one time come in the order of a hash of their rows.
        order = q(control_seq).cast("long") if control_seq else F.xxhash64(F.to_json(F.struct(*[q(c) for c in control.columns]), _JSON))
        kinds = dict(rows.dtypes)
        order = F.coalesce(order, F.lit(-(1 << 63))) if integral else F.format_string("%020d", F.coalesce(order, F.lit(0)))
        copies = staged(control.withColumn("weir_time", q(control_ts).cast("timestamp")), [
            F.explode(F.array(*[F.lit(str(i)) for i in range(shards)])).alias("weir_key"), order.alias("weir_seq"),
            F.lit(CONTROL).alias("weir_kind"), F.to_json(F.struct(*[q(c) for c in control.columns]), _JSON).alias("weir_row"),
            *[F.lit(None).cast(kinds[n]).alias(n) for n in needs]])
        rows = rows.unionByName(copies)
    adds = [a for s in steps for a in s.adds]
    by_value(__name__, *{type(s).__module__ for s in steps})
    out = rows.groupBy("weir_key").transformWithStateInPandas(
        statefulProcessor=ordered_processor(steps, bucket_ms, [n for n, _ in adds]),
        outputStructType=T.StructType.fromDDL(", ".join(["weir_row string", *[f"`{n}` {t}" for n, t in adds], "late boolean"])),
        outputMode="Append", timeMode="EventTime")
    back = F.from_json("weir_row", T.StructType(df.schema.fields), _JSON).alias("weir_back")
    out = out.select(back, *[q(n) for n, _ in adds], "late")
    return out.select("weir_back.*", *[q(n) for n, _ in adds], "late")
