"""Q2: the per-path rate quota on a stream.

Each key (path) keeps one value in the state store: the time of its last event,
in microseconds. Rows of a micro-batch are taken in ``(ts, seq)`` order; the rule
is the batch one (``weir.operators.quota``). A row older than the stored time
(late data) passes and does not move the time back. By default the state is kept
for good, so a stream drops what the batch operator drops; ``ttl_ms`` forgets keys
that went quiet for so long, whose next event then passes as a first one.

A key's rows of one micro-batch are ordered together (the rule needs their order),
so a micro-batch's share of the hottest key must fit in a Python worker: bound it
with the source's ``maxBytesPerTrigger``. The rule itself is one numpy pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

_STATE = T.StructType([T.StructField("last_us", T.LongType())])


def quota_processor(quota: float, size_col: str = "size", seq_col: str = "seq",
                    ttl_ms: int | None = None, keep_dropped: bool = False) -> StatefulProcessor:
    """The processor, built inside a function so it is pickled by value (the
    driver-side runner of stateful processors does not see ``--py-files``)."""
    state_schema = _STATE

    class QuotaProcessor(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.last = handle.getValueState("last_us", state_schema, ttl_ms)

        def handleInputRows(self, key, rows, timerValues):
            import numpy as np
            import pandas as pd

            pdf = pd.concat(list(rows), ignore_index=True)
            if pdf.empty:
                return
            pdf = pdf.sort_values(["weir_us", seq_col], kind="stable").reset_index(drop=True)
            us = pdf["weir_us"].to_numpy(dtype=np.int64)
            known = self.last.exists()
            start = self.last.get()[0] if known else us[0]
            # The time each row is measured from: late rows never move it back.
            seen = np.maximum.accumulate(np.concatenate([[start], us]))
            dt = us - seen[:-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                rate = pdf[size_col].to_numpy(dtype=np.float64) * 1e6 / dt
            overflow = (dt == 0) | (dt > 0) & (rate > quota)
            if not known:
                overflow[0] = False
            self.last.update((int(seen[-1]),))
            pdf["overflow"] = overflow
            out = pdf if keep_dropped else pdf[~pdf["overflow"]]
            yield out.drop(columns=["weir_us"])

        def close(self) -> None:
            pass

    return QuotaProcessor()


def rate_limit_stream(df: DataFrame, quota: float, key: str = "path", ts: str = "ts", size: str = "size",
                      seq: str = "seq", keep_dropped: bool = False, ttl_ms: int | None = None) -> DataFrame:
    """Stream of the rows under the quota (or all rows with ``overflow`` when
    ``keep_dropped``). Needs the RocksDB state store provider."""
    spark = df.sparkSession
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != provider:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", provider)
    staged = df.withColumn("weir_us", F.unix_micros(F.col(ts).cast("timestamp")))
    out_schema = T.StructType([f for f in staged.schema.fields if f.name != "weir_us"]
                              + [T.StructField("overflow", T.BooleanType())])
    return staged.groupBy(key).transformWithStateInPandas(
        statefulProcessor=quota_processor(float(quota), size, seq, ttl_ms, keep_dropped),
        outputStructType=out_schema, outputMode="Append", timeMode="None" if ttl_ms is None else "ProcessingTime")
