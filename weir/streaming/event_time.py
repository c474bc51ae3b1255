"""The stream twins of the ordered batch operators, in event time.

Each equals its batch operator for any interleaving of micro-batches inside the watermark
(``delay``); what comes later than that is flagged ``late`` and left out of the order. State
lives in the query checkpoint (RocksDB provider), so a restart goes on where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.schema import DEFAULT_BACKLOG, DEFAULT_TRACKED_PATHS
from weir.streaming.ordered import DEFAULT_BUCKET_MS, DEFAULT_DELAY, in_event_order
from weir.streaming.steps import Gate, InForce, Quota, Tracker

#: Shards of a stream whose rows take control rows; each holds a share of the backlog.
DEFAULT_SHARDS = 32


def rate_limit_event_time(df: DataFrame, quota: float, key: str = "path", ts: str = "ts", seq: str = "seq", size: str = "size",
                          delay: str = DEFAULT_DELAY, bucket_ms: int = DEFAULT_BUCKET_MS, keep_dropped: bool = False,
                          shards: int = DEFAULT_SHARDS) -> DataFrame:
    """Q2 in event time: the rows of ``operators.quota.rate_limit`` (with ``overflow``;
    ``keep_dropped``: all rows, as ``flag_overflow``), and late rows with ``late``. Keys are
    dealt to ``shards``, which buffer and release the rows of all their keys together."""
    return in_event_order(df, [key], [Quota(quota, size, drop=not keep_dropped, key=key)], ts, seq, delay, bucket_ms, shards=shards)


def rate_limit_bounded_stream(df: DataFrame, quota: float, max_tracked: int = DEFAULT_TRACKED_PATHS, shard: str = "prefix",
                              key: str = "path", ts: str = "ts", seq: str = "seq", size: str = "size",
                              delay: str = DEFAULT_DELAY, bucket_ms: int = DEFAULT_BUCKET_MS) -> DataFrame:
    """Q3 on a stream: ``overflow`` by a ring of ``max_tracked`` keys per shard, first in, first out
    across micro-batches, as ``operators.quota.rate_limit_bounded``; and ``late``."""
    return in_event_order(df, [shard], [Tracker(quota, max_tracked, key, size)], ts, seq, delay, bucket_ms)


def with_config_stream(df: DataFrame, versions: DataFrame, key: str = "path", ts: str = "ts", seq: str = "seq",
                       effective_col: str = "effective_from", version_seq: str | None = None, delay: str = DEFAULT_DELAY,
                       bucket_ms: int = DEFAULT_BUCKET_MS, shards: int = DEFAULT_SHARDS) -> DataFrame:
    """J5 on two streams: the columns of the version in force at each row's own time, as
    ``operators.enrich.with_config``, whichever of the two came first; and ``late``."""
    out = in_event_order(df, [key], [InForce()], ts, seq, delay, bucket_ms, versions, effective_col, version_seq, shards)
    return _with_version(out, df, versions)


def _with_version(out: DataFrame, df: DataFrame, versions: DataFrame) -> DataFrame:
    from weir.streaming.ordered import _JSON

    fields = [f for f in versions.schema.fields if f.name not in df.columns]
    said = F.from_json("version", T.StructType(fields), _JSON)
    return out.withColumn("version", said).select(
        *[c for c in out.columns if c != "version"], *[F.col("version")[f.name].alias(f.name) for f in fields])


def spool_until_ready(df: DataFrame, status: DataFrame, n: int = DEFAULT_BACKLOG, key: str = "path", ts: str = "ts", seq: str = "seq",
                      size: str = "size", status_ts: str = "ts", status_seq: str | None = None, delay: str = DEFAULT_DELAY,
                      bucket_ms: int = DEFAULT_BUCKET_MS, shards: int = DEFAULT_SHARDS, prefix: str | None = None,
                      **settings) -> DataFrame:
    """Q6-Q8 on a stream: the rows that leave for the sink, with ``replayed``, ``sent_at``, ``place``
    and ``late``. ``status`` (a stream) opens and closes the sink and may change the filters; see
    ``steps.Gate`` for its columns and for ``settings``, those in force before its first row.
    ``n`` rows are kept per shard; ``shards=1`` keeps the newest ``n`` of the stream."""
    return in_event_order(df, [key], [Gate(n, key, size, prefix, **settings)], ts, seq, delay, bucket_ms,
                          status, status_ts, status_seq, shards)


def live_config(df: DataFrame, versions: DataFrame, key: str = "path", ts: str = "ts", seq: str = "seq", size: str = "size",
                prefix: str | None = "prefix", effective_col: str = "effective_from", version_seq: str | None = None,
                n: int = DEFAULT_BACKLOG, delay: str = DEFAULT_DELAY, bucket_ms: int = DEFAULT_BUCKET_MS,
                shards: int = DEFAULT_SHARDS, **settings) -> DataFrame:
    """J5, F2, F4, Q1 and Q6-Q8 live, in event time: each row gets the other columns of the version
    in force at its time, and leaves through the gate and the filters of the versions
    (``steps.SETTINGS``). The sink counts as ready unless a version says otherwise."""
    settings.setdefault("ready", True)
    out = in_event_order(df, [key], [InForce(), Gate(n, key, size, prefix, **settings)], ts, seq, delay, bucket_ms,
                         versions, effective_col, version_seq, shards)
    return _with_version(out, df, versions)
