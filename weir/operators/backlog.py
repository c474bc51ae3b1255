"""Backlog, replay and readiness routing (Q6-Q8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.operators.filters import exclude_paths
from weir.operators.joins import asof_join
from weir.operators.quota import rate_limit
from weir.schema import DEFAULT_BACKLOG


#: Parts a shard's rows are ranked in before the final ranking.
BACKLOG_PARTS = 32


def bounded_backlog(df: DataFrame, n: int = DEFAULT_BACKLOG, shard: str | None = None,
                    ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Q6: keep the newest ``n`` rows (drop-oldest); the rows come newest first,
    ``drain(ordered=True)`` gives replay order.

    Whole stream: a top-k (``TakeOrderedAndProject``: each task keeps its own
    newest ``n``, the final merge sees at most ``n`` per task). Per ``shard``, in
    two stages whatever ``n``: rows are ranked in ``BACKLOG_PARTS`` hash parts of
    their shard, and the newest ``n`` of each part are ranked again, so no task
    sorts more of a hot shard than a part of it or ``BACKLOG_PARTS * n`` rows.
    """
    newest = [F.col(ts).desc(), F.col(seq).desc()]
    if shard is None:
        return df.orderBy(*newest).limit(n)
    part = F.pmod(F.xxhash64(F.col(seq), F.col(ts)), F.lit(BACKLOG_PARTS))
    ranked = df.withColumn("__part", part).withColumn(
        "__rn", F.row_number().over(Window.partitionBy(shard, "__part").orderBy(*newest))).where(F.col("__rn") <= n)
    return ranked.withColumn("__rn", F.row_number().over(Window.partitionBy(shard).orderBy(*newest))) \
        .where(F.col("__rn") <= n).drop("__rn", "__part")


def drain(backlog: DataFrame, live: DataFrame, patterns=(), quota: float | None = None,
          ordered: bool = False, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Q7: replay the backlog before the live rows, through the filters in force
    at replay time: exclusion globs, then the quota (whose state sees the
    backlog rows first, since they are older). ``ordered`` sorts the result by
    ``(ts, seq)`` (a range-partitioned sort)."""
    both = backlog.unionByName(live, allowMissingColumns=True)
    if patterns:
        both = exclude_paths(both, patterns)
    both = rate_limit(both, quota, ts=ts, seq=seq)
    return both.orderBy(ts, seq) if ordered else both


def route_ready(df: DataFrame, status: DataFrame, ts: str = "ts", status_ts: str = "ts",
                ready: str = "ready", status_seq: str | None = None):
    """Q8: split rows by the sink state in force at their time (as-of join on
    the status history). Returns ``(to_sink, to_backlog)``; before the first
    status the sink is not ready, and rows without a time go to the backlog."""
    j = with_ready(df, status, ts, status_ts, ready, status_seq)
    return j.where("__ready").drop("__ready"), j.where("NOT __ready").drop("__ready")


def with_ready(df: DataFrame, status: DataFrame, ts: str = "ts", status_ts: str = "ts", ready: str = "ready",
               status_seq: str | None = None, out: str = "__ready") -> DataFrame:
    """``df`` with the sink's state (boolean ``out``): one labelled frame, for
    writers that route both ways in one pass (``partitionBy(out)``)."""
    cols = [F.col(status_ts).alias("__sts"), F.col(ready).alias("__state")]
    s = status.select(*cols, *([F.col(status_seq).alias("__sseq")] if status_seq else []))
    j = asof_join(df, s, ts, "__sts", seq="__sseq" if status_seq else None)
    return j.withColumn(out, F.coalesce(F.col("__state"), F.lit(False))).drop("__sts", "__state", "__sseq")
