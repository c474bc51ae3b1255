"""Per-path byte-rate quota (Q1, Q3-Q5).

Rule: ``dt`` = microseconds since the previous event of the same key (kept or
dropped: the last-seen time advances on every event). The first event of a key
passes; ``dt = 0`` is dropped; otherwise the event is dropped when
``size * 1e6 / dt > quota`` (strict).

Because the last-seen time moves on drops too, "previous event" is a plain
``lag`` in ``(ts, seq)`` order -- no sequential state is needed. Every key is
lagged in two levels, so a key of any size is spread over its time buckets:

1. inside ``(key, time bucket)``, on the one exchange of the rows;
2. the last time of every bucket (one slim row each, from the same exchange) is lagged
   over its key's buckets and fills in the first row of the next.

The result is the same for every bucket width. The bounded tracker (Q3) is below:
``rate_limit_bounded``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.schema import DEFAULT_TRACKED_PATHS
from weir.session import checkpoint_dir

DEFAULT_BUCKET_SECONDS = 60

def _micros(c: str):
    return F.unix_micros(F.col(c).cast("timestamp"))


def previous_time(df: DataFrame, key="path", ts="ts", seq="seq",
                  bucket_seconds: float = DEFAULT_BUCKET_SECONDS, out="prev_us") -> DataFrame:
    """Adds ``out``: microseconds of the previous row of the same key in
    ``(ts, seq)`` order (null for the first row). Null keys are one key; rows
    without a time come before all others."""
    keys = [key] if isinstance(key, str) else list(key)
    width = int(bucket_seconds * 1_000_000)
    bucket = F.coalesce(F.floor(F.col("__us") / width), F.lit(-(1 << 62)))
    # Both the windows and the summary read this exchange; the input is read once.
    rows = df.withColumn("__us", _micros(ts)).withColumn("__b", bucket).repartition(*keys, "__b")
    inner = rows.withColumn("__lag", F.lag("__us").over(Window.partitionBy(*keys, "__b").orderBy("__us", seq)))
    names = [f"__k{i}" for i in range(len(keys))]
    last = rows.groupBy(*keys, "__b").agg(F.max("__us").alias("__last")).toDF(*names, "__bc", "__last")
    carry = last.withColumn("__carry", F.lag("__last").over(Window.partitionBy(*names).orderBy("__bc")))
    carry = carry.where(F.col("__carry").isNotNull()).drop("__last")
    same = F.col("__b") == F.col("__bc")
    for k, name in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(name))
    return inner.join(carry, same, "left").withColumn(out, F.coalesce(F.col("__lag"), F.col("__carry"))) \
        .drop("__lag", "__carry", "__b", "__bc", *names)


def flag_overflow(df: DataFrame, quota: float, key="path", ts="ts", seq="seq", size="size",
                  bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Q5: adds ``dt_us`` (null for a key's first event), ``rate`` (bytes/s,
    null when unknown or dt = 0) and ``overflow`` (would be dropped)."""
    with_prev = previous_time(df, key, ts, seq, bucket_seconds)
    dt = F.col("__us") - F.col("prev_us")
    rate = F.col(size).cast("double") * F.lit(1_000_000.0) / dt.cast("double")
    return (with_prev
            .withColumn("dt_us", dt)
            .withColumn("rate", F.when(dt > 0, rate))
            .withColumn("overflow", F.when(F.col("prev_us").isNull(), F.lit(False))
                        .when(dt == 0, F.lit(True))
                        .otherwise(rate > F.lit(float(quota))))
            .drop("__us", "prev_us"))


def rate_limit(df: DataFrame, quota: float | None, key="path", ts="ts", seq="seq", size="size",
               bucket_seconds: float = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Q1: the rows that stay under the quota. ``quota=None`` disables it."""
    if quota is None:
        return df
    cols = df.columns
    return flag_overflow(df, quota, key, ts, seq, size, bucket_seconds) \
        .where(~F.col("overflow")).select(*cols)


def last_seen(df: DataFrame, key="path", ts="ts") -> DataFrame:
    """Q4: last time each key was seen (partial aggregate, skew-safe)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.max(ts).alias("last_seen"))


def scan_ring(ring: dict | None, keys: list, us, sizes, quota: float, max_tracked: int):
    """The bounded tracker over rows in time order: ``(overflow flags, ring)``. ``keys`` are
    strings; ``ring``: the tracked ``keys`` from the oldest to the newest, and the ``last`` time
    of each (None: nothing tracked yet)."""
    import numpy as np

    names, last = (list(ring["keys"]), list(ring["last"])) if ring else ([], [])
    times = dict(zip(names, last))
    flags = np.zeros(len(keys), dtype=bool)
    oldest = 0
    for i, (k, t, size) in enumerate(zip(keys, us.tolist(), sizes.tolist())):
        before = times.get(k)
        if before is None:
            if len(times) == max_tracked:
                del times[names[oldest]]
                oldest += 1
            names.append(k)
        else:
            flags[i] = True if t == before else size * 1e6 / (t - before) > quota
        times[k] = t
    names = names[oldest:]
    return flags, {"keys": names, "last": [times[k] for k in names]}


def ring_key(key: str):
    """A key as the tracker knows it: a string, null among them."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{key}`").cast("string")), F.lit("null"))


#: Rows of a shard that one task scans between two looks at the ring.
SEGMENT_ROWS = 1 << 20
#: Pieces at most, unless one would hold more than ``SEGMENT_ROWS``.
PIECES = 256
#: Rows of one piece are numbered below this.
_PIECE = 1 << 33


def _scan_task(shard: str, quota: float, max_tracked: int, cols: list[str] | None):
    """Task: rows in ``(shard, time)`` order, ``__ring`` (JSON or null) on the first row of a
    piece -> the rows with ``overflow`` (``cols``), or the ring each piece leaves."""
    def scan(batches):
        import json

        import numpy as np
        import pandas as pd

        piece = current = object()
        ring = None
        for pdf in batches:
            if not len(pdf):
                continue
            flags = np.zeros(len(pdf), dtype=bool)
            pieces = pdf["__piece"].to_numpy()
            shards = pdf["__shard"].tolist()
            keys, us, sizes = pdf["__key"].tolist(), pdf["__us"].to_numpy(dtype=np.int64), pdf["__size"].to_numpy(dtype=np.float64)
            at, left = 0, []
            while at < len(pdf):
                end = at
                while end < len(pdf) and shards[end] == shards[at] and pieces[end] == pieces[at]:
                    end += 1
                if pieces[at] != piece:
                    if ring is not None:
                        left.append((piece, json.dumps(ring)))
                    given = pdf["__ring"].iloc[at]
                    ring = json.loads(given) if isinstance(given, str) else None
                elif shards[at] != current:
                    ring = None
                piece, current = pieces[at], shards[at]
                flags[at:end], ring = scan_ring(ring, keys[at:end], us[at:end], sizes[at:end], quota, max_tracked)
                at = end
            if cols is not None:
                out = pdf[cols].copy()
                out["overflow"] = flags
                yield out
            elif left:
                yield pd.DataFrame(left, columns=["piece", "ring"])
        if cols is None and ring is not None:
            yield pd.DataFrame([(piece, json.dumps(ring))], columns=["piece", "ring"])

    return scan


def rate_limit_bounded(df: DataFrame, quota: float, max_tracked: int = DEFAULT_TRACKED_PATHS, shard="prefix",
                       key="path", ts="ts", seq="seq", size="size", segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Q3: quota with a tracker of only ``max_tracked`` keys per shard, replaced
    first-in-first-out when a key not tracked arrives; an evicted key passes
    again as new.

    Which keys are tracked depends on the order of *all* keys of the shard, but a hit
    leaves the ring's order alone, and rings that started apart soon hold the same keys.
    So rows are range-sorted by ``(shard, ts, seq)`` into pieces of about ``segment_rows``
    (longer ones, up to ``SEGMENT_ROWS``, where that would make more than ``PIECES``, whose
    start would cost more than their scan) and written once; a shard that runs over several pieces is scanned in all of them at
    once, each from a guess (an empty ring). A piece whose guess was wrong -- the one before
    leaves another ring -- is scanned again from that ring, until no ring changes: as many
    rounds as the longest chain of wrong guesses, usually two, and for an adversarial order
    as many as the shard has pieces. The last scan, lazy, starts every piece from its
    right ring. Memory is one ring and one batch of rows per task; the rings between
    pieces stay in a table, and the driver sees counts only.

    A table of one piece is scanned by shard, nothing is written. Null keys are one key,
    null shards one shard; rows without a time come first and share time 0.
    """
    out_schema = T.StructType(df.schema.fields + [T.StructField("overflow", T.BooleanType())])
    args = (shard, float(quota), max_tracked)
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{shard}`").cast("string")), F.lit("null"))
    staged = df.withColumns({"__us": F.coalesce(_micros(ts), F.lit(0)), "__shard": name, "__key": ring_key(key),
                             "__size": F.col(f"`{size}`").cast("double")})
    order = ["__shard", F.col("__us"), F.col(f"`{seq}`")]
    total = df.count()
    n = min(-(-total // segment_rows), max(PIECES, -(-total // SEGMENT_ROWS)))
    if n <= 1:
        parts = staged.withColumns({"__piece": F.lit(0), "__ring": F.lit(None).cast("string")}).repartition("__shard")
        return parts.sortWithinPartitions(*order).mapInPandas(_scan_task(*args, df.columns), out_schema)

    spark = df.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/tracker-{uuid.uuid4().hex}"

    def table(frame: DataFrame, what: str) -> DataFrame:
        frame.write.parquet(f"{base}/{what}")
        return spark.read.schema(frame.schema).parquet(f"{base}/{what}")

    ordered = staged.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = table(ordered.withColumn("__id", F.monotonically_increasing_id()), "rows")
    rows = rows.withColumn("__piece", F.shiftright("__id", 33))

    def scanned(some: DataFrame, rings: DataFrame, cols, schema) -> DataFrame:
        given = rings.select((F.col("piece") * _PIECE).alias("__first"), F.col("ring").alias("__ring"))
        some = some.join(given, F.col("__id") == F.col("__first"), "left").drop("__first")
        # One piece a task: by a hash, some tasks would sort several pieces and others none.
        some = some.repartitionById(n, F.col("__piece").cast("int")).sortWithinPartitions("__id")
        return some.mapInPandas(_scan_task(*args, cols), schema)

    # A piece goes on where the one before it ends in the same shard.
    ends = rows.groupBy("__piece").agg(F.min("__shard").alias("first"), F.max("__shard").alias("last"))
    along = Window.orderBy("__piece")
    ends = table(ends.select(F.col("__piece").alias("piece"), "first", "last", F.lag("__piece").over(along).alias("before"),
                             F.lag("last").over(along).alias("shard_before"), F.lead("first").over(along).alias("shard_after")), "ends")
    onward = ends.where(F.col("last") == F.col("shard_after")).select("piece", "last")
    goes_on = ends.where(F.col("first") == F.col("shard_before")).select("piece", "before", "first", "last")
    none = spark.createDataFrame([], "piece long, ring string")
    leave = rows.join(onward, (F.col("__piece") == F.col("piece")) & (F.col("__shard") == F.col("last")), "left_semi")
    left = table(scanned(leave, none, None, "piece long, ring string"), "left-0")  # ring that each piece leaves
    used = none                                                                    # ring that each piece started from
    rounds = 0
    while True:
        given = goes_on.join(left.withColumnRenamed("piece", "before"), "before").select("piece", "first", "last", "ring")
        old = used.withColumnRenamed("ring", "old")
        rounds += 1
        wrong = table(given.join(old, "piece", "left").where(~F.col("ring").eqNullSafe(F.col("old")))
                      .select("piece", "first", "last", "ring"), f"wrong-{rounds}")
        used = given.select("piece", "ring")
        # Only a piece that lies in one shard hands its start on.
        again = wrong.join(onward.select("piece"), "piece", "left_semi").where(F.col("first") == F.col("last")).select("piece", "ring")
        if again.isEmpty():
            break
        some = rows.join(again.select(F.col("piece").alias("__piece")), "__piece", "left_semi")
        new = scanned(some, again, None, "piece long, ring string")
        used = table(used, f"used-{rounds}")
        left = table(left.join(again.select("piece"), "piece", "left_anti").unionByName(new), f"left-{rounds}")
    return scanned(rows, used, df.columns, out_schema)
