"""Delivery checks (G2-G6): what was sent against what arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.functions.scalars import ruby_to_i
from weir.schema import MESSAGE_SIZE_KEY


def missing_ranges(received: DataFrame, n: int | None = None, expected: DataFrame | None = None,
                   id_col: str = "id", block: int = 1 << 20) -> DataFrame:
    """Maximal runs ``[first, last]`` (inclusive) of ids in ``0 .. n-1`` that
    were not received. ``n`` is a number, or ``expected`` a one-row frame with a
    column ``n`` (e.g. the count of what was sent; a scalar subquery of the plan).

    Distributed gaps-and-islands on one shuffle of the ids: they are grouped in
    blocks of ``block`` ids, made distinct and given their successor inside the
    block. Gaps inside a block come straight from ``lead``. Each block's first and
    last id (one row per block -- the only part ordered as a whole) and a closing
    row at ``n`` give the gaps before, between and after the blocks. Nothing is
    run or written while the plan is built.
    """
    if expected is not None:
        total = F.coalesce(expected.agg(F.max(F.col("n").cast("bigint"))).scalar(), F.lit(0).cast("bigint"))
    else:
        total = F.lit(int(n)).cast("bigint")
    ids = (received.select(F.col(id_col).cast("bigint").alias("id"))
           .where((F.col("id") >= 0) & (F.col("id") < total))
           .withColumn("__blk", F.floor(F.col("id") / block))
           .repartition("__blk").distinct())
    w = Window.partitionBy("__blk").orderBy("id")
    inner = ids.withColumn("__next", F.lead("id").over(w)).where(F.col("__next") > F.col("id") + 1).select(
        (F.col("id") + 1).alias("first"), (F.col("__next") - 1).alias("last"))
    blocks = ids.groupBy("__blk").agg(F.min("id").alias("__lo"), F.max("id").alias("__hi")).select("__lo", "__hi")
    closing = received.sparkSession.range(1).select(total.alias("__lo"), total.alias("__hi"))
    prev = F.coalesce(F.lag("__hi").over(Window.orderBy("__lo")), F.lit(-1).cast("bigint"))
    between = blocks.unionByName(closing).withColumn("__prev", prev).where(F.col("__prev") + 1 < F.col("__lo")).select(
        (F.col("__prev") + 1).alias("first"), (F.col("__lo") - 1).alias("last"))
    return inner.unionByName(between)


def explode_numbers(df: DataFrame, message: str = "@message", keep=()) -> DataFrame:
    """Every white-space separated item of the message as an integer, as
    Ruby's ``to_i`` reads it (leading digits, else 0)."""
    items = F.filter(F.split(F.trim(F.col(f"`{message}`")), r"\s+"), lambda x: x != "")
    return df.select(*keep, F.posexplode(items).alias("pos", "item")) \
        .withColumn("number", ruby_to_i("item"))


def delivery_summary(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Number of saved events and the time they span (microseconds)."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.agg(F.count(F.lit(1)).alias("events"),
                  (F.max(us) - F.min(us)).alias("duration_us"))


def compare_captures(a: DataFrame, b: DataFrame, key: str = "path", value: str = "message") -> DataFrame:
    """Per key, events captured by ``a`` and by ``b`` and, as multisets of
    ``(key, value)``, how many are only in ``a`` and only in ``b`` (what
    ``exceptAll`` gives both ways).

    One pass: both captures are unioned with a side flag, counted per
    ``(key, value)`` (partial aggregates, so a hot key or a repeated message is
    combined map-side), and the differences summed per key. Each input is read
    once; two shuffles in all."""
    ka = a.select(F.col(key).alias("key"), F.col(value).alias("value"), F.lit(1).alias("__in_a"))
    kb = b.select(F.col(key).alias("key"), F.col(value).alias("value"), F.lit(0).alias("__in_a"))
    per_value = ka.unionByName(kb).groupBy("key", "value").agg(
        F.sum("__in_a").alias("__ca"), F.sum(1 - F.col("__in_a")).alias("__cb"))
    return per_value.groupBy("key").agg(
        F.sum("__ca").alias("n_a"), F.sum("__cb").alias("n_b"),
        F.sum(F.greatest(F.col("__ca") - F.col("__cb"), F.lit(0))).alias("only_a"),
        F.sum(F.greatest(F.col("__cb") - F.col("__ca"), F.lit(0))).alias("only_b"),
    ).select(F.col("key").alias(key), "n_a", "n_b", "only_a", "only_b")


def volume_by_path(df: DataFrame, path: str = "path", size: str = MESSAGE_SIZE_KEY) -> DataFrame:
    """Events and message bytes per path."""
    return df.groupBy(path).agg(F.count(F.lit(1)).alias("events"),
                                F.sum(F.col(f"`{size}`")).cast("bigint").alias("bytes"))
