"""Captured writes as the conformed input table (schema 1.2), and S9 heartbeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.schema import HEARTBEAT_MESSAGE, HEARTBEAT_PATH, WRITE_SCHEMA


def write_events(df: DataFrame, **columns) -> DataFrame:
    """Conform any table or stream of writes to schema 1.2.

    ``columns`` maps a schema field to a Column or a source column name
    (default: the field itself). Missing ``prefix`` is '/', missing ``size`` the
    byte length of ``buf``, missing ``offset``/``pid``/``uid``/``gid`` 0 (the
    tail source has no caller), missing ``seq`` a monotonically increasing id.
    ``buf`` is cut to its first ``size`` bytes.
    """
    def pick(name):
        v = columns.get(name, name)
        if isinstance(v, Column):
            return v
        return F.col(v) if v in df.columns else None

    buf = pick("buf")
    buf = buf.cast("binary") if buf is not None else F.lit(b"").cast("binary")
    size = pick("size")
    size = size.cast("bigint") if size is not None else F.octet_length(buf).cast("bigint")
    defaults = {
        "seq": F.monotonically_increasing_id(),
        "ts": F.current_timestamp(),
        "prefix": F.lit("/"),
        "path": F.lit(None).cast("string"),
        "offset": F.lit(0),
        "pid": F.lit(0),
        "uid": F.lit(0),
        "gid": F.lit(0),
    }
    out = []
    for field in WRITE_SCHEMA.fields:
        if field.name == "buf":
            c = F.substr(buf, F.lit(1), size.cast("int"))
        elif field.name == "size":
            c = size
        else:
            c = pick(field.name)
            c = c if c is not None else defaults[field.name]
        out.append(c.cast(field.dataType).alias(field.name))
    return df.select(*out)


def heartbeat(spark: SparkSession, start: Column | str, end: Column | str, bounds: DataFrame | None = None,
              rows_per_second: int = 1) -> DataFrame:
    """S9 (batch): ``ping`` from ``/example`` every 1/``rows_per_second`` s over
    ``[start, end]`` (whole seconds).

    ``bounds`` is a one-row frame holding ``start``/``end`` (e.g. an aggregate
    of a table). The span is cut into hours first and the hours are
    repartitioned before each expands to its 3600 ticks, so no task generates
    more than an hour of rows.
    """
    b = bounds.select(F.date_trunc("second", F.col(start) if isinstance(start, str) else start).alias("s"),
                      F.date_trunc("second", F.col(end) if isinstance(end, str) else end).alias("e"))
    hours = b.select("s", "e", F.explode(F.sequence(
        F.date_trunc("hour", F.col("s")), F.date_trunc("hour", F.col("e")),
        F.expr("INTERVAL 1 HOUR"))).alias("h"))
    step_us = 1_000_000 // rows_per_second
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(step_us / 1e6).cast("decimal(18,6)"))
    last = F.col("h") + F.expr("INTERVAL 1 HOUR") - step
    ticks = hours.repartition(F.col("h")).select(
        "s", "e", F.explode(F.sequence(F.col("h"), last, step)).alias("ts"))
    return ticks.where((F.col("ts") >= F.col("s")) & (F.col("ts") <= F.col("e"))).select(
        "ts", F.lit(HEARTBEAT_PATH).alias("path"), F.lit(HEARTBEAT_MESSAGE).alias("message"))


def heartbeat_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """S9 (stream): the built-in rate source, one ``ping`` per tick."""
    return (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
            .select(F.col("timestamp").alias("ts"), F.lit(HEARTBEAT_PATH).alias("path"),
                    F.lit(HEARTBEAT_MESSAGE).alias("message"), F.col("value").alias("seq")))
