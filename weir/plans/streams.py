"""Streaming operators as registered queries: the given tables are fed as a stream of
files, in micro-batches, and the query's output is read back when all are through."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.session import checkpoint_dir

#: Micro-batches a table is fed in.
BATCHES = 4
#: State partitions of these queries.
PARTITIONS = 8
#: Closing rows lie behind all data and move the watermark past it.
CLOSING = ("2199-01-01 00:00:00", "2199-06-01 00:00:00")
#: Every row of a table arrives inside the watermark, whatever file it lies in.
DELAY = "36500 days"

#: One bucket holds a key's rows of ten years.
BUCKET_MS = 315_360_000_000


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def feed(rows: DataFrame, ts: str = "ts", last: DataFrame | None = None) -> DataFrame:
    """``rows`` as a stream, dealt over micro-batches without regard to their time, then the
    rows of ``last``, and two closing rows (nulls but for ``ts``) behind them."""
    spark = rows.sparkSession
    folder = scratch(spark, "feed")
    # Row groups small enough for several tasks to read one file.
    rows.repartition(BATCHES).write.option("parquet.block.size", 8 << 20).parquet(folder)
    if last is not None:
        last.coalesce(1).write.mode("append").parquet(folder)
    for end in CLOSING:
        last = [F.lit(end).cast("timestamp").alias(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name)
                for f in rows.schema.fields]
        spark.range(1).select(*last).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def control_feed(rows: DataFrame) -> DataFrame:
    """A control stream: all rows with the first micro-batch."""
    folder = scratch(rows.sparkSession, "control")
    rows.write.parquet(folder)
    return rows.sparkSession.readStream.schema(rows.schema).parquet(folder)


def drained(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over all there is and give its output as a table."""
    spark = df.sparkSession
    out = scratch(spark, name)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(PARTITIONS))
    try:
        query = df.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint") \
            .trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{out}/rows")
