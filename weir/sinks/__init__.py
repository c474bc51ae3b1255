"""Sinks (K1, K3, K5), the event-bus source (S10, S11) and the extension
registries (X1, X2).

The Kafka connector is not on this image's classpath, so ``read_bus`` and
``write_bus`` only build the standard ``format("kafka")`` reader/writer; the
wire frame they carry (``value`` BINARY, null ``key``, ``topic``) is produced
and tested independently (``bus_frame``).
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.schema import DEFAULT_TOPIC


def bus_options(servers, topic: str = DEFAULT_TOPIC, group_id: str | None = None,
                min_partitions: int | None = None, starting: str = "latest") -> dict:
    """Options of the Kafka source: subscription, consumer group,
    parallelism (``minPartitions``) and the start position."""
    opts = {
        "kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers),
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def read_bus(spark: SparkSession, servers, topic: str = DEFAULT_TOPIC, group_id: str | None = None,
             min_partitions: int | None = None, starting: str = "latest", fmt: str = "kafka") -> DataFrame:
    """Subscribe to the topic; returns the stream of wire records
    (``value`` BINARY, plus the connector's ``topic/partition/offset``)."""
    r = spark.readStream.format(fmt)
    for k, v in bus_options(servers, topic, group_id, min_partitions, starting).items():
        r = r.option(k, v)
    return r.load()


def bus_frame(df: DataFrame, topic: str | None = None) -> DataFrame:
    """K1 frame: null key, the wire bytes as ``value``, and ``topic`` (K2) when
    the rows carry one or a name is given; partition left to the producer."""
    cols = [F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value")]
    if topic is not None:
        cols.append(F.lit(topic).alias("topic"))
    elif "topic" in df.columns:
        cols.append(F.coalesce(F.col("topic"), F.lit(DEFAULT_TOPIC)).alias("topic"))
    return df.select(*cols)


def write_bus(df: DataFrame, servers, topic: str | None = None, checkpoint: str | None = None,
              fmt: str = "kafka", trigger: dict | None = None):
    """K1: send every wire record to the bus. Streams are written with a
    checkpoint (at-least-once delivery); batch frames with ``write``."""
    frame = bus_frame(df, topic if topic is not None else (None if "topic" in df.columns else DEFAULT_TOPIC))
    servers = servers if isinstance(servers, str) else ",".join(servers)
    if not df.isStreaming:
        return frame.write.format(fmt).mode("append").option("kafka.bootstrap.servers", servers).save()
    w = frame.writeStream.format(fmt).option("kafka.bootstrap.servers", servers)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def write_console(df: DataFrame, truncate: bool = False, checkpoint: str | None = None):
    """K3: print events as they come (with S3 and the text encoder: a
    cluster-wide ``tail -f``)."""
    if not df.isStreaming:
        df.show(truncate=truncate)
        return None
    w = df.writeStream.format("console").option("truncate", str(truncate).lower())
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


class Sink:
    """A named sink with the setup / update / send / clean life cycle.

    ``send(batch_df, batch_id)`` runs once per micro-batch on the driver through
    ``foreachBatch`` and should itself write with DataFrame writers (it gets a
    distributed frame, not rows). ``update(settings)`` is called before a batch
    whose configuration differs from the last one's, ``clean()`` once when the
    frame is written or the stream ends, however it ends.
    """

    def __init__(self, name: str, send: Callable[[DataFrame, int], None],
                 setup: Callable[[], None] | None = None, clean: Callable[[], None] | None = None,
                 update: Callable[[dict], None] | None = None):
        self.name = name
        self.send = send
        self.setup = setup
        self.clean = clean
        self.update = update


_SINKS: dict[str, Sink] = {}


def register_sink(name: str, send, setup=None, clean=None, update=None) -> Sink:
    """Register a custom sink under a name."""
    sink = Sink(name, send, setup, clean, update)
    _SINKS[name] = sink
    return sink


def write_to(df: DataFrame, name: str, checkpoint: str | None = None, trigger: dict | None = None,
             config: Callable[[], dict] | None = None,
             prepare: Callable[[DataFrame, dict], DataFrame] | None = None):
    """K5: write a stream (or a batch frame) to a registered sink. ``config()`` is
    read before each batch, handed to the sink's ``update`` when it has changed, and
    ``prepare(batch, settings)`` makes the frame that is sent."""
    sink = _SINKS[name]
    last: list = []

    def send(batch: DataFrame, batch_id: int) -> None:
        settings = config() if config else {}
        if config and last != [settings]:
            if sink.update:
                sink.update(settings)
            last[:] = [settings]
        sink.send(prepare(batch, settings) if prepare else batch, batch_id)

    if sink.setup:
        sink.setup()
    if not df.isStreaming:
        try:
            send(df, 0)
        finally:
            if sink.clean:
                sink.clean()
        return None
    w = df.writeStream.foreachBatch(send)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    query = w.start()
    if sink.clean:
        def when_ended() -> None:
            try:
                query.awaitTermination()
            except Exception:  # noqa: BLE001 -- the caller sees it from the query; here it only means: ended
                pass
            sink.clean()
        threading.Thread(target=when_ended, name=f"weir-clean-{name}", daemon=True).start()
    return query


def write_routed(df: DataFrame, routes: dict[str, str], route: Column, checkpoint: str | None = None,
                 trigger: dict | None = None):
    """Write a stream to several registered sinks in one query: each row goes to the sink
    that ``routes`` names for its value of ``route`` (a string column; rows of other values
    are an error, so that none vanishes). E.g. late rows to a sink of their own::

        write_routed(rows, {"late": "late-rows", "on time": "bus"},
                     F.when(F.col("late"), "late").otherwise("on time"), checkpoint)
    """
    for name in routes.values():
        if name not in _SINKS:
            raise KeyError(name)

    def send(batch: DataFrame, batch_id: int) -> None:
        # One evaluation of the batch, whatever the number of routes.
        marked = batch.withColumn("__route", route).persist()
        try:
            lost = marked.where(F.col("__route").isNull() | ~F.col("__route").isin(*routes)).limit(1).collect()
            if lost:
                raise ValueError(f"no sink for route {lost[0]['__route']!r}")
            for value, name in routes.items():
                _SINKS[name].send(marked.where(F.col("__route") == value).drop("__route"), batch_id)
        finally:
            marked.unpersist()

    name = f"weir-routed-{uuid.uuid4().hex}"
    register_sink(name, send, setup=lambda: [s.setup() for s in map(_SINKS.get, routes.values()) if s.setup],
                  clean=lambda: [s.clean() for s in map(_SINKS.get, routes.values()) if s.clean])
    return write_to(df, name, checkpoint=checkpoint, trigger=trigger)


def register_source(spark: SparkSession, source_cls) -> str:
    """Register a custom source (a ``pyspark.sql.datasource.DataSource``
    subclass) so ``spark.read(Stream).format(name)`` finds it."""
    spark.dataSource.register(source_cls)
    return source_cls.name()
