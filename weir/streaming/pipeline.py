"""The capture pipeline as one Structured Streaming query.

``capture_stream``: new lines of watched files -> captured writes -> exclusion
globs -> per-path quota (state store) -> user/group/command lookups
(stream-static joins) -> static fields and tags -> wire records (``value``,
``topic``). Start it with ``sinks.write_bus`` (or any sink) and a checkpoint:
the tail offsets and the quota state live there, so a restart resumes exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import codec, enrich, filters
from weir.schema import DEFAULT_ENCODER
from weir.sinks import write_to
from weir.sources.tail import tail_stream
from weir.sources.writes import write_events
from weir.streaming.event_time import live_config
from weir.streaming.quota_state import rate_limit_stream


def capture_stream(spark: SparkSession, paths, excludes=(), quota: float | None = None,
                   users: DataFrame | None = None, groups: DataFrame | None = None,
                   procs: DataFrame | None = None, fields=None, tags=None, topic: str | None = None,
                   encoder: str = "logstash_base64", starting: str = "latest",
                   whole_lines: bool = False, with_rejects: bool = False, recursive: bool = True,
                   source_options: dict | None = None) -> DataFrame:
    """Wire records (``path, seq, topic, value``); ``with_rejects`` gives every row
    with ``encoder`` and ``reason`` (null: to be sent), so that a sink can route dead
    letters. An encoder name that is not supported raises. ``source_options`` are options of
    the tail source (``maxBytesPerTrigger``, ``splitBytes``, ``progressPath``, ``rootsTable``, ...)."""
    if not (encoder.startswith("logstash") or encoder == "text"):
        raise ValueError(f"unsupported encoder: {encoder}")
    writes = tailed_writes(spark, paths, starting, whole_lines, recursive, source_options)
    if excludes:
        writes = filters.exclude_paths(writes, list(excludes))
    if quota is not None:
        writes = rate_limit_stream(writes, quota).drop("overflow")
    if users is not None:
        writes = enrich.with_user(writes, users)
    if groups is not None:
        writes = enrich.with_group(writes, groups)
    if procs is not None:
        writes = enrich.with_command(writes, procs)
    writes = enrich.with_static(writes, fields, tags)
    if topic is not None:
        writes = enrich.route_topic(writes, topic)
    marked = codec.encode_marked(writes, encoder, keep=("path", "seq"))
    if with_rejects:
        return marked
    return marked.where(F.col("reason").isNull()).drop("encoder", "reason")


def tailed_writes(spark: SparkSession, paths, starting: str = "latest", whole_lines: bool = False,
                  recursive: bool = True, source_options: dict | None = None) -> DataFrame:
    """New lines of watched files as captured writes. The tail source has no caller: pid, uid
    and gid are 0, and the file path is absolute under the prefix '/', as with a kernel watch."""
    lines = tail_stream(spark, paths, starting=starting, whole_lines=whole_lines, recursive=recursive, **(source_options or {}))
    return write_events(lines, seq=F.col("offset"), ts=F.col("ts"), prefix=F.lit("/"),
                        path=F.col("path"), buf=F.col("message"))


def capture_live(writes: DataFrame, versions: DataFrame, users: DataFrame | None = None, groups: DataFrame | None = None,
                 procs: DataFrame | None = None, **options) -> DataFrame:
    """Live reload in event time: captured writes (``tailed_writes`` or any stream of them) under
    the configuration of a stream of versions. A version's ``excludes``, ``sleep_dirs`` with
    ``active``, ``quota`` and ``ready`` act at the gate (``event_time.live_config``, which takes
    ``options``), its ``fields`` (map), ``tags`` (array), ``topic`` and ``encoder`` on the events of its
    time. Gives ``path, seq, topic, value, encoder, reason, replayed, sent_at, place, late``;
    late rows have no version and the defaults."""
    rows = live_config(writes, versions, **options)
    # A version's fields and tags stand where it has them.
    kept = {c: f"__{c}" for c in ("fields", "tags") if c in rows.columns}
    rows = enrich.enrich(rows.withColumnsRenamed(kept), users, groups, procs)
    rows = rows.withColumns({c: F.coalesce(F.col(k), F.col(c)) for c, k in kept.items()}).drop(*kept.values())
    rows = enrich.route_topic(rows, F.col("topic") if "topic" in rows.columns else F.lit(None).cast("string"))
    encoder = F.coalesce(F.col("encoder"), F.lit(DEFAULT_ENCODER)) if "encoder" in rows.columns else F.lit(DEFAULT_ENCODER)
    return codec.encode_marked(rows, encoder, keep=("path", "seq", "replayed", "sent_at", "place", "late"))


def start_capture(spark: SparkSession, paths, sink: str, config: Callable[[], dict], checkpoint: str,
                  starting: str = "latest", whole_lines: bool = False, trigger: dict | None = None,
                  recursive: bool = True, source_options: dict | None = None):
    """J5 live: a capture stream whose configuration is read again before each
    micro-batch. ``config()`` returns the settings in force (``excludes, fields,
    tags, topic, encoder``; missing ones have their defaults); when they differ from
    the last ones the sink's ``update(settings)`` is called first. The sink is sent the
    rows of ``encode_marked``, rejects included. A micro-batch has one configuration;
    ``capture_live`` goes by each event's own time."""
    writes = tailed_writes(spark, paths, starting, whole_lines, recursive, source_options)

    def encode_batch(batch: DataFrame, settings: dict) -> DataFrame:
        excludes = settings.get("excludes") or ()
        kept = filters.exclude_paths(batch, list(excludes)) if excludes else batch
        kept = enrich.with_static(kept, settings.get("fields"), settings.get("tags"))
        kept = enrich.route_topic(kept, settings.get("topic"))
        # A per-row encoder: an unknown name rejects rows instead of ending the stream.
        return codec.encode_marked(kept, F.lit(settings.get("encoder") or DEFAULT_ENCODER), keep=("path", "seq"))

    return write_to(writes, sink, checkpoint=checkpoint, trigger=trigger, config=config, prepare=encode_batch)
