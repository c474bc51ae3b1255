"""Enrichment by lookups (J1-J5) and topic routing (K2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.operators.joins import asof_join, lookup_join
from weir.schema import DEFAULT_TOPIC


def with_user(df: DataFrame, users: DataFrame) -> DataFrame:
    """``user`` = name of ``uid`` in ``users(uid, name)``, '' when unknown."""
    dim = users.select(F.col("uid").cast("int").alias("uid"), F.col("name").alias("__user"))
    return lookup_join(df, dim, "uid") \
        .withColumn("user", F.coalesce(F.col("__user"), F.lit(""))).drop("__user")


def with_group(df: DataFrame, groups: DataFrame) -> DataFrame:
    """``group`` = name of ``gid`` in ``groups(gid, name)``, '' when unknown."""
    dim = groups.select(F.col("gid").cast("int").alias("gid"), F.col("name").alias("__group"))
    return lookup_join(df, dim, "gid") \
        .withColumn("group", F.coalesce(F.col("__group"), F.lit(""))).drop("__group")


def with_command(df: DataFrame, procs: DataFrame) -> DataFrame:
    """``cmdline`` = command line of ``pid`` in ``procs(pid, cmdline)``
    (NUL-separated), '' when unknown. The encoders turn it into the base64
    ``command`` key (NULs become spaces)."""
    dim = procs.select(F.col("pid").cast("int").alias("pid"), F.col("cmdline").alias("__cmd"))
    return lookup_join(df, dim, "pid") \
        .withColumn("cmdline", F.coalesce(F.col("__cmd"), F.lit(""))).drop("__cmd")


def with_static(df: DataFrame, fields=None, tags=None) -> DataFrame:
    """The configured ``fields`` (dict or flat ``[k, v, ...]`` list) and
    ``tags`` on every event, as literals (constant-folded once)."""
    if isinstance(fields, (list, tuple)):
        fields = dict(zip(fields[0::2], fields[1::2]))
    fields = fields or {}
    fmap = (F.create_map(*[x for k, v in fields.items() for x in (F.lit(str(k)), F.lit(str(v)))])
            if fields else F.create_map().cast("map<string,string>"))
    tarr = F.array(*[F.lit(str(t)) for t in (tags or [])]).cast("array<string>")
    return df.withColumn("fields", fmap).withColumn("tags", tarr)


def with_config(df: DataFrame, config_versions: DataFrame, ts: str = "ts",
                effective_col: str = "effective_from", seq: str | None = None) -> DataFrame:
    """Columns of the configuration version in force at each event's time
    (as-of join on ``effective_from <= ts``; of versions with the same time the
    one with the largest ``seq``); nulls before the first version and for events
    without a time."""
    return asof_join(df, config_versions, ts, effective_col, seq=seq)


def route_topic(df: DataFrame, topic: Column | str | None = None, default: str = DEFAULT_TOPIC) -> DataFrame:
    """K2: ``topic`` = configured topic (a column from the config join, or a
    name), ``logs`` when none."""
    if topic is None:
        t = F.col("topic") if "topic" in df.columns else F.lit(None).cast("string")
    elif isinstance(topic, str):
        t = F.col(topic) if topic in df.columns else F.lit(topic)
    else:
        t = topic
    return df.withColumn("topic", F.coalesce(t, F.lit(default)))


def enrich(df: DataFrame, users: DataFrame | None = None, groups: DataFrame | None = None,
           procs: DataFrame | None = None, fields=None, tags=None) -> DataFrame:
    """J1-J4 in one call."""
    if users is not None:
        df = with_user(df, users)
    if groups is not None:
        df = with_group(df, groups)
    if procs is not None:
        df = with_command(df, procs)
    return with_static(df, fields, tags)
