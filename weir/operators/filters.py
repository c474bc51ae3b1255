"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.glob import glob_match
from weir.operators.joins import prefix_anti_join
from weir.operators.paths import normalize_path
from weir.operators.patterns import matching_values


def exclude_paths(df: DataFrame, patterns, col: str = "path") -> DataFrame:
    """drop rows whose ``col`` matches any glob (``fnmatch`` flags 0).

    ``patterns`` is a list of globs (one anchored regex, a single ``rlike``) or a
    DataFrame with a ``pattern`` column (F2): a pattern index is walked once by each
    distinct value of ``col``, and the rows are removed by an equi anti join.
    """
    if not isinstance(patterns, DataFrame):
        return df.where(~glob_match(col, list(patterns)))
    return df.join(matching_values(df, col, patterns, whole=True), col, "left_anti")


def exclude_prefixes(df: DataFrame, prefixes, col: str = "path") -> DataFrame:
    """drop rows whose normalised ``col`` starts with any normalised prefix
    (plain string prefix, so ``/var/log2`` is under ``/var/log``). ``prefixes`` is
    a list or a DataFrame with a ``prefix`` column; rows keep their spelling."""
    staged = df.withColumn("__norm", normalize_path(col))
    if isinstance(prefixes, DataFrame):
        table = prefixes.select(normalize_path(F.col("prefix").cast("string")).alias("prefix"))
        return prefix_anti_join(staged, "__norm", table).select(*df.columns)
    return staged.where(~_under(prefixes)).select(*df.columns)


def _under(prefixes) -> Column:
    """Does ``__norm`` start with one of the listed prefixes, normalised?"""
    cond = F.lit(False)
    for p in prefixes:
        if p is not None:
            cond = cond | F.coalesce(F.col("__norm").startswith(normalize_path(F.lit(p))), F.lit(False))
    return cond


def apply_sleep(df: DataFrame, sleep_dirs, active, col: str = "prefix") -> DataFrame:
    """while sleeping, events of watched directories under a ``sleep`` entry
    are dropped (both normalised). ``active`` is a bool or a per-row boolean Column
    (a flag joined from a control table)."""
    if isinstance(active, bool):
        return exclude_prefixes(df, sleep_dirs, col) if active else df
    staged = df.withColumn("__norm", normalize_path(col)).withColumn("__active", F.coalesce(active, F.lit(False)))
    return staged.where(~(F.col("__active") & _under(sleep_dirs))).select(*df.columns)


def between_markers(df: DataFrame, is_start: Column, is_stop: Column, partition_by,
                    order_by=("ts", "seq")) -> DataFrame:
    """per partition, the rows strictly after the first start marker and
    strictly before the first stop marker; marker rows are never kept. Rows with null
    partition columns are a partition like any other.

    Skew-safe: the first-marker positions are a partial aggregate (one row per
    partition), joined back by a plain join (AQE broadcasts the summary or splits
    a hot partition by its real size) instead of a window over a whole partition.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    pos = F.struct(*[F.col(c) for c in order_by])
    marked = df.withColumn("__start", is_start).withColumn("__stop", is_stop).withColumn("__pos", pos)
    summary = marked.groupBy(*parts).agg(
        F.min(F.when(F.col("__start"), F.col("__pos"))).alias("__first_start"),
        F.min(F.when(F.col("__stop"), F.col("__pos"))).alias("__first_stop"),
    ).where(F.col("__first_start").isNotNull())
    summary = summary.withColumnsRenamed({c: f"__in{i}" for i, c in enumerate(parts)})
    same = F.lit(True)
    for i, c in enumerate(parts):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"__in{i}"))
    kept = marked.join(summary, same, "inner").where(
        (F.col("__pos") > F.col("__first_start"))
        & (F.col("__first_stop").isNull() | (F.col("__pos") < F.col("__first_stop")))
        & ~F.coalesce(F.col("__start"), F.lit(False))
        & ~F.coalesce(F.col("__stop"), F.lit(False))
    )
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
