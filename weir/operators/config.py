"""Configuration merges and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.operators.joins import prefix_matches
from weir.operators.paths import normalize_path


def merge_config(entries: DataFrame, order=("file", "line_no", "idx")) -> DataFrame:
    """G1: the merged values of a key as rows ``(key, pos, value)``: all its values
    from all files, numbered from 0 in ``order`` (file order, line, position in the
    line).

    Numbering is two-level: ``row_number`` inside ``(key, file)``, plus the number of
    values in the files before, from one count per ``(key, file)``; a key with
    millions of values is spread over its files."""
    first, rest = order[0], list(order[1:])
    inside = Window.partitionBy("key", first).orderBy(*rest)
    numbered = entries.withColumn("__rn", F.row_number().over(inside))
    along = Window.partitionBy("__key").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    before = entries.groupBy(F.col("key").alias("__key"), F.col(first).alias("__file")).agg(F.count(F.lit(1)).alias("__n")) \
        .withColumn("__before", F.coalesce(F.sum("__n").over(along), F.lit(0)))
    return numbered.join(before, F.col("key").eqNullSafe(F.col("__key")) & F.col(first).eqNullSafe(F.col("__file"))) \
        .select("key", (F.col("__before") + F.col("__rn") - 1).cast("bigint").alias("pos"), "value")


def unique_paths(df: DataFrame, path: str = "dir", order: str = "ord", cwd: str = "/") -> DataFrame:
    """Directories without duplicates by normalised path; the first spelling
    (lowest ``order``) wins and keeps its position. ``min_by`` combines map-side,
    so one directory spelled a billion times is still a small shuffle."""
    norm = normalize_path(path, cwd)
    return (df.withColumn("__norm", norm)
            .groupBy("__norm")
            .agg(F.min_by(F.struct(F.col(path).alias("p"), F.col(order).alias("o")), F.col(order)).alias("__w"))
            .select(F.col("__w.p").alias(path), F.col("__w.o").alias(order), F.col("__norm").alias("normalized")))


def merge_servers(known, incoming) -> tuple[Column, Column]:
    """Add-once merge of a comma-separated server list into a known list.

    Returns ``(merged, any_new)``: ``merged`` = known followed by the new servers
    (each once, first-seen order); ``any_new`` is true when at least one was not
    known (an empty item counts as a server), false for a null list.
    """
    k = F.col(known) if isinstance(known, str) else known
    inc = F.col(incoming) if isinstance(incoming, str) else incoming
    items = F.split(inc, ",")
    merged = F.when(inc.isNull(), k).otherwise(F.array_distinct(F.concat(F.coalesce(k, F.array().cast("array<string>")), items)))
    any_new = F.when(inc.isNull(), F.lit(False)).otherwise(
        F.size(F.array_except(items, F.coalesce(k, F.array().cast("array<string>")))) > 0)
    return merged, any_new


def watch_diff(configured: DataFrame, watched: DataFrame, col: str = "dir"):
    """After a reload, ``to_start`` = configured directories not under any
    watched one (string prefix), ``to_stop`` = watched directories no longer
    configured; both lists are compared normalised and returned normalised, each
    directory once. An equi join on leading parts and an equi anti join."""
    want = configured.select(normalize_path(col).alias(col)).where(F.col(col).isNotNull()).distinct()
    have = watched.select(normalize_path(col).alias(col)).where(F.col(col).isNotNull()).distinct()
    to_start = want.join(prefix_matches(want, col, have.select(F.col(col).alias("prefix"))), col, "left_anti")
    return to_start, have.join(want, col, "left_anti")
