"""Connected components of a links table, by alternating large and small stars.

Each step is two aggregates and two joins over the links; no node list, link
list or component is ever gathered in one place. A hot node (the centre of a
large star) is only ever reduced by a partial ``min`` and joined with one row,
so its links stay spread (AQE splits the skewed side of the join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.session import materialize


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _lowest(down)
    moved = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``u, v`` (longs, u <> v) -> ``node, root``: every linked node but the
    roots, with the smallest node it reaches. Runs until the links no longer
    change; each round's links are written to the shared checkpoint folder."""
    links = materialize(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = lambda d: tuple(d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
    before = mark(links)
    while before[0]:
        links = materialize(_small_star(_large_star(links)))
        after = mark(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
