"""Operator 4, mixing sources to target weights: systematic sampling
(DataFrame functions only).

A source's target is its weight's share of all words; no target exceeds
``max_repeat`` times its source, and what is cut off is reshared by weight among
the others until none is above (closed form: one scan over the sources by
capacity per weight). A document's expected copies are its source's target over
its source's size. Copies are summed up along the source, one random offset per
source is added, and a copy is emitted for each integer boundary crossed, so a
document gets the floor or the ceiling of its expected copies.

The running sum never puts a source into one task: documents are ordered by
(size class, slice, size, hash of id and text), counted per (source, class, slice), and only
these counts -- a few hundred classes times ``SLICES`` per source, whatever the
number of rows -- are summed up along the source. The slice is a hash of id and text,
so rows without an id, or with one id, are spread like any others. Ordering by size class spreads
the copies over short and long documents alike, which keeps the words taken
close to the target.

Defined cases: a null text has size 0; a null source is a source of its own,
last in order; sources without words get target 0 and no copies; repeated rows
and ties are separate documents, ordered by a hash of the whole row last; an
empty table gives no rows; extra columns are kept by ``mix`` under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.text import word_count
from weir.session import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
#: Hash slices of a size class: 256, two hex digits.
SLICE_DIGITS = 2


def size_class(size: Column) -> Column:
    """Number of digits and the first two of them: at most 90 classes a decade, in order of size."""
    s = size.cast("string")
    return (F.length(s) * 100 + F.substring(F.concat(s, F.lit("0")), 1, 2).cast("int")).cast("int")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size`` -> plus ``target`` (double). One row per source in and out;
    the windows below see sources, never documents."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    cases = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("w", cases).withColumn("cap", F.col("source_size").cast("double") * max_repeat)
    fill = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("left", F.sum(F.col("source_size").cast("double")).over(every)
                     - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    t = t.withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    # Share per weight if all sources before this one are cut off at their cap.
    t = t.withColumn("share", F.col("left") / F.col("left_w"))
    t = t.withColumn("fits", F.col("cap") >= F.col("share") * F.col("w"))
    share = F.max(F.when(F.col("fits"), F.struct(-F.row_number().over(fill), F.col("share")))).over(every)["share"]
    return t.withColumn("final", share).select(
        "source", "source_size",
        F.when(F.col("fits"), F.col("final") * F.col("w")).otherwise(F.col("cap")).alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """Random offset in [0, 1) of a source: 20 bits of a SHA-256."""
    named = F.concat(F.lit(seed), F.when(source.isNull(), F.lit("/null")).otherwise(F.concat(F.lit("/s:"), source)))
    return F.conv(F.substring(F.sha2(named, 256), 1, 5), 16, 10).cast("double") / 1048576


def with_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                carry: list[str] | None = None, weights: tuple[int, ...] = WEIGHTS,
                max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """``row`` (struct of the columns ``carry``, all by default) plus
    ``source, size, source_size, target, copies``. Only ``carry`` is shuffled."""
    q = lambda c: F.col(f"`{c}`")
    hashed = [q(c) for c, kind in df.dtypes if not kind.startswith("map")]
    d = df.select(F.struct(*[q(c) for c in carry or df.columns]).alias("row"), q(source_col).alias("source"),
                  word_count(q(text_col)).alias("size"), F.xxhash64(*hashed).alias("tie"),
                  F.md5(F.concat(F.coalesce(q(id_col).cast("string"), F.lit("null")), F.lit("/"), F.coalesce(q(text_col), F.lit("")))).alias("h"))
    d = d.select("row", "tie", "source", "size", size_class(F.col("size")).alias("class"),
                 F.substring("h", 1, SLICE_DIGITS).alias("slice"), F.substring("h", 1 + SLICE_DIGITS, 14).alias("h"))
    keys = ["source", "class", "slice"]
    # Read by the sources' sizes and by the running sums: a small table, kept rather than counted twice.
    cells = materialize(d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")))
    sizes = cells.groupBy("source").agg(F.sum("words").alias("source_size"))
    along = Window.partitionBy("source").orderBy("class", "slice").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
    targets = source_targets(sizes, weights, max_repeat)
    c, t = cells.alias("c"), targets.alias("t")
    cells = c.join(t, F.col("c.source").eqNullSafe(F.col("t.source"))).select(
        F.col("c.source").alias("c_source"), F.col("class").alias("c_class"), F.col("slice").alias("c_slice"),
        "before", "source_size", "target")
    inside = Window.partitionBy(*keys).orderBy("size", "h", "tie")
    d = d.withColumn("rank", F.row_number().over(inside))
    d = d.join(cells, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("class") == F.col("c_class"))
               & (F.col("slice") == F.col("c_slice")))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = each * (F.col("before") + F.col("rank")) + offset(F.col("source"), seed)
    prior = each * (F.col("before") + F.col("rank") - 1) + offset(F.col("source"), seed)
    return d.select("row", "source", "size", "source_size", "target",
                    (F.floor(upto) - F.floor(prior)).cast("long").alias("copies"))


def mix(df: DataFrame, **options) -> DataFrame:
    """The mixed rows: every column of ``df``, each row as often as its copies."""
    d = with_copies(df, **options).where(F.col("copies") > 0)
    return d.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def mix_digest(df: DataFrame) -> DataFrame:
    d = with_copies(df, carry=["doc_id"])
    return d.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"))
