"""Text files as line events (S1, S2, S4, S5, S7) over tables of ``(path, text)``.

The streaming twin -- following growing files on disk -- is
``weir.sources.tail`` (S3, S6); these are the batch operators with the same
offset rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.scalars import utf8_repair


def _prefix_sums():
    """Exclusive prefix sums of an ``array<bigint>`` per row (Arrow batches,
    numpy ``cumsum``). Spark has no array scan; only the small arrays of line
    lengths cross into Python, never the text."""
    import numpy as np
    import pandas as pd

    def sums(lengths):
        out = []
        for arr in lengths:
            a = np.asarray(arr, dtype=np.int64)
            c = np.empty_like(a)
            if len(a):
                c[0] = 0
                np.cumsum(a[:-1], out=c[1:])
            out.append(c)
        return pd.Series(out)

    sums.__annotations__ = {"lengths": pd.Series, "return": pd.Series}
    return F.pandas_udf(sums, T.ArrayType(T.LongType()))


def split_lines(df: DataFrame, path: str = "path", text: str = "text", keep=()) -> DataFrame:
    """One row per line, the newline kept; a last line without a newline is
    a line too. Columns: ``keep``, ``path``, ``line_no`` (0-based), ``offset``
    (byte position of the line in the text), ``nbytes``, ``message``.

    A narrow transformation: lines come from one native ``split`` (look-behind
    on ``\\n``), their byte offsets from a prefix sum over the row's line
    lengths. No shuffle, so the text is never moved between executors.
    """
    pieces = df.select(*keep, F.col(path).alias("path"),
                       F.split(F.col(text), r"(?<=\n)").alias("__lines"))
    lens = F.transform(F.col("__lines"), lambda x: F.octet_length(x).cast("bigint"))
    with_offs = pieces.withColumn("__offs", _prefix_sums()(lens))
    exploded = with_offs.select(*keep, "path", F.posexplode(F.arrays_zip(
        F.col("__lines").alias("message"), F.col("__offs").alias("offset"))).alias("line_no", "__l"))
    return exploded.where(F.col("__l.message") != "").select(
        *keep, "path", F.col("line_no").cast("bigint").alias("line_no"),
        F.col("__l.offset").alias("offset"), F.octet_length("__l.message").cast("bigint").alias("nbytes"),
        F.col("__l.message").alias("message"))


def tail_from_offsets(files: DataFrame, offsets: DataFrame | None = None, starting: str = "earliest",
                      whole_lines: bool = False, path: str = "path", text: str = "text"):
    """Read what was appended since the saved offsets.

    Returns ``(lines, new_offsets)``. A path without a saved offset starts at 0
    (``starting="earliest"``) or at its end (``"latest"``: nothing is read, the
    end becomes its offset). A file now shorter than its offset was truncated
    and is read again from 0. A saved offset inside a line emits the rest of
    that line, starting at that byte (possibly inside a UTF-8 character, which
    is then repaired). With ``whole_lines`` a last line without a newline is held
    back and the new offset stops before it.
    """
    f = files.select(F.col(path).alias("path"), F.col(text).alias("text"))
    size = F.octet_length("text").cast("bigint")
    if offsets is None:
        start = F.lit(0).cast("bigint") if starting == "earliest" else size
        staged = f.withColumn("__start", start)
    else:
        o = offsets.select(F.col("path"), F.col("offset").cast("bigint").alias("__saved"))
        # One small row per file: the planner or AQE broadcasts it by its real size,
        # and the texts are not shuffled then.
        unknown = F.lit(0).cast("bigint") if starting == "earliest" else size
        staged = f.join(o, "path", "left").withColumn(
            "__start", F.when(F.col("__saved").isNull(), unknown)
            .when(size < F.col("__saved"), F.lit(0).cast("bigint"))
            .otherwise(F.col("__saved"))).drop("__saved")
    staged = staged.withColumn("__size", size)
    # The bytes after the start are cut out first, so only they are split.
    raw = F.col("text").cast("binary")
    rest = F.substr(raw, (F.col("__start") + 1).cast("int")).cast("string")
    head = F.substr(raw, F.lit(1), F.col("__start").cast("int")).cast("string")
    before = F.octet_length(head) - F.octet_length(F.replace(head, F.lit("\n"), F.lit("")))
    # A start inside a character leaves bytes that the repair below lengthens: the
    # first line's length is taken from the bytes themselves.
    first = F.octet_length(F.substring_index("__rest", "\n", 1)) + F.col("__rest").contains("\n").cast("int")
    pieces = staged.where(F.col("__start") < F.col("__size")).select(
        "path", "__start", before.cast("bigint").alias("__before"), rest.alias("__rest"))
    pieces = pieces.select("path", "__start", "__before", first.cast("bigint").alias("__first"),
                           F.split(utf8_repair("__rest"), r"(?<=\n)").alias("__lines"))
    lens = F.transform("__lines", lambda x, i: F.when(i == 0, F.col("__first")).otherwise(F.octet_length(x).cast("bigint")))
    pieces = pieces.select("path", "__start", "__before", "__lines", lens.alias("__lens"))
    pieces = pieces.withColumn("__offs", _prefix_sums()(F.col("__lens")))
    lines = pieces.select("path", "__start", "__before", F.posexplode(F.arrays_zip(
        F.col("__lines").alias("message"), F.col("__offs").alias("offset"), F.col("__lens").alias("nbytes"))).alias("__no", "__l"))
    lines = lines.where(F.col("__l.nbytes") > 0)
    if whole_lines:
        lines = lines.where(F.col("__l.message").endswith("\n"))
    out = lines.select(
        "path", (F.col("__before") + F.col("__no")).alias("line_no"), (F.col("__start") + F.col("__l.offset")).alias("offset"),
        F.col("__l.nbytes").alias("nbytes"), F.col("__l.message").alias("message"))
    if whole_lines:
        # End of the last complete line, never before the old start.
        tail = F.octet_length(F.substring_index("text", "\n", -1))
        new_off = staged.select("path", F.greatest(F.col("__size") - tail, F.col("__start")).alias("offset"))
    else:
        new_off = staged.select("path", F.col("__size").alias("offset"))
    return out, new_off


def watch_scope(df: DataFrame, roots, recursive: bool = True, path: str = "path") -> DataFrame:
    """Files under any watched root, each row tagged with its root as
    ``prefix``; ``recursive=False`` keeps direct children only. A file under two
    roots appears once per root, as with two watches; no roots, no rows.

    One scan: a row's list of matching roots is filtered and exploded."""
    roots = list(roots)
    p = F.col(path)
    hits = []
    for root in roots:
        base = root.rstrip("/") + "/"
        cond = p.startswith(base)
        if not recursive:
            cond = cond & ~F.substring(p, len(base) + 1, 1 << 30).contains("/")
        hits.append(F.when(cond, F.lit(root)))
    found = F.filter(F.array(*hits), lambda x: x.isNotNull()) if hits else F.array().cast("array<string>")
    return df.withColumn("prefix", F.explode(found))


def union_sources(*sources) -> DataFrame:
    """Several sources as one stream, each row keeping its prefix.
    ``sources`` are ``(prefix, df)`` pairs or frames that already have ``prefix``."""
    out = None
    for s in sources:
        df = s[1].withColumn("prefix", F.lit(s[0])) if isinstance(s, tuple) else s
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
