"""Operator 3, line dedup: overlapping windows of three lines.

Every run of three consecutive lines that hold a word (blank lines in between
are skipped) is hashed to 128 bits; hashes found twice or more are repeated
windows. The first occurrence (smallest doc_id, then line) stays, every later one
covers its lines, blank ones in between included, and the covered positions of a
document are merged and removed. Windows are judged on the input.

Shuffled are the windows (40 bytes each), once for the partial aggregate that
finds first occurrences and once for the join back, and the texts once, for the
removal. A hot window is one aggregated row joined with many: AQE splits the many.

Defined cases: null text stays null and counts as no line; texts with fewer than
three lines that hold a word keep everything; a document left without lines
becomes the empty text; rows that repeat both doc_id and text are one document
and treated alike; a null doc_id comes before all others; an empty table gives no
rows; extra columns are kept by ``dedup_lines`` under any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.text import batch_udf, fresh, on_text, outside, text_key, text_udf, with_ranges
from weir.session import materialize

WINDOW = 3


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def line_windows(text: bytes | None, k: int = WINDOW) -> list[dict]:
    """The windows of a text: 128-bit hash (a, b) and the lines [i, j) it covers."""
    at = [(i, line) for i, line in enumerate((text or b"").split(b"\n")) if line.split()]
    out = []
    for p in range(len(at) - k + 1):
        run = at[p:p + k]
        h = xxhash.xxh3_128_intdigest(b"\n".join(line for _, line in run))
        out.append({"a": _signed(h >> 64), "b": _signed(h & (1 << 64) - 1), "i": run[0][0], "j": run[-1][0] + 1})
    return out


def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW) -> DataFrame:
    """``doc_id, text_key, i, j``: lines covered by a window that also occurs earlier."""
    q = lambda c: F.col(f"`{c}`")
    docs = df.select(q(id_col).alias("doc_id"), text_key(q(text_col)).alias("text_key"), q(text_col).alias("text"))
    udf = text_udf("w array<struct<a: long, b: long, i: int, j: int>>", lambda texts: [(line_windows(t, k),) for t in texts])
    windows = on_text(docs, udf, ["doc_id", "text_key"]).select("doc_id", "text_key", F.inline("w"))
    windows = materialize(windows)  # read by the aggregate and the join
    place = F.struct("doc_id", "text_key", "i")
    firsts = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = windows.join(firsts.select("a", "b", "first"), ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    return later.select("doc_id", "text_key", "i", "j")


def _kept(text: bytes | None, ranges) -> tuple[int, int, bytes | None]:
    if text is None:
        return 0, 0, None
    lines = text.split(b"\n")
    keep = outside(len(lines), ranges)
    removed = int(len(lines) - keep.sum())
    return len(lines), removed, text if not removed else b"\n".join([lines[i] for i in np.flatnonzero(keep)])


def _text_batch(texts, ranges):
    kept = (_kept(*x) for x in zip(texts, ranges))
    return [(t[2] if t[2] is None else t[2].decode("utf-8", "replace"), t[1]) for t in kept]


def _digest_batch(texts, ranges):
    kept = (_kept(*x) for x in zip(texts, ranges))
    return [(n, r, hashlib.sha256(t or b"").hexdigest()) for n, r, t in kept]


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WINDOW) -> DataFrame:
    """``df`` with the repeated windows' lines removed from ``text_col``."""
    rows, ranges = with_ranges(df, repeated_ranges(df, id_col, text_col, k), id_col, text_col)
    new = fresh("__new", rows.columns)
    udf = batch_udf("t string, removed int", _text_batch)
    rows = rows.withColumn(new, udf(F.col(f"`{text_col}`").cast("binary"), F.col(ranges)))
    return rows.select(*[F.col(f"{new}.t").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])


def line_digest(df: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` (of the kept text; null text as empty)."""
    rows, ranges = with_ranges(df.select("doc_id", "text"), repeated_ranges(df), "doc_id", "text")
    udf = batch_udf("n_lines long, n_removed long, kept_sha256 string", _digest_batch)
    return rows.select("doc_id", udf(F.col("text").cast("binary"), F.col(ranges)).alias("r")).select("doc_id", "r.*")
