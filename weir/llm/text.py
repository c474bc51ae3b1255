"""Small helpers shared by the text operators.

A *word* of these operators is a run of bytes other than the six ASCII blanks
(``[^\\x20\\x09-\\x0D]+``); ``bytes.split()`` cuts exactly there, and no byte of
a multi-byte UTF-8 character is such a blank.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from weir.session import checkpoint_dir, configure

WORD = r"[^\x20\x09-\x0D]+"


#: Rows handed to Python at a time: whole texts, so that two tasks' batches of long
#: documents stay a small part of an executor's memory.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings of the queries and stages."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage with a table in the cluster's shared checkpoint folder (columnar
    and compressed, for frames too large for a plain checkpoint)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words of a text as long (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """Second half of a row key: rows that share a doc_id but not the text stay apart."""
    return F.xxhash64(text)


def words_of(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


_MUL = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes (empty if there are fewer)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for i in range(k):
        acc = (acc ^ h[i:i + n]) * _MUL
        acc ^= acc >> np.uint64(29)
    return mix(acc)


def text_udf(ddl: str, per_batch: Callable[[list], list[tuple]]):
    """Arrow UDF over one binary text column: ``per_batch`` takes the texts of a
    batch (bytes or None) and returns one tuple of ``ddl`` fields per text."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    kind = pa.struct(list(schema))
    names = [f.name for f in schema]

    def run(texts: pa.Array) -> pa.Array:
        rows = per_batch(texts.to_pylist())
        return pa.array([dict(zip(names, r)) for r in rows], type=kind)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, StructType.fromDDL(ddl))


def list_udf(ddl: str, per_text: Callable[[bytes | None], dict[str, np.ndarray]]):
    """Arrow UDF from a binary text to an array of structs: ``per_text`` gives each
    field's values as one numpy array, which reach Arrow without Python objects."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    names = [f.name for f in schema]

    def run(texts: pa.Array) -> pa.Array:
        rows = [per_text(t) for t in texts.to_pylist()]
        ends = np.cumsum([0, *(len(r[names[0]]) for r in rows)]).astype(np.int32)
        fields = [pa.array(np.concatenate([r[f.name] for r in rows]) if rows else [], type=f.type) for f in schema]
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, fields=list(schema)))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ArrayType(StructType.fromDDL(ddl)))


def batch_udf(ddl: str, per_batch: Callable[..., list[tuple]]):
    """As ``text_udf``, over two columns: ``per_batch(firsts, seconds)``."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    kind = pa.struct(list(schema))
    names = [f.name for f in schema]

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([dict(zip(names, r)) for r in per_batch(a.to_pylist(), b.to_pylist())], type=kind)

    run.__annotations__ = {"a": pa.Array, "b": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, StructType.fromDDL(ddl))


def with_ranges(df: DataFrame, ranges: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """``df`` plus a column of its rows' ranges, whose name is returned. ``ranges``:
    ``doc_id, text_key, i, j``, gathered per document: each range once, however many rows
    repeat the document, so the group is bounded by its text."""
    name = fresh("__ranges", df.columns)
    keys = [fresh("__id_key", df.columns), fresh("__text_key", df.columns)]
    found = ranges.groupBy(F.xxhash64("doc_id").alias(keys[0]), F.col("text_key").alias(keys[1])).agg(
        F.collect_set(F.struct("i", "j")).alias(name))
    rows = df.withColumns({keys[0]: F.xxhash64(F.col(f"`{id_col}`")), keys[1]: text_key(F.col(f"`{text_col}`"))})
    return rows.join(found, keys, "left").drop(*keys), name


def outside(n: int, ranges: list[dict] | None) -> np.ndarray:
    """Which of ``n`` positions no range ``[i, j)`` covers."""
    edge = np.zeros(n + 1, np.int64)
    for r in ranges or ():
        edge[r["i"]] += 1
        edge[r["j"]] -= 1
    return np.cumsum(edge[:n]) == 0


def fresh(name: str, taken: list[str]) -> str:
    """A column name that ``taken`` does not hold (compared as Spark does, without case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def on_text(df: DataFrame, udf, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns plus the fields of ``udf(text)``."""
    r = fresh("__r", keep)
    kept = [F.col(f"`{c}`") for c in keep]
    out = df.select(*kept, udf(F.col(f"`{text_col}`").cast("binary")).alias(r))
    return out.select(*kept, f"{r}.*")
