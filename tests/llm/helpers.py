"""Frames with the awkward cases every text operator must take."""

from pyspark.sql import Row
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

SF = "/root/testdata/sf0.001"


def docs(spark, texts, ids=None, sources=None):
    ids = ids if ids is not None else range(len(texts))
    sources = sources if sources is not None else ["s%d" % (i % 3) for i in range(len(texts))]
    return spark.createDataFrame([(i, t, None, s, None) for i, t, s in zip(ids, texts, sources)], DOCS)


def clashing(df):
    """The same rows with columns named like those the operators use inside."""
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(None).cast("string") for c in (
        "size", "target", "copies", "row", "rank", "fp", "h", "u", "v", "n", "pos", "hash", "text_key", "__r", "k",
        "root", "component_id", "tokens_", "lines", "keep", "class", "slice", "n_words")})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


__all__ = ["DOCS", "SF", "Row", "clashing", "docs", "rows"]
