"""Mixing against brute force: targets, copies, closeness to the targets."""

import math
from collections import Counter, defaultdict

from tests.llm import brute
from tests.llm.helpers import SF, clashing, docs
from weir.llm import mixing


def check(df):
    src = [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]
    want = Counter((i, n, total, round(goal, 6), c * n) for (i, _, _), (n, total, goal, c) in zip(src, brute.mix_copies(src)))
    got = mixing.mix_digest(df).collect()
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got) == want
    return got


def test_documents(spark):
    got = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert all(r.taken <= 3 * r.size for r in got)


def test_taken_words_come_near_the_targets(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    taken, goal = defaultdict(int), {}
    for r in mixing.with_copies(df, carry=["doc_id"]).collect():
        taken[r.source] += r["copies"] * r["size"]
        goal[r.source] = r.target
        assert r["copies"] in (math.floor(r.target / r.source_size), math.ceil(r.target / r.source_size))
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 0.03 * goal[s] + 20000
    assert abs(sum(taken.values()) - sum(goal.values())) < 0.01 * sum(goal.values())


def test_caps_nulls_ties_and_clashes(spark):
    texts = ["a b c"] * 20 + [None, "", "x", "y z"] + ["w " * k for k in range(1, 60)]
    sources = ["big"] * 20 + [None, "void", "tiny", None] + ["big", "Z", "é"] * 19 + ["Z", "Z"]
    df = docs(spark, texts, sources=sources)
    check(clashing(df))
    mixed = mixing.mix(clashing(df))
    assert mixed.columns == clashing(df).columns
    src = [(r.doc_id, r.text, r.source) for r in df.collect()]
    want = Counter()
    for (i, _, _), (*_, c) in zip(src, brute.mix_copies(src)):
        want[i] += c
    got = Counter(r.doc_id for r in mixed.collect())
    assert got == Counter({i: c for i, c in want.items() if c})


def test_repeated_rows_only_nulls_and_empty(spark):
    check(docs(spark, ["a b"] * 6 + ["c"] * 3, ids=[1] * 6 + [None] * 3, sources=["s"] * 9))
    got = mixing.mix_digest(docs(spark, [None, ""], sources=[None, "s"])).collect()
    assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
    assert mixing.mix_digest(docs(spark, [])).count() == 0 and mixing.mix(docs(spark, [])).count() == 0


def test_rows_without_an_id_are_spread_over_slices(spark):
    """Null ids and sizes alike: the text cuts the slice, so no cell holds them all."""
    from pyspark.sql import functions as F

    df = docs(spark, [f"word{i} other" for i in range(2000)], ids=[None] * 2000, sources=["s"] * 2000)
    check(df)
    h = F.md5(F.concat(F.lit("null/"), F.col("text")))
    assert df.groupBy(F.substring(h, 1, mixing.SLICE_DIGITS)).count().agg(F.max("count")).first()[0] < 40


def test_reruns_agree_whatever_the_partitions(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    one = sorted(map(tuple, mixing.mix_digest(df).collect()))
    assert one == sorted(map(tuple, mixing.mix_digest(df.repartition(13)).collect()))


def test_main_path_has_no_python(spark):
    plan = mixing.mix_digest(spark.read.parquet(f"{SF}/documents.parquet"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
