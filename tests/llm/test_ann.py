"""Nearest neighbours: recall against brute force, exact scores, awkward vectors."""

import numpy as np
import pytest

from weir.llm import ann

KIND = "vec_id long, embedding array<float>"


def brute(ids, x, every, k):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            d = np.sqrt(((x - q) ** 2).sum(1))
            out[i] = sorted((float(e), int(j)) for e, j in zip(d, ids) if j != i)[:k]
    return out


def collect(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(got[r.query_id])
    return got


@pytest.mark.parametrize("shard_rows,block_rows", [(4096, 2048), (300, 3)])
def test_recall_and_scores(spark, shard_rows, block_rows):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], np.float64)
    want = brute(ids, x, 100, 10)
    got = collect(ann.nearest(df, shard_rows=shard_rows, block_rows=block_rows))
    assert got.keys() == want.keys()
    hits = total = 0
    at = dict(zip(ids.tolist(), x))
    for q, near in want.items():
        assert len(got[q]) == 10 and got[q] == sorted(got[q])
        assert all(abs(e - np.sqrt(((at[q] - at[j]) ** 2).sum())) < 1e-12 for e, j in got[q])
        hits += len({j for _, j in near} & {j for _, j in got[q]})
        total += 10
    assert hits / total >= 0.9


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND)


def test_copies_ties_and_few_rows(spark):
    hot = [(i, [1.0, 2.0]) for i in range(5000)]
    rows = hot + [(10000 + i, [1.0, 2.0 + i]) for i in range(1, 40)]
    got = collect(ann.nearest(frame(spark, rows), query_every=5000))
    assert got[0] == [(0.0, j) for j in range(1, 11)]
    few = collect(ann.nearest(frame(spark, [(0, [0.0, 1.0]), (1, [3.0, 1.0]), (2, [3.0, 1.0])])))
    assert few == {0: [(3.0, 1), (3.0, 2)]}
    assert ann.nearest(frame(spark, [(0, [1.0])])).count() == 0


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0]), (100, None), (200, [0.0, 0.0]), (300, [1.0, nan]), (400, [inf, 1.0]), (500, [1.0, None]), (600, []),
            (700, [1.0]), (None, [1.0, 1.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [4.0, 5.0])]
    df = frame(spark, rows).selectExpr("*", "1 AS shard", "'x' AS node", "2 AS block", "0 AS query_key", "0 AS score")
    assert collect(ann.nearest(df)) == {0: [(1.0, 1), (5.0, 2)]}
    assert ann.nearest(frame(spark, [])).count() == 0


def test_every_row_is_indexed(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    n = df.count()
    index = ann.build_index(ann._valid(df, "vec_id", "embedding"), n, shard_rows=64)
    assert index.selectExpr("explode(members) AS m").distinct().count() == n
    assert index.where("size(edges) <> %d" % ann.DEGREE).count() == 0


def test_pruning_keeps_diverse_edges():
    x = np.array([[0.0, 0], [1, 0], [1.1, 0], [0, 1], [5, 0.1]])
    norms = (x * x).sum(1)
    out = ann.robust_prune(x, norms, np.array([0]), np.array([[1, 2, 3, 4, -1]]), 3, 1.2)
    assert out[0].tolist() == [1, 3, -1]  # 2 lies behind 1, 4 behind 3


def test_many_vectors_under_one_id_are_spread(spark):
    """Shards are dealt by id and vector: one id with most vectors fills no shard of its own."""
    rng = np.random.default_rng(2)
    rows = [(7 if i % 3 else i, [float(v) for v in rng.standard_normal(6)]) for i in range(1500)]
    vectors = ann._valid(spark.createDataFrame(rows, KIND), "vec_id", "embedding")
    sizes = [r["count"] for r in ann.build_index(vectors, 1500, shard_rows=300).groupBy("shard").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 400 and sum(sizes) == 1500


def test_recall_over_full_shards_with_clusters(spark):
    """Several full shards: wide noise, dense clusters and near copies."""
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((40, 32))
    x = np.concatenate([rng.standard_normal((3000, 32)), centres[rng.integers(0, 40, 4000)] + 0.1 * rng.standard_normal((4000, 32)),
                        centres[0] + 0.001 * rng.standard_normal((1500, 32))]).astype(np.float32)
    ids = rng.permutation(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], KIND)
    want = brute(ids.tolist(), x.astype(np.float64), 100, 10)
    got = collect(ann.nearest(df))
    hits = sum(len({j for _, j in got[q]} & {j for _, j in near}) for q, near in want.items())
    assert got.keys() == want.keys() and hits / (10 * len(want)) >= 0.95
