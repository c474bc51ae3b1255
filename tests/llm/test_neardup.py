"""Embedding near-dedup: all pairs by brute force, dense groups, awkward vectors."""

import numpy as np
import pytest

from weir.llm import neardup

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    """vec_id -> (n_links, component_id, kept) for rows (id, vector, label) with distinct ids."""
    fine = [r for r in rows if r[2] is not None and r[1] and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    near = {r[0]: set() for r in rows}
    for i, a in enumerate(fine):
        for b in fine[:i]:
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.float64(a[1]), np.float64(b[1])
                if neardup.exact_cosine(x, y) >= cosine:
                    near[a[0]].add(b[0])
                    near[b[0]].add(a[0])
    low = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        low[i] = min(seen)
    return {i: (len(near[i]), low[i], low[i] == i) for i in near}


def found(df, **options):
    got = neardup.near_duplicates(df, **options).collect()
    assert len({r.vec_id for r in got}) == len(got)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}


def noisy(rng, centre, n, spread):
    x = centre + rng.standard_normal((n, len(centre))) * spread / np.sqrt(len(centre))
    return [[float(np.float32(v)) for v in r] for r in x]


@pytest.mark.parametrize("block", [1024, 40])
def test_equals_all_pairs(spark, block):
    """Groups of copies and near copies around the threshold, and one dense group far
    larger than the window; small blocks take the angle cells and sure pairs."""
    rng = np.random.default_rng(5)
    vecs, labels = [], []
    for g, (n, spread) in enumerate([(400, 0.05), (90, 0.14), (60, 0.18), (5, 0.2), (3, 0.1), (1, 0)] + [(2, 0.17)] * 20):
        c = rng.standard_normal(24)
        c /= np.linalg.norm(c)
        vecs += noisy(rng, c, n, spread)
        labels += [g % 3] * n
    vecs += [vecs[3]] * 40 + [[v * 2 for v in vecs[3]]]
    labels += [labels[3]] * 41
    order = rng.permutation(len(vecs))
    rows = [(int(i), vecs[j], labels[j]) for i, j in enumerate(order)]
    got = found(spark.createDataFrame(rows, KIND), block=block)
    assert got == brute(rows)


def test_the_tables_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert found(df) == brute(rows)


def test_threshold_is_met_exactly(spark):
    """49 / 50 is 0.98; a hair less is not."""
    rows = [(1, [1.0, 0.0, 0.0, 0.0], 0), (2, [49.0, 9.0, 3.0, 3.0], 0), (3, [-48.99, 9.0, 3.0, 3.0], 0), (4, [-7.0, 0.0, 0.0, 0.0], 0)]
    got = found(spark.createDataFrame(rows, KIND.replace("float", "double")))
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (0, 4, True)}


def test_vectors_that_take_no_part(spark):
    one = [1.0, 2.0]
    rows = [(1, one, 1), (2, one, 2), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1),
            (8, [float("nan"), 1.0], 1), (9, [float("inf"), 1.0], 1), (10, [1.0, 2.0, 0.0], 1), (11, [2.0, 4.0], 1),
            (12, [0.0, 0.0], 1), (13, one, None), (14, [-0.0, 3.0], 5), (15, [0.0, 3.0], 5)]
    got = found(spark.createDataFrame(rows, KIND))
    assert got == brute(rows)
    assert got[1][0] == 1 and got[3] == (0, 3, True) and got[15] == (1, 14, False)


def test_large_and_small_magnitudes(spark):
    rows = [(1, [1e200, 2e200], 1), (2, [1e-200, 2e-200], 1), (3, [1e308, 1.0], 1), (4, [5e-324, 0.0], 1)]
    got = found(spark.createDataFrame(rows, KIND.replace("float", "double")))
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (1, 3, True), 4: (1, 3, False)}


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    rows = [(7, [1.0, 0.0], 1)] * 2 + [(None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, KIND)
    for c in ("cid", "n", "low", "vec", "codes", "n_links", "component_id", "root", "kept"):
        df = df.selectExpr("*", f"'x' AS {c}")
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in neardup.near_duplicates(df).collect())
    assert got == [(0, 0, 0, True), (0, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True)]


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], KIND)).collect() == []


def test_passes_grow_with_the_table():
    assert neardup.passes_for(1000) < neardup.passes_for(10**6) < neardup.passes_for(10**9) < 60
