"""SimHash near-dedup against a brute-force version."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm.helpers import SF, clashing, docs, rows
from weir.llm import simhash
from weir.llm.components import components


def brute_fp(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits=4):
    """Smallest id reachable, by (id, fingerprint) pairs."""
    parent = {i: i for i, _ in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, (i, f) in enumerate(fps):
        for j, g in fps[:a]:
            if bin(f ^ g).count("1") <= bits:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i, _ in fps}


def check(spark, df):
    src = [(r.doc_id, r.text) for r in df.collect()]
    fps = [(i, brute_fp(t)) for i, t in src]
    want = brute_components(fps)
    got = simhash.simhash_digest(df).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (i, f"{f:016x}", want[i]) for i, f in fps)


def test_documents_against_brute_force(spark):
    check(spark, spark.read.parquet(f"{SF}/documents.parquet"))


def test_awkward_texts(spark):
    base = "one two three four five six seven eight nine ten " * 30
    texts = [None, "", " \t\n", "one", "One two", "one two", base, base + "eleven", base.upper(), "ÀB É", "x " * 20000,
             "a\x0bb\x1cc d", "a b\x1cc d"]
    df = docs(spark, texts)
    check(spark, df)
    check(spark, clashing(df))


def test_repeated_rows_null_ids_and_empty(spark):
    df = docs(spark, ["a b c d e f", "a b c d e f", "other words here now", None], ids=[5, 5, None, None])
    got = rows(simhash.simhash_digest(df))
    assert len(got) == 4
    assert [g[2] for g in got if g[0] == 5] == [5, 5]
    kept = rows(simhash.keep_one_per_group(clashing(df)).select("doc_id", "text"))
    assert kept == sorted([(5, "a b c d e f"), (None, "other words here now"), (None, None)], key=repr)
    assert simhash.simhash_digest(docs(spark, [])).count() == 0
    assert simhash.keep_one_per_group(docs(spark, [])).count() == 0


def test_trie_pairs_equal_all_pairs():
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    near = []
    for s in seeds:
        for _ in range(40):
            f = int(s)
            for b in rng.choice(64, rng.integers(0, 5), replace=False):
                f ^= 1 << int(b)
            near.append(f)
    v = np.unique(np.array(near, np.uint64))
    got = set()
    for i, j in simhash.trie_pairs(v, np.array([0]), np.array([len(v)]), 0, 4):
        got |= set(zip(i.tolist(), j.tolist()))
    x = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    want = {(i, j) for i, j in np.argwhere(x).tolist() if i < j}
    assert got == want


def test_links_keep_components(spark):
    rng = random.Random(5)
    fps = []
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.append(f)
        for _ in range(rng.randint(0, 12)):  # chains of neighbours
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
            fps.append(f)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in components(simhash.simhash_links(df)).collect()}
    got = {}
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        got.setdefault(roots.get(s, s), set()).add(f)
    want = {}
    for f, root in brute_components([(f, f) for f in fps]).items():
        want.setdefault(root, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chain_and_hot_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(500)]
    df = spark.createDataFrame(chain + star, "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1001 + i: 1000 for i in range(500)}}
    assert components(df.where("u < 0")).count() == 0


def test_pushes_no_text_through_the_join(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    links = simhash.simhash_links(df.select(F.xxhash64("text").alias("fp")))
    assert links.columns == ["u", "v"]
