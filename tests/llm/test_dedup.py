"""Line and substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.helpers import SF, clashing, docs, rows
from weir.llm import lines, substring
from weir.llm import text as text_helpers

OPS = {"lines": (lines.line_digest, brute.line_dedup, lines.dedup_lines),
       "substring": (substring.substring_digest, brute.substring_dedup, substring.dedup_substrings)}


def expected(op, df):
    got = OPS[op][1]([(r.doc_id, r.text) for r in df.collect()])
    return sorted(((i, n, k, hashlib.sha256((t or "").encode()).hexdigest()) for i, n, k, t in got), key=repr)


@pytest.mark.parametrize("op", OPS)
def test_documents(spark, op):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows(OPS[op][0](df)) == expected(op, df)


def awkward(spark):
    rng = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(70))
    block = "\n".join(f"line {i} of the block" for i in range(7))
    texts = [None, "", " \n\t\n", "\n\n\n", "one", passage, "start " + passage, passage + " end", passage.upper(),
             "a " * 500, "a b " * 300, ("x\n" * 40), block, "head\n" + block + "\ntail", block.replace("\n", "\n\n"),
             block + "\n" + block, " ".join(rng.choice("ab") for _ in range(900)), "é\x0bà " * 60, "w\x1cw " * 30,
             " ".join(f"q{i}" for i in range(30000)), " ".join(f"q{i}" for i in range(20000, 26000))]
    for _ in range(20):
        texts.append("\n".join(rng.choice(["l1", "l2", "l3", "l4 x", ""]) for _ in range(rng.randint(0, 25))))
        a = rng.randint(0, 40)
        texts.append(" ".join(f"p{i}" for i in range(a, a + 28)) + " mid " + passage)
    return docs(spark, texts)


@pytest.mark.parametrize("op", OPS)
def test_awkward_texts_and_clashing_columns(spark, op):
    df = awkward(spark)
    want = expected(op, df)
    assert rows(OPS[op][0](clashing(df))) == want
    out = OPS[op][2](clashing(df))
    assert out.columns == clashing(df).columns
    got = {r.doc_id: r.text for r in out.collect()}
    for i, _, removed, text in OPS[op][1]([(r.doc_id, r.text) for r in df.collect()]):
        assert got[i] == (text if removed else next(r.text for r in [x for x in df.collect() if x.doc_id == i]))


@pytest.mark.parametrize("op", OPS)
def test_repeated_rows_null_ids_empty_table(spark, op):
    t = "\n".join(" ".join(f"w{i}.{j}" for j in range(8)) for i in range(6))
    df = docs(spark, [t, t, t, "other " + t, None, t], ids=[7, 7, None, 7, 9, 8])
    assert rows(OPS[op][0](df)) == expected(op, df)
    assert OPS[op][0](docs(spark, [])).count() == 0
    assert OPS[op][2](docs(spark, [])).count() == 0


def test_small_shards_give_the_same(spark):
    df = awkward(spark)
    assert rows(substring.substring_digest(df, shard_words=50)) == expected("substring", df)


def test_span_hashes():
    words = [b"%d" % (i % 977) for i in range(7000)]
    joined = b" ".join(words)
    spans = [(0, 20), (5, 25), (977, 997), (6980, 7000), (0, 21), (0, 7000)]
    a, b = np.array(spans).T
    got = list(zip(*(h.tolist() for h in substring._span_hashes(joined, *substring._borders(joined), a, b))))
    assert got[0] == got[2] and len(set(got)) == 5
    for (i, j), h in zip(spans, got):
        both = xxhash.xxh3_128_intdigest(b" ".join(words[i:j]))
        assert tuple(x & (1 << 64) - 1 for x in h) == (both >> 64, both & (1 << 64) - 1)


def test_word_hashes_do_not_depend_on_place_or_block(monkeypatch):
    rng = np.random.default_rng(1)
    words = [bytes(rng.choice(list(b"abc\x00\xff"), size=rng.integers(1, 9)).tolist()) for _ in range(3000)] + [b"x" * 500]
    whole = substring.hashes_of(words)
    by = {}
    for w, h in zip(words, whole.tolist()):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)
    monkeypatch.setattr(substring, "BLOCK", 64)
    assert (substring.hashes_of(words) == whole).all() and len(substring.hashes_of([])) == 0


def mirrored(blocks):
    """Two texts of blocks "five fixed words, one of the block's own, left or right", left and
    right in Thue-Morse order in one and its complement in the other: no window repeats,
    but any polynomial of word hashes modulo 2^64 is the same for both."""
    out = []
    for flip in (0, 1):
        out.append(" ".join(f"one two three four five own{i} " + ["left", "right"][(bin(i).count("1") + flip) % 2] for i in range(blocks)))
    return out


def test_pieces_that_cancel_in_a_polynomial(spark):
    df = docs(spark, mirrored(1024))
    assert rows(substring.substring_digest(df)) == expected("substring", df)
    assert [r.n_removed for r in substring.substring_digest(df).collect()] == [0, 0]
    assert {r.text for r in substring.dedup_substrings(df).collect()} == set(mirrored(1024))
    assert rows(substring.substring_digest(df, shard_words=300)) == expected("substring", df)


@pytest.mark.parametrize("op", OPS)
def test_many_copies_of_one_row_share_its_ranges(spark, op):
    """10,000 rows that repeat id and text hold one set of ranges, each range once."""
    block = "\n".join(" ".join(f"line {i} word {j}" for j in range(8)) for i in range(12))
    text = block + "\nmid\n" + block
    few = docs(spark, [text, text, block], ids=[3, 3, 1])
    df = few.union(docs(spark, [text], ids=[3]).join(spark.range(9998).select(F.lit(1)), how="cross").select("doc_id", "text", "lang", "source", "n_chars"))
    module = {"lines": lines, "substring": substring}[op]
    got, name = text_helpers.with_ranges(df, module.repeated_ranges(df), "doc_id", "text")
    sizes = {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.max(F.size(name)).alias("n")).collect()}
    assert 0 < sizes[3] <= len(text.split())
    want = {tuple(r) for r in expected(op, few)}
    assert {tuple(r) for r in OPS[op][0](df).distinct().collect()} == want


def test_equal_windows_have_equal_anchors():
    a = [f"n{i}" for i in range(40)]
    texts = [None, " ".join(["x"] * 11 + a).encode(), b"short", " ".join(a + ["y"] * 5).encode(), " ".join([*a, "z", *a]).encode(), b""]
    sizes, p = substring.texts_pieces(texts)
    assert sizes[0] == sizes[2] == sizes[5] == 0
    ends = np.cumsum(sizes)
    one, two, twice = ({k: v[ends[i] - sizes[i]:ends[i]] for k, v in p.items()} for i in (1, 3, 4))

    def anchor(p, w):
        return next(a for a, s, n in zip(p["a"], p["s"], p["n"]) if s <= w < s + n)
    for w in range(21):
        assert anchor(one, w + 11) == anchor(two, w) == anchor(twice, w) == anchor(twice, w + 41)
    # Together or alone, a text has the same pieces and anchors; each piece's anchor is counted.
    for i, t in enumerate(texts):
        n, q = substring.texts_pieces([t])
        assert n[0] == sizes[i] and all((q[k] == p[k][ends[i] - sizes[i]:ends[i]]).all() for k in q)
    sizes, m = substring.texts_anchors(texts)
    ends = np.cumsum(sizes)
    places = [dict(zip(m["a"][e - n:e].tolist(), m["m"][e - n:e].tolist())) for e, n in zip(ends, sizes)]
    assert set(places[1]) == set(one["a"].tolist()) and set(places[4]) == set(twice["a"].tolist())
    assert places[4][anchor(twice, 3)] == 2 and places[3][anchor(two, 3)] == 1


def test_anchor_larger_than_a_shard(spark):
    # Each text has the same five words, the smallest run of its windows, between others.
    rng = np.random.default_rng(3)
    runs = [f"r{i} s{i} t{i} u{i} v{i}" for i in range(4000)]
    low = min(runs, key=lambda r: substring.window_hashes(substring.hashes_of(r.encode().split()), 5)[0])
    texts = [" ".join([*(f"x{rng.integers(3)}" for _ in range(2)), *(f"l{k % 7}.{i}" for i in range(14)), low,
                       *(f"m{k % 5}.{i}" for i in range(14)), f"name{k}"]) for k in range(60)]
    df = docs(spark, texts, ids=[None, *range(59)])
    assert rows(substring.substring_digest(df, shard_words=500)) == expected("substring", df)
    keyed = substring._keyed(df, "doc_id", "text")
    few = substring.filed_pieces(keyed, 20, 5, 1 << 30)
    filed = substring.filed_pieces(keyed, 20, 5, 500)
    held = {}
    for a, n in {((r.a, r.b, r.c), r.n) for r in few.collect()}:
        held[a[0]] = held.get(a[0], 0) + n + 19
    large = {a for a, n in held.items() if n > 500}
    assert large and large == {r.a for r in substring.large_anchors(few, 20, 500).collect()}
    left = {}
    for r in filed.select("a", "b", "c", "n").distinct().collect():
        left[r.a] = left.get(r.a, 0) + r.n + 19
    assert not large & set(left) and max(left.values()) <= 500
    # Where longer runs are common too, windows are filed by themselves.
    same = docs(spark, [" ".join([*(f"h{i}" for i in range(17)), f"t{k}", *(f"e{i}" for i in range(17))]) for k in range(60)])
    assert rows(substring.substring_digest(same, shard_words=100)) == expected("substring", same)
    filed = substring.filed_pieces(substring._keyed(same, "doc_id", "text"), 20, 5, 100)
    assert filed.where("n > 1").count() < filed.count() and filed.groupBy("a").agg(F.sum("n").alias("n")).where("n > 60").count() == 0


def test_texts_that_repeat_themselves():
    assert not substring._all_differ((1,) * 30, 20)
    assert substring._all_differ(tuple(range(30)), 20)
    assert not substring._all_differ((1, 2) * 12, 20)
    # A word that some windows miss proves nothing.
    assert not substring._all_differ((9,) + (1,) * 24, 20)
