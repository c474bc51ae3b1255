"""Quality rules: base counts and n-gram slots against plain Python, held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.helpers import SF, clashing, docs, rows
from weir.llm import quality
from weir.llm.text import word_hashes, words_of

MASK = (1 << 64) - 1


def awkward_texts():
    rng = random.Random(8)
    texts = [None, "", " \n\t", "a", "a\n\na\n a\nb", "# $ % & | < > *", "é\x0bÀ 日本\x1c x", "x " * 20000, "a b c d e " * 9,
             "line\r\nline\r\nline", "w" * 50000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 30))) for _ in range(60)]
    return texts


def test_base_counts_against_plain_python():
    for t in awkward_texts():
        raw = None if t is None else t.encode()
        words = words_of(raw)
        got = quality.base_counts(raw, words, word_hashes(words))
        want = brute.base_quality(t)
        assert got == want[:5], repr((t or "")[:60])
        assert quality.failed(got[0], got[4]) == want[5]


def slow_slots(text):
    import xxhash

    def mix(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & MASK
        h = (h ^ h >> 27) * 0x94D049BB133111EB & MASK
        return h ^ h >> 31

    words = [xxhash.xxh64_intdigest(w) for w in text.encode().split()]
    shift, out = 64 - (quality.DIMS.bit_length() - 1), []
    for k in (1, 2):
        slots = []
        for i in range(len(words) - k + 1):
            acc = 0
            for w in words[i:i + k]:
                acc = (acc ^ w) * 0x9E3779B97F4A7C15 & MASK
                acc ^= acc >> 29
            slots.append(((mix(acc) ^ k) * 0x9E3779B97F4A7C15 & MASK) >> shift)
        out.append(slots)
    for k in (3, 5):
        slots = []
        low = text.lower()
        for i in range(len(low) - k + 1):
            h = k
            for c in low[i:i + k]:
                h = (h * 0x100000001B3 + ord(c)) & MASK
            slots.append(mix(h) >> shift)
        out.append(slots)
    return [s for s in out if s]


def test_slots_against_plain_python():
    for t in ["", "a", "Ab cd", "é日本 x\ny", "the quick brown fox " * 3]:
        got = [s.tolist() for s in quality.gram_slots(t.encode(), word_hashes(t.encode().split()))]
        assert got == slow_slots(t)
        assert all(0 <= x < quality.DIMS for s in got for x in s)


@pytest.fixture(scope="module")
def trained(spark):
    d = "/root/testdata/sf0.1"
    docs_, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return docs_, labels, quality.train(docs_, labels, rows=150)


def test_held_out_accuracy(spark, trained):
    docs_, labels, model = trained
    order = F.md5(F.concat(F.lit(quality.SEED), F.col("doc_id").cast("string")))
    used = [labels.where(F.col("quality") == y).orderBy(order, "doc_id").limit(150) for y in (0, 1)]
    rest = labels.join(used[0].unionByName(used[1]), "doc_id", "left_anti").where(F.rand(3) < 0.3)
    out = quality.on_text(docs_, quality.quality_udf(spark, model), ["doc_id"]).join(rest.select("doc_id", "quality"), "doc_id")
    by = {(r.quality, r.kept): r["count"] for r in out.where("n_words >= 20").groupBy("quality", "kept").count().collect()}
    good, bad = by.get((1, True), 0) + by.get((1, False), 0), by.get((0, True), 0) + by.get((0, False), 0)
    assert good > 500 and bad > 10
    assert by.get((1, True), 0) / good >= 0.98          # clean documents stay
    assert by.get((0, False), 0) / bad >= 0.85


def test_digest_equals_plain_python(spark, trained):
    model = trained[2]
    df = docs(spark, awkward_texts()).unionByName(spark.read.parquet(f"{SF}/documents.parquet").select(docs(spark, []).columns))
    got = quality.on_text(df, quality.quality_udf(spark, model), ["doc_id"]).collect()
    texts = {}
    for r in df.collect():
        texts.setdefault((r.doc_id, brute.base_quality(r.text)[0]), []).append(r.text)
    for r in got:
        assert any((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_quality(t)
                   and (r.kept == (not r.base_failed and slow_probability(model, t) >= quality.THRESHOLD))
                   for t in texts[(r.doc_id, r.n_words)])


def slow_probability(model, text):
    score = model.bias + sum(np.float64(sum(float(model.weights[x]) for x in s)) / len(s) for s in slow_slots(text or ""))
    return 1 / (1 + np.exp(-(model.a * score + model.b)))


def test_reruns_agree(spark, trained):
    docs_, labels, model = trained
    again = quality.train(docs_.repartition(7), labels.repartition(3), rows=150)
    assert np.array_equal(model.weights, again.weights) and (model.a, model.b) == (again.a, again.b)


def test_no_labels_one_class_and_clashes(spark):
    df = clashing(docs(spark, ["one two three four five six seven eight nine ten eleven", "short", None]))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(0, 1, 0), (1, 1, 0), (None, 0, 0), (2, None, 0), (99, 0, 0)], none.schema)):
        model = quality.train(df, labels)
        assert model is None
        assert [r.doc_id for r in quality.keep_quality(df, model).collect()] == [0]
        assert quality.keep_quality(df, model).columns == df.columns
        assert [r.kept for r in quality.quality_digest(df, labels).orderBy("doc_id").collect()] == [True, False, False]
    assert quality.quality_digest(docs(spark, []), none).count() == 0


def test_labelled_twice_counts_once(spark):
    texts = [("good plain words number %d and more of them here" % i) if i % 2 else "$$ ## %% && ** $$ ## %% && **" for i in range(60)]
    df = docs(spark, texts)
    lab = [(i, i % 2, 0) for i in range(60)]
    one = quality.train(df, spark.createDataFrame(lab, "doc_id long, quality int, toxic int"))
    two = quality.train(df.unionByName(df), spark.createDataFrame(lab + lab + [(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert np.array_equal(one.weights, two.weights)
    assert rows(quality.on_text(df, quality.quality_udf(spark, one), ["doc_id"]))
