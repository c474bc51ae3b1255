"""Phrase collocations: plain Python, the summaries' guarantee, awkward texts."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from weir.llm import phrases

KIND = "doc_id long, text string, lang string"


def brute(rows, min_count=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 5):
                f[lang].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        cands = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        best = []
        for p, a in cands.items():
            inside = any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in cands.items())
            if not inside:
                score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(df, **options).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], KIND)


def corpus(n=120):
    rng = np.random.default_rng(3)
    words = np.array(["New", "york", "CITY", "of", "the", "a", "Éa", "éa", "x\x0by", "big", "Apple", "\x01", "日本", "語", "'tis"])
    marks = np.array([" ", " ", " ", " ", "\t", ". ", ", ", "\n", "?", "  "])
    out = []
    for i in range(n):
        t = "".join(w + m for w, m in zip(rng.choice(words, 60), rng.choice(marks, 60)))
        if i % 3:
            t += " in new york city of light; new york. big apple pie "
        out.append((["en", None, "und", ""][i % 4], t))
    return out + [("en", None), ("fr", ""), ("fr", " \n.,"), (None, "solo")]


def test_equals_plain_python(spark):
    rows = corpus()
    assert found(frame(spark, rows)) == brute(rows)


@pytest.mark.parametrize("options", [{"slack": 1}, {"partition_mass": 500, "slack": 1}, {"filter_bits": 6}, {"min_count": 3, "partition_mass": 2000}])
def test_any_summary_size_gives_the_same(spark, options):
    """Tight summaries, many hash partitions and a saturated filter change cost, not rows."""
    rows = corpus(60)
    assert found(frame(spark, rows), **options) == brute(rows, options.get("min_count", 30))


def test_top_rows_and_ties(spark):
    rows = [("en", " ".join(f"w{i} v{i};" for i in range(40))) for _ in range(30)]
    got = found(frame(spark, rows), top=7)
    assert got == brute(rows, top=7) and [r[1] for r in got] == list(range(1, 8))


def test_hot_and_repeated_rows(spark):
    """One text holds a third of all rows; repeats count as often as they occur."""
    rows = corpus(40) + [("en", "New York city. the big apple")] * 25
    assert found(frame(spark, rows)) == brute(rows)


def test_long_text_in_slices(spark, monkeypatch):
    rows = [("en", "Alpha beta, gamma\tdelta " * 50 + "x" * 300 + ".end " * 40)]
    whole = phrases.word_numbers(rows[0][1].encode(), phrases.new_numbers())
    monkeypatch.setattr(phrases, "SLICE", 64)
    cut = phrases.word_numbers(rows[0][1].encode(), phrases.new_numbers())
    assert (whole == cut).all()
    assert found(frame(spark, rows)) == brute(rows)


def test_empty_tables_and_clashing_columns(spark):
    df = frame(spark, [])
    assert phrases.collocations(df).collect() == []
    rows = corpus(40)
    df = frame(spark, rows)
    for c in ("phrase", "n", "f", "l", "r", "score", "part", "summary"):
        df = df.selectExpr("*", f"'x' AS {c}")
    assert found(df) == brute(rows)


def test_summaries_keep_every_frequent_item():
    """Merged in any grouping, an item's count is at most ``taken`` below the truth, and
    ``taken`` stays below the threshold."""
    rng = np.random.default_rng(1)
    items = np.minimum(rng.zipf(1.3, 60000), 1 << 31).astype(np.uint64)
    truth = Counter(items.tolist())
    for slack in (1, 4):
        cap = slack * len(items) // 30 + 1
        merged = phrases.Summary(cap)
        for part in np.array_split(items, 37):
            merged.merge(*np.unique(part, return_counts=True))
        assert len(merged.items) <= cap and merged.taken < 30
        kept = dict(zip(merged.items.tolist(), merged.counts.tolist()))
        assert all(c - merged.taken <= kept.get(i, 0) <= c for i, c in truth.items())
        assert {i for i, c in truth.items() if c >= 30} <= set(merged.survivors(30).tolist())


def test_packed_summaries_come_back():
    items = np.unique(np.random.default_rng(2).integers(0, 1 << 32, 5000)).astype(np.uint64)
    counts = np.arange(1, len(items) + 1) * 70000 % (1 << 32)
    i, c = phrases.unpack(phrases.pack(items, counts))
    assert (i == items).all() and (c == counts).all()
    some = [b"", b"a", "é b".encode(), b"x y z w"]
    assert phrases.unpack_phrases(phrases.pack_phrases(some, np.array([5, 1, 1 << 40, 2]))) == (some, [5, 1, 1 << 40, 2])
