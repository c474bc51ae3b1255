"""Operator 2, quality rules: hashed n-gram logistic regression.

A text's word one- and two-grams and its lower-cased character three- and
five-grams are hashed into ``DIMS`` weights; a feature is an n-gram's share of its
kind in the text. A logistic regression is fitted on at most ``TRAIN_ROWS``
labelled rows of each class (the smallest by a hash of id and label, so reruns
agree), its scores are calibrated by Platt's method on a held-out fifth of these
rows, and texts are scored in Arrow batches against a fixed threshold of the
calibrated probability of good quality. Only the sample and the weights
(``DIMS`` floats) pass through the driver; both sizes are fixed parameters.

Base rules, computed beside the score over the whole text: ``base_failed`` if there are
fewer than ten words, or over a fifth of the words lie in five-word windows that
the text repeats.

Defined cases: null text has no words and fails; labels that are null, or of ids
without a document, are not used; a doc_id labelled twice counts once (the lower
label); with fewer than ``MIN_ROWS`` rows of either class there is no model and
the base rules decide alone; ties and repeated rows are scored alike; an empty
table gives no rows; extra columns are kept by ``keep_quality`` under any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.text import fresh, mix, on_text, outside, text_udf, window_hashes, word_hashes, words_of

DIMS = 1 << 17
TRAIN_ROWS = 600
MIN_ROWS = 10
#: Texts whose calibrated probability of good quality is below this are rejected.
THRESHOLD = 0.2
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
EPOCHS, RATE, L2 = 60, 0.5, 1e-6
SEED = "quality-1"

_BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = b"#*$%&|<>"
_WORD_GRAMS, _CHAR_GRAMS = (1, 2), (3, 5)
_SHIFT = np.uint64(64 - DIMS.bit_length() + 1)


def base_counts(text: bytes | None, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not words:
        symbols = len(text) - len(text.translate(None, _SYMBOLS)) if text else 0
        return 0, 0, symbols, 0, 0
    packed = text.translate(None, _BLANKS)
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    repeat = 0
    runs = window_hashes(hashes, REPEAT_WINDOW)
    if len(runs) > 1:
        _, at, n = np.unique(runs, return_inverse=True, return_counts=True)
        again = np.flatnonzero(n[at] > 1)
        if len(again):
            repeat = int(len(words) - outside(
                len(words), [{"i": i, "j": i + REPEAT_WINDOW} for i in again.tolist()]).sum())
    return (len(words), len(packed.decode("utf-8", "replace")), len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeat)


def failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words


def gram_slots(text: bytes, hashes: np.ndarray) -> list[np.ndarray]:
    """Slots of every n-gram, one array per kind of n-gram (none empty)."""
    out = []
    for k in _WORD_GRAMS:
        h = window_hashes(hashes, k)
        out.append((h ^ np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15) >> _SHIFT)
    chars = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32).astype(np.uint64)
    for k in _CHAR_GRAMS:
        n = len(chars) - k + 1
        if n > 0:
            h = np.full(n, k, np.uint64)
            for i in range(k):
                h = h * np.uint64(0x100000001B3) + chars[i:i + n]
            out.append(mix(h) >> _SHIFT)
    return [x.astype(np.int64) for x in out if len(x)]


@dataclass
class Model:
    """Weights of the slots, bias, and the calibration ``p = 1 / (1 + exp(-(a * score + b)))``."""

    weights: np.ndarray
    bias: float
    a: float
    b: float

    def probability(self, text: bytes, hashes: np.ndarray) -> float:
        score = self.bias + sum(float(self.weights[s].mean()) for s in gram_slots(text, hashes))
        return _sigmoid(self.a * score + self.b)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _features(text: bytes | None) -> tuple[list, list]:
    """Slots and values of a training text."""
    hashes = word_hashes(words_of(text))
    at, value = [], []
    for s in gram_slots(text or b"", hashes):
        slot, n = np.unique(s, return_counts=True)
        at.append(slot)
        value.append(n / len(s))
    if not at:
        return [], []
    return np.concatenate(at).astype(np.int32), np.concatenate(value).astype(np.float32)


def _blocks(rows: list[tuple], entries: int = 1 << 18) -> list[tuple]:
    """Rows as blocks of flat arrays (first row, slots, values, row of each entry)."""
    out, first = [], 0
    while first < len(rows):
        last, size = first, 0
        while last < len(rows) and (last == first or size + len(rows[last][0]) <= entries):
            size += len(rows[last][0])
            last += 1
        part = rows[first:last]
        out.append((first, last, np.concatenate([r[0] for r in part]), np.concatenate([r[1] for r in part]),
                    np.repeat(np.arange(len(part), dtype=np.int32), [len(r[0]) for r in part])))
        first = last
    return out


def _fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> Model:
    """Full-batch logistic regression with per-weight steps (Adagrad), a block of rows
    at a time; every fifth row calibrates."""
    held = [r for i, r in enumerate(rows) if i % 5 == 4]
    train = [r for i, r in enumerate(rows) if i % 5 != 4]
    y = np.array([r[2] for r in train], np.float64)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, bias, seen, seen_b = np.zeros(DIMS), 0.0, np.full(DIMS, 1e-12), 1e-12
    blocks = _blocks(train)
    for _ in range(EPOCHS):
        g, g_b = L2 * w, 0.0
        for first, last, at, value, row in blocks:
            score = np.bincount(row, value * w[at], last - first) + bias
            r = share[first:last] * (_sigmoid(score) - y[first:last])
            g += np.bincount(at, value * r[row], DIMS)
            g_b += r.sum()
        seen += g * g
        seen_b += g_b ** 2
        w -= RATE * g / np.sqrt(seen)
        bias -= RATE * g_b / np.sqrt(seen_b)
    score = np.array([float(v @ w[s]) + bias for s, v, _ in held])
    y = np.array([r[2] for r in held], np.float64)
    # Platt: smoothed targets, Newton steps on (a, b).
    up, down = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * score + b)
        g = np.array([((p - t) * score).sum(), (p - t).sum()]) + 1e-6 * np.array([a, b])
        q = p * (1 - p)
        h = np.array([[(q * score * score).sum(), (q * score).sum()], [(q * score).sum(), q.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
    return Model(w.astype(np.float32), float(bias), float(a), float(b))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_id: str = "doc_id", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Model | None:
    """A model of the labelled rows, or None if a class has too few."""
    q = lambda c: F.col(f"`{c}`")
    known = labels.select(q(label_id).alias("id"), q(label_col).cast("int").alias("y")).dropna()
    known = known.where("y IN (0, 1)").groupBy("id").agg(F.min("y").alias("y"))
    known = known.join(docs.select(q(id_col).alias("id")).distinct(), "id", "left_semi")
    order = F.md5(F.concat(F.lit(SEED), F.col("id").cast("string")))
    picked = None
    for y in (0, 1):
        one = known.where(F.col("y") == y).orderBy(order, "id").limit(rows)
        picked = one if picked is None else picked.unionByName(one)
    sample = F.broadcast(picked)  # at most 2 * rows ids
    texts = docs.select(q(id_col).alias("id"), q(text_col).alias("text")).join(sample, "id")
    udf = text_udf("at array<int>, value array<float>", lambda ts: [_features(t) for t in ts])
    # Rows that repeat an id: the one with the fewest n-grams, by their slots on a tie; so at
    # most 2 * rows of them come to the driver.
    got = on_text(texts, udf, ["id", "y"]).groupBy("id", "y").agg(
        F.min_by(F.struct("at", "value"), F.struct(F.size("at"), F.col("at"))).alias("f"))
    got = got.select("id", "y", "f.at", "f.value").orderBy("id").toArrow().combine_chunks()
    ys = got["y"].to_numpy()
    ends, at, value = [np.concatenate([[0], np.cumsum(pc.list_value_length(got["at"]).to_numpy())])] + [
        pc.list_flatten(got[c]).to_numpy() for c in ("at", "value")]
    if min((ys == 0).sum(), (ys == 1).sum()) < MIN_ROWS:
        return None
    return _fit([(at[a:b], value[a:b], int(y)) for a, b, y in zip(ends, ends[1:], ys)])


def _score_batch(shared, threshold: float):
    def batch(texts):
        model = shared.value
        out = []
        for text in texts:
            words = words_of(text)
            hashes = word_hashes(words)
            counts = base_counts(text, words, hashes)
            bad = failed(counts[0], counts[4])
            p = None if model is None or not words else float(model.probability(text, hashes))
            out.append((*counts, bad, not bad and (p is None or p >= threshold), p))
        return out
    return batch


def quality_udf(spark, model: Model | None, threshold: float = THRESHOLD):
    shared = spark.sparkContext.broadcast(model)  # DIMS floats: 512 KB
    return text_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                    "base_failed boolean, kept boolean, p_good double", _score_batch(shared, threshold))


def keep_quality(df: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` that are kept."""
    r = fresh("__r", df.columns)
    rows = df.withColumn(r, quality_udf(df.sparkSession, model, threshold)(F.col(f"`{text_col}`").cast("binary")))
    return rows.where(F.col(f"{r}.kept")).drop(r)


def quality_digest(df: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(df, labels)
    return on_text(df, quality_udf(df.sparkSession, model), ["doc_id"])
