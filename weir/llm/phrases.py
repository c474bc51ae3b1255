"""Operator 12, phrase collocation mining: mergeable Misra-Gries summaries.

First pass, over all texts where they lie (no text is shuffled): a task takes texts in
chunks, numbers their words, and fingerprints every run of one to four words inside a
piece. The leading bits of a fingerprint name its *hash partition*, the next 32 bits its
item there. A chunk sends each hash partition one exact summary, sorted items as deltas
and counts in byte planes, so that an n-gram costs two to three bytes after compression.
Summaries of one partition are merged: counts of equal items are added, and beyond the
capacity the largest count that does not fit is taken from all. Capacity is
``SLACK * mass / min_count + 1`` for a partition's mass (all occurrences dealt to it), so
the sum of what is ever taken from one item, which the summary tracks, stays below
``min_count / SLACK``: every n-gram with ``min_count`` occurrences survives, and an item
that even with all that was taken cannot have so many is left out. Two n-grams that share
a fingerprint only add up, so none is lost by that.

The survivors leave as one bit each in a filter of ``FILTER_BITS`` bits, whatever the
size of the corpus; it is the only thing broadcast. Second pass: the texts are read
again, n-grams the filter does not know are skipped, the rest is counted exactly, by
their words, within a chunk; a chunk sends each (coarser) hash partition one block of
phrases and counts, and the blocks are added up, by their words again, as they stream by.
What the filter lets through wrongly costs an entry and is dropped by its exact count. Scores, containment and ranks are
joins and aggregates over the frequent n-grams alone; a join's hot side ("the ...") is
split by AQE, and the best rows of a language are taken per hash slice before they meet.

Words are cut at ASCII bytes of the whole text, in slices of ``SLICE`` bytes, so a very
long text is no problem; chunks hold about ``CHUNK_WORDS`` words and one text more. The
number of hash partitions follows the corpus (about ``PARTITION_MASS`` occurrences each),
so that no task's summaries grow with it.

Defined cases: null and empty texts hold no words; a null language counts as ``und``
(together with texts that say so); repeated rows count as often as they occur; equal
score and count are ordered by the phrase's bytes; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.text import mix, window_hashes, write_table

LONGEST = 4
MIN_COUNT = 30
#: A candidate inside a longer one that has 80 of 100 of its occurrences is dropped.
COVERED = 80
TOP = 2000
SCALE = 2_000_000
NO_LANG = "und"

#: Counters kept per occurrence of the threshold; 1 would keep the guarantee.
SLACK = 4
PARTITION_MASS = 1 << 22
FILTER_BITS = 28
CHUNK_WORDS = 1 << 20
SLICE = 1 << 22
#: Hash slices in which a language's best rows are taken first.
SLICES = 64

#: Piece borders become full stops; blanks are what is left for ``bytes.split``.
_PIECES = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_CUT = re.compile(rb"[ \t.]")


def _slices(text: bytes) -> Iterator[bytes]:
    """The text in slices that end behind a blank or a border."""
    lo = 0
    while len(text) - lo > SLICE:
        cut = _CUT.search(text, lo + SLICE)
        at = cut.end() if cut else len(text)
        yield text[lo:at]
        lo = at
    yield text[lo:]


def word_numbers(text: bytes, number: dict) -> np.ndarray:
    """Numbers of the words of a text, 0 between pieces; ``number`` numbers new words."""
    parts = []
    for part in _slices(text.lower().translate(_PIECES)):
        words = part.replace(b".", b" . ").split()
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
    parts.append(np.zeros(1, np.int64))
    return np.concatenate(parts)


def new_numbers() -> dict:
    number = defaultdict(count().__next__)
    number[b"."]  # noqa: B018 -- takes number 0
    return number


class Chunk:
    """Texts of several languages, as word numbers."""

    def __init__(self) -> None:
        self.number = new_numbers()
        self.texts: dict[str, list[np.ndarray]] = defaultdict(lambda: [np.zeros(1, np.int64)])
        self.size = 0

    def add(self, lang: str | None, text: bytes | None) -> None:
        if text:
            ids = word_numbers(text, self.number)
            self.texts[NO_LANG if lang is None else lang].append(ids)
            self.size += len(ids)

    def runs(self) -> Iterator[tuple[str, np.ndarray, int, np.ndarray, np.ndarray]]:
        """Per language and length: ``lang, ids, n, starts, fingerprints`` of all n-grams."""
        of_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.number), np.uint64, len(self.number))
        for lang, parts in self.texts.items():
            ids = np.concatenate(parts)
            h = of_word[ids]
            borders = np.cumsum(ids == 0)
            salt = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
            for n in range(1, LONGEST + 1):
                if len(ids) < n:
                    continue
                starts = np.flatnonzero((ids[:len(ids) - n + 1] > 0) & (borders[n - 1:] == borders[:len(ids) - n + 1]))
                yield lang, ids, n, starts, mix(window_hashes(h, n)[starts] ^ salt)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Chunks of a task's rows ``lang, text``."""
    chunk = Chunk()
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            chunk.add(lang.as_py(), text.as_py())
            if chunk.size >= CHUNK_WORDS:
                yield chunk
                chunk = Chunk()
    if chunk.size:
        yield chunk


# ---- first pass: summaries -------------------------------------------------------

def _planes(x: np.ndarray) -> bytes:
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pack(items: np.ndarray, counts: np.ndarray) -> bytes:
    """A summary as bytes: ascending 32-bit items as deltas, then counts; compressed."""
    raw = _planes(np.diff(items, prepend=np.uint64(0))) + _planes(counts)
    return len(items).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(b[:4], "little")
    raw = pa.decompress(b[4:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.cumsum(_from_planes(raw[:4 * n]), dtype=np.uint64), _from_planes(raw[4 * n:]).astype(np.int64)


class Summary:
    """Misra-Gries summary of one hash partition, merged from others."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.items = np.empty(0, np.uint64)
        self.counts = np.empty(0, np.int64)
        self.taken = 0

    def merge(self, items: np.ndarray, counts: np.ndarray) -> None:
        both, at = np.unique(np.concatenate([self.items, items]), return_inverse=True)
        total = np.zeros(len(both), np.int64)
        np.add.at(total, at, np.concatenate([self.counts, counts]))
        if len(both) > self.capacity:
            cut = np.partition(total, len(total) - self.capacity - 1)[len(total) - self.capacity - 1]
            self.taken += int(cut)
            total -= cut
            both, total = both[total > 0], total[total > 0]
        self.items, self.counts = both, total

    def survivors(self, min_count: int) -> np.ndarray:
        """Items that may have ``min_count`` occurrences."""
        return self.items[self.counts + self.taken >= min_count]


def _summary_task(bits: int):
    """Task: rows ``lang, text`` -> one packed summary per chunk and hash partition."""
    out = pa.schema([("part", pa.int32()), ("mass", pa.int64()), ("summary", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            fps = [f >> np.uint64(32 - bits) for *_, f in chunk.runs()]
            fps = np.sort(np.concatenate(fps)) if fps else np.empty(0, np.uint64)
            first = np.flatnonzero(np.r_[len(fps) > 0, fps[1:] != fps[:-1]][:len(fps)])
            counts = np.diff(np.r_[first, len(fps)])
            fps = fps[first]
            part = (fps >> np.uint64(32)).astype(np.int64)
            items = fps & np.uint64(0xFFFFFFFF)
            at = np.flatnonzero(np.r_[len(part) > 0, part[1:] != part[:-1]][:len(part)])
            rows, size = [], 0
            for lo, hi in zip(at, np.r_[at[1:], len(part)]):
                rows.append((int(part[lo]), int(counts[lo:hi].sum()), pack(items[lo:hi], counts[lo:hi])))
                size += len(rows[-1][2])
                if size > SLICE:
                    yield pa.RecordBatch.from_pylist([dict(zip(out.names, r)) for r in rows], schema=out)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(out.names, r)) for r in rows], schema=out)
    return task


def _merge_task(bits: int, min_count: int, slack: int, filter_bits: int):
    """Group of one hash partition's summaries -> its slice of the filter."""
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        summary = Summary(slack * int(pdf["mass"].sum()) // min_count + 1)
        at_once: list[tuple[np.ndarray, np.ndarray]] = []
        for b in pdf["summary"]:
            at_once.append(unpack(b))
            if sum(len(i) for i, _ in at_once) > max(1 << 18, len(summary.items)):
                summary.merge(*map(np.concatenate, zip(*at_once)))
                at_once = []
        if at_once:
            summary.merge(*map(np.concatenate, zip(*at_once)))
        own = filter_bits - bits
        marks = np.zeros(1 << own, bool)
        marks[(summary.survivors(min_count) >> np.uint64(32 - own)).astype(np.int64)] = True
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "marks": [np.packbits(marks, bitorder="little").tobytes()]})
    return merge


def survivor_filter(rows: DataFrame, min_count: int = MIN_COUNT, slack: int = SLACK,
                    partition_mass: int = PARTITION_MASS, filter_bits: int = FILTER_BITS) -> tuple[np.ndarray, int]:
    """The filter, as bytes, of all n-grams of ``lang, text`` (binary) that may occur ``min_count``
    times, and the bits of a fingerprint that name its hash partition."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    mass = LONGEST * size // 6  # sizes the hash partitions, nothing else
    bits = min(max(0, int(np.ceil(np.log2(max(1, mass / partition_mass))))), filter_bits - 3, 16)
    parts = rows.mapInArrow(_summary_task(bits), "part int, mass long, summary binary")
    slices = parts.groupBy("part").applyInPandas(
        _merge_task(bits, min_count, slack, filter_bits), "part int, marks binary")
    out = np.zeros(1 << (filter_bits - 3), np.uint8)
    width = len(out) >> bits
    # All slices together are the filter: 2^FILTER_BITS bits, whatever the corpus.
    for r in slices.collect():
        out[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(r["marks"], np.uint8)
    return out, bits


# ---- second pass: exact counts ---------------------------------------------------

def pack_phrases(phrases: list[bytes], counts: np.ndarray) -> bytes:
    """Phrases and counts as bytes (no word holds a line feed)."""
    raw = np.asarray(counts, "<i8").tobytes() + b"\n".join(phrases)
    return len(phrases).to_bytes(4, "little") + len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack_phrases(b: bytes) -> tuple[list[bytes], list[int]]:
    n, size = int.from_bytes(b[:4], "little"), int.from_bytes(b[4:8], "little")
    raw = pa.decompress(b[8:], decompressed_size=size, codec="zstd", asbytes=True)
    return raw[8 * n:].split(b"\n"), np.frombuffer(raw, "<i8", n).tolist()


def _count_task(known, filter_bits: int, bits: int):
    """Task: rows ``lang, text`` -> per chunk, language and hash partition a block of the
    n-grams the filter knows, with exact counts; the empty phrase counts the words."""
    out = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("block", pa.binary())])

    def found(chunk: Chunk, marks: np.ndarray) -> Iterator[tuple[int, str, list[bytes], np.ndarray]]:
        words = list(chunk.number)
        base = np.int64(len(words))
        for lang, ids, n, starts, fps in chunk.runs():
            if n == 1:
                yield 0, lang, [b""], np.array([len(starts)])
            bit = (fps >> np.uint64(64 - filter_bits)).astype(np.int64)
            hit = (marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
            at = starts[hit]
            if not len(at):
                continue
            # Exact numbers of the word sequences, one word after the other.
            key = ids[at]
            for i in range(1, n):
                key = np.unique(key, return_inverse=True)[1].astype(np.int64) * base + ids[at + i]
            _, first, count = np.unique(key, return_index=True, return_counts=True)
            part = (fps[hit][first] >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for some in np.split(order, cuts):
                runs = ids[at[first[some], None] + np.arange(n)].tolist()
                yield int(part[some[0]]), lang, [b" ".join([words[i] for i in r]) for r in runs], count[some]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = known.value
        for chunk in _chunks(batches):
            rows, size = [], 0
            for part, lang, phrases, counts in found(chunk, marks):
                rows.append((part, lang, pack_phrases(phrases, counts)))
                size += len(rows[-1][2])
                if size > SLICE:
                    yield pa.RecordBatch.from_pylist([dict(zip(out.names, r)) for r in rows], schema=out)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist([dict(zip(out.names, r)) for r in rows], schema=out)
    return task


def _add_task(min_count: int):
    """Task: rows ``part, lang, block`` sorted by the first two -> their phrases with
    ``min_count`` or more occurrences, and every language's words."""
    out = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("n", pa.int32()), ("f", pa.int64())])

    def rows(lang: str, total: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        kept = [(p, f) for p, f in total.items() if f >= min_count or not p]
        for lo in range(0, len(kept), 1 << 16):
            some = kept[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array([p or None for p, _ in some], pa.binary()),
                 pa.array([p.count(b" ") + 1 if p else 0 for p, _ in some], pa.int32()), pa.array([f for _, f in some])], schema=out)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, defaultdict(int)
        for batch in batches:
            for part, lang, block in zip(*(c.to_pylist() for c in batch.columns)):
                if (part, lang) != now:
                    if now:
                        yield from rows(now[1], total)
                    now, total = (part, lang), defaultdict(int)
                for phrase, f in zip(*unpack_phrases(block)):
                    total[phrase] += f
        if now:
            yield from rows(now[1], total)
    return task


def frequent(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
             min_count: int = MIN_COUNT, **options) -> DataFrame:
    """``lang, phrase, n, f``: every run of one to four words (``n``) inside a piece with
    its exact count ``f`` of ``min_count`` or more; per language one row with a null
    phrase, ``n`` 0 and all word occurrences."""
    rows = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
                     F.col(f"`{text_col}`").cast("binary").alias("text")).where("octet_length(text) > 0")
    marks, bits = survivor_filter(rows, min_count, **options)
    known = df.sparkSession.sparkContext.broadcast(marks)
    # The survivors are a small part of all n-grams: fewer partitions hold them.
    counts = rows.mapInArrow(_count_task(known, options.get("filter_bits", FILTER_BITS), max(0, bits - 3)),
                             "part int, lang string, block binary")
    counts = counts.repartition("part").sortWithinPartitions("part", "lang").mapInArrow(
        _add_task(min_count), "lang string, phrase binary, n int, f long")
    return write_table(counts.withColumn("phrase", F.col("phrase").cast("string")), "frequent")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best collocations of each language."""
    grams = frequent(df, text_col, lang_col, min_count, **options)
    words = grams.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    grams = grams.where("phrase IS NOT NULL")
    known = grams.select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"))

    parts = F.split("phrase", " ")
    run = lambda i, k: F.array_join(F.slice(parts, i, k), " ")
    cands = grams.where("n > 1").select("lang", "phrase", "n", F.col("f").alias("a"))
    # The lowest-scoring cut of each candidate.
    cuts = cands.select("lang", "phrase", "n", "a", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("*", run(F.lit(1), F.col("k")).alias("left"), run(F.col("k") + 1, F.col("n") - F.col("k")).alias("right"))
    cuts = cuts.join(known.toDF("lang", "left", "l"), ["lang", "left"]).join(known.toDF("lang", "right", "r"), ["lang", "right"])
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumns({"a_": exact("a") * SCALE, "lr": exact("l") + exact("r")})
    cuts = cuts.withColumn("score", F.expr("a_ div lr"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    # The most frequent longer candidate around each shorter one.
    longer = cands.where("n > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("n") - 1)))
    longer = longer.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("m") + 1)))
    longer = longer.select("lang", run(F.col("i"), F.col("m")).alias("phrase"), F.col("a").alias("around"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (exact("around") * 100 < exact("a") * COVERED))
    rows = kept.select("lang", "phrase", "a", "x.l", "x.r", "x.score")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    piece = F.pmod(F.xxhash64("phrase"), F.lit(SLICES))
    rows = rows.withColumn("slice", piece)
    rows = rows.withColumn("at", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*best)))
    rows = rows.where(F.col("at") <= top).drop("slice", "at")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    return rows.where(F.col("rank") <= top).join(words, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
