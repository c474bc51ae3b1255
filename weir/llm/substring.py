"""Operator 6, substring dedup: repeated-phrase automata.

A window is ``WINDOW`` consecutive words; every word covered by a window whose
words also start earlier (smaller doc_id, or same document, earlier start) goes.

1. *Candidates.* Each window is filed under its anchor, the smallest hash of its
   five-word runs: equal windows have equal anchors. Consecutive windows with one anchor
   form a piece, known by its anchor and the 128-bit hash of its words. Anchors that occur
   at one place only are dropped (a partial aggregate over hashes and a semi join).
2. *Confirm.* Pieces with the same words are gathered by a partial aggregate that
   keeps the first place, so a passage copied into a third of all documents is
   one row from here on. The texts of these first places are cut out of their
   documents, and inside each shard (a range of anchors) windows are compared
   word by word: those that start in more than one place are the phrases. The
   only piece of an anchor is a phrase as a whole.
3. *Compile and locate.* Each shard's phrases are compiled into Aho-Corasick
   automata over word numbers (pyahocorasick), and the pieces of all documents
   that can hold them -- those filed under the shard's anchors -- are streamed
   through. A match away from its phrase's first place is a range to remove; a
   piece found again at a later place is a range as a whole.
   An anchor whose distinct pieces have more than ``SHARD_WORDS`` words (five common words
   in ever different surroundings) is filed anew before it comes to a shard, by longer
   runs (``LEVELS``), and by whole windows last: then only equal windows share an anchor,
   and no task holds more.
4. Ranges are joined back to the documents, merged and cut out.

No document is read by more shards than it has anchors in, so the work grows
with the text and not with shards times text. Two pieces count as the same words if the
128-bit xxh3 of their words and their anchors agree; all else is compared word by word.

Defined cases: null text has no words; texts shorter than a window keep all
words; windows repeated inside one document count (the first stays); rows that
repeat a doc_id share its places: a window at the same place is not removed in
either; a null doc_id comes before all others; an empty table gives no rows;
extra columns are kept by ``dedup_substrings`` under any name. Rows that repeat both
doc_id and text share one set of ranges, whatever their number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StructType

from weir.llm.text import batch_udf, fresh, mix, outside, text_key, window_hashes, with_ranges, words_of, write_table

WINDOW = 20
ANCHOR = 5
#: Words of the runs by which large anchors are filed anew, level by level; then a window's.
LEVELS = (10, 15)
#: Words of pieces compiled into one automaton.
SHARD_WORDS = 200_000


def _slide(x: np.ndarray, k: int, pick) -> np.ndarray:
    """Sliding minimum or maximum over ``k`` values."""
    span = 1
    while span < k:
        step = min(span, k - span)
        x = pick(x[:-step], x[step:])
        span += step
    return x


#: Powers of an odd number modulo 2^64 and of its inverse, as far as needed so far.
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []
#: Bytes whose words are hashed together.
BLOCK = 1 << 20


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        factors = np.array([[_BASE], [pow(_BASE, -1, 1 << 64)]], np.uint64).repeat(max(BLOCK + 1, n), 1)
        factors[:, 0] = 1
        _POWERS[:] = np.cumprod(factors, axis=1, dtype=np.uint64)
    return _POWERS


def _borders(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word of words joined by one blank (which no word holds)."""
    ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
    return np.append(0, ends[:-1] + 1), ends


def joined_hashes(joined: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, a polynomial of its bytes, from one prefix sum per block.
    It files windows only: words that share a hash by accident are told apart later."""
    out = np.empty(len(start), np.uint64)
    text = np.frombuffer(joined, np.uint8)
    at = 0
    while at < len(start):
        lo = start[at]
        to = max(at + 1, int(np.searchsorted(end, lo + BLOCK, side="right")))
        x = text[lo:end[to - 1]].astype(np.uint64) + np.uint64(1)
        up, down = _powers(len(x) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[:len(x)], dtype=np.uint64)])
        s, e = start[at:to] - lo, end[at:to] - lo
        out[at:to] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def hashes_of(words: list[bytes]) -> np.ndarray:
    joined = b" ".join(words)
    return joined_hashes(joined, *_borders(joined)) if words else np.empty(0, np.uint64)


def _span_hashes(joined: bytes, first: np.ndarray, end: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit xxh3 of the words of each span of words, as two longs."""
    text = memoryview(joined)
    both = b"".join([xxhash.xxh3_128_digest(text[i:j]) for i, j in zip(first[start].tolist(), end[stop - 1].tolist())])
    halves = np.frombuffer(both, ">i8").astype(np.int64).reshape(-1, 2)
    return halves[:, 0], halves[:, 1]


def _together(texts: list[bytes | None]) -> tuple[np.ndarray, bytes]:
    """Word counts of some texts, and all their words joined by one blank."""
    split = [words_of(t) for t in texts]
    return np.array([len(w) for w in split], np.int64), b" ".join([b" ".join(w) for w in split if w])


_PIECE = "a long, b long, c long, s int, n int"


def _windows(counts: np.ndarray, hashes: np.ndarray, window: int, anchor: int):
    """Of texts of ``counts`` words, one behind the other: the hashes of the five-word runs, the
    anchor of each window, the text it begins in, and whether it lies in one text."""
    runs = window_hashes(hashes, anchor)
    low = _slide(runs, window - anchor + 1, np.minimum)
    text = np.repeat(np.arange(len(counts)), counts)
    return runs, low, text[:len(low)], text[:len(low)] == text[window - 1:]


def texts_anchors(texts: list[bytes | None], window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Per text, the distinct anchors ``a`` and at how many places ``m`` each stands: ``(numbers of
    rows per text, columns)``."""
    counts, joined = _together(texts)
    none = np.zeros(len(texts), np.int64), {"a": np.empty(0, np.int64), "m": np.empty(0, np.int64)}
    if counts.sum() < window:
        return none
    runs, low, text, inside = _windows(counts, joined_hashes(joined, *_borders(joined)), window, anchor)
    k = window - anchor + 1
    # A run is an anchor if it equals the largest of the minima of the windows around it.
    pad = np.concatenate([np.zeros(k - 1, np.uint64), np.where(inside, low, 0), np.zeros(k - 1, np.uint64)])
    at = np.flatnonzero(_slide(pad, k, np.maximum) == runs)
    at = at[runs[at] > 0]
    if not len(at):
        return none
    of = np.repeat(np.arange(len(counts)), counts)[at]
    order = np.lexsort((runs[at], of))
    of, a = of[order], runs[at][order]
    first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (a[1:] != a[:-1])])
    return np.bincount(of[first], minlength=len(texts)), {
        "a": a[first].astype(np.int64), "m": np.diff(np.r_[first, len(a)])}


def texts_pieces(texts: list[bytes | None], window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Per text its pieces: anchor ``a``, hash ``b, c`` of the words, first word ``s``, ``n`` windows."""
    counts, joined = _together(texts)
    if counts.sum() < window:
        return np.zeros(len(texts), np.int64), {k: np.empty(0, np.int64) for k in "abcsn"}
    first, end = _borders(joined)
    _, low, text, inside = _windows(counts, joined_hashes(joined, first, end), window, anchor)
    new = np.r_[True, (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])]
    start = np.flatnonzero(new)
    stop = np.r_[start[1:], len(low)]
    keep = inside[start]
    start, stop = start[keep], stop[keep]
    b, c = _span_hashes(joined, first, end, start, stop + window - 1)
    begins = np.r_[0, np.cumsum(counts)[:-1]]
    return np.bincount(text[start], minlength=len(texts)), {
        "a": low[start].astype(np.int64), "b": b, "c": c, "s": start - begins[text[start]], "n": stop - start}


#: Words of texts that are looked at together.
TOGETHER = 200_000


def _texts_udf(ddl: str, per_texts):
    """Arrow UDF from a binary text to an array of structs: ``per_texts`` takes some texts and
    gives the number of rows of each and the rows' columns."""
    kind = to_arrow_schema(StructType.fromDDL(ddl))

    def run(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        sizes, parts, at = [], [], 0
        while at < len(values):
            end, size = at, 0
            while end < len(values) and (end == at or size < 6 * TOGETHER):
                size += len(values[end] or b"")
                end += 1
            n, cols = per_texts(values[at:end])
            sizes.append(n)
            parts.append(cols)
            at = end
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes) if sizes else [])]).astype(np.int32)
        fields = [pa.array(np.concatenate([p[f.name] for p in parts]).astype(f.type.to_pandas_dtype()) if parts else [], f.type) for f in kind]
        return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(fields, fields=list(kind)))

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ArrayType(StructType.fromDDL(ddl)))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` and the two halves ``k, key`` of a row's key. Both joins of
    documents below start from this frame, so their shuffle of the texts is one."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumns(
        {"k": F.xxhash64("doc_id"), "key": text_key(F.col("text"))})


def _cut_task(window: int):
    """Task: rows ``k, key, doc_id, text, cuts`` -> ``a, b, c, doc_id, s, words``: the texts of
    the cuts, once for rows that repeat both id and text."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()),
                              batch.schema.field("doc_id"), ("s", pa.int32()), ("words", pa.binary())])
            out: list[tuple] = []
            for k, key, doc, text, cuts in zip(*(c.to_pylist() for c in batch.columns)):
                if (k, key) in seen:
                    continue
                seen.add((k, key))
                words = words_of(text)
                out += [(x["a"], x["b"], x["c"], doc, x["s"], b" ".join(words[x["s"]:x["s"] + x["n"] + window - 1])) for x in cuts]
                if len(out) >= 1 << 13:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kind.types)], schema=kind)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kind.types)], schema=kind)
    return task


def _refile_task(window: int, run: int):
    """Task: rows ``doc_id, text_key, text, cuts`` -> the windows of the cuts as pieces filed by
    runs of ``run`` words."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                joined = b" ".join(words_of(batch.column("text")[i].as_py()))
                first, end = _borders(joined)
                cuts = batch.column("cuts")[i].values
                s, n = (cuts.field(f).to_numpy().astype(np.int64) for f in ("s", "n"))
                at = np.sort(np.repeat(s - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()))
                low = _slide(window_hashes(joined_hashes(joined, first, end), run), window - run + 1, np.minimum)[at]
                new = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)])
                start, count = at[new], np.diff(np.r_[new, len(at)])
                b, c = _span_hashes(joined, first, end, start, start + count + window - 1)
                doc, key = (pa.repeat(batch.column(f)[i], len(new)) for f in ("doc_id", "text_key"))
                # A level's anchors are no other level's.
                a = mix(low[new] ^ np.uint64(run)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(c), doc, pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), key],
                    names=["a", "b", "c", "doc_id", "s", "n", "text_key"])
    return task


def _all_differ(seq: tuple, window: int) -> bool:
    """Whether one look shows that no window of a short piece repeats: a word that all
    its windows hold stands there once (equal windows hold it at two places)."""
    return any(seq.count(w) == 1 for w in seq[len(seq) - window:window])


def _locate(rows: list[tuple], window: int) -> Iterator[tuple[int, int, int, list[int]]]:
    """``(a, b, c, place, words)`` of whole anchors, in order of ``a`` -> ``a, b, c`` and the
    windows of the piece (by offset) that have an earlier place."""
    import ahocorasick

    number: dict[bytes, int] = {}
    pieces = [(a, b, c, place, tuple([number.setdefault(w, len(number)) for w in words.split()])) for a, b, c, place, words in rows]
    phrases: dict[tuple, tuple] = {}
    at = 0
    while at < len(pieces):
        end = at
        while end < len(pieces) and pieces[end][0] == pieces[at][0]:
            end += 1
        *_, first, seq = pieces[at]
        if end - at == 1 and _all_differ(seq, window):
            phrases[seq] = first
            at = end
            continue
        seen: dict[tuple, list] = {}
        for *_, (doc, s), seq in pieces[at:end]:
            for o in range(len(seq) - window + 1):
                place = (doc, s + o)
                known = seen.get(w := seq[o:o + window])
                if known is None:
                    seen[w] = [place, 1]
                else:
                    known[1] += 1
                    known[0] = min(known[0], place)
        again = {w: place for w, (place, n) in seen.items() if n > 1}
        if not again and end - at == 1:
            again = {seq: first}
        phrases.update(again)
        at = end
    if not phrases:
        return
    auto = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for seq, place in phrases.items():
        auto.add_word(seq, (len(seq), place))
    auto.make_automaton()
    for a, b, c, (doc, s), seq in pieces:
        found = set()
        for last, (n, place) in auto.iter(seq):
            o = last - n + 1
            if place != (doc, s + o):
                found.update(range(o, o + n - window + 1))
        if found:
            yield a, b, c, sorted(found)


def _locate_task(window: int, shard_words: int):
    kind = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("found", pa.list_(pa.int32()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def run(rows):
            found = list(_locate(rows, window))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*found), kind.types)], schema=kind)

        for batch in batches:
            for a, b, c, doc, s, words in zip(*(col.to_pylist() for col in batch.columns)):
                if held and held[-1][:3] == (a, b, c):
                    continue  # cut out of a repeated row
                if size >= shard_words and held[-1][0] != a:
                    yield from run(held)
                    held, size = [], 0
                held.append((a, b, c, ((doc is not None, doc), s), words))
                size += words.count(b" ") + 1
        if held:
            yield from run(held)

    return task


def large_anchors(pieces: DataFrame, window: int, shard_words: int) -> DataFrame:
    """Anchors ``a`` whose distinct pieces have more than ``shard_words`` words: at most
    one for so many words of the table."""
    words = F.col("n") + F.lit(window - 1)
    # A bound that needs no gathering of equal pieces leaves few anchors to count exactly.
    some = pieces.groupBy("a").agg(F.sum(words).alias("w")).where(F.col("w") > shard_words).select("a")
    distinct = pieces.join(some, "a", "left_semi").groupBy("a", "b", "c").agg(F.min(words).alias("w"))
    return distinct.groupBy("a").agg(F.sum("w").alias("w")).where(F.col("w") > shard_words).select("a")


def _per_document(pieces: DataFrame, *cols: str) -> DataFrame:
    """Pieces gathered per document: row key ``k, key`` and ``cuts``."""
    rows = pieces.select(F.xxhash64("doc_id").alias("k"), F.col("text_key").alias("key"), F.struct(*cols).alias("x"))
    return rows.groupBy("k", "key").agg(F.collect_set("x").alias("cuts")).hint("shuffle_hash")


def filed_pieces(docs: DataFrame, window: int, anchor: int, shard_words: int) -> DataFrame:
    """``a, b, c, doc_id, s, n, text_key``: all pieces whose anchor stands at several places;
    pieces of large anchors are filed by window."""
    text = F.col("text").cast("binary")
    names = ["a", "b", "c", "doc_id", "s", "n", "text_key"]
    places = docs.select(F.inline(_texts_udf("a long, m int", lambda t: texts_anchors(t, window, anchor))(text)))
    again = places.groupBy("a").agg(F.sum("m").alias("places")).where("places > 1").select("a")
    cut_up = _texts_udf(_PIECE, lambda t: texts_pieces(t, window, anchor))(text)
    pieces = docs.select("doc_id", F.col("key").alias("text_key"), cut_up.alias("p")).select("doc_id", "text_key", F.inline("p"))
    pieces = write_table(pieces.join(again, "a", "left_semi").select(*names), "pieces")
    kinds = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in names)
    done = None
    for run in (*(r for r in LEVELS if anchor < r < window), window, None):
        large = write_table(large_anchors(pieces, window, shard_words), "large-anchors") if run else None
        more = large is not None and not large.isEmpty()
        some = pieces.join(large, "a", "left_anti").select(*names) if more else pieces
        done = some if done is None else done.unionByName(some)
        if not more:
            return done
        wanted = _per_document(pieces.join(large, "a", "left_semi"), "s", "n")
        pieces = write_table(docs.join(wanted, ["k", "key"]).select(
            "doc_id", F.col("key").alias("text_key"), text.alias("text"), "cuts").mapInArrow(_refile_task(window, run), kinds), "refiled")


def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, anchor: int = ANCHOR, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, text_key, i, j``: word ranges covered by windows that start earlier too."""
    docs = _keyed(df, id_col, text_col)
    pieces = filed_pieces(docs, window, anchor, shard_words)
    piece = ["a", "b", "c"]
    firsts = pieces.groupBy(*piece).agg(F.min(F.struct("doc_id", "s", "n", "text_key")).alias("f"))
    # Texts of first places, cut out where their documents are.
    wanted = _per_document(firsts.select(*piece, "f.*"), *piece, "s", "n")
    cut = docs.join(wanted, ["k", "key"]).select("k", "key", "doc_id", F.col("text").cast("binary"), "cuts").mapInArrow(
        _cut_task(window), f"a long, b long, c long, doc_id {docs.schema['doc_id'].dataType.simpleString()}, s int, words binary")
    found = cut.repartition("a").sortWithinPartitions(*piece).mapInArrow(
        _locate_task(window, shard_words), "a long, b long, c long, found array<int>")
    verdict = firsts.join(found, piece, "left").select(*piece, "f", "found")
    hits = pieces.join(verdict, piece).withColumn(
        "later", ~F.struct("doc_id", "s").eqNullSafe(F.struct("f.doc_id", "f.s")))
    whole = F.array(F.struct(F.col("s").alias("i"), (F.col("s") + F.col("n") + (window - 1)).alias("j")))
    parts = F.transform("found", lambda o: F.struct((F.col("s") + o).alias("i"), (F.col("s") + o + window).alias("j")))
    return hits.where(F.col("later") | F.col("found").isNotNull()).select(
        "doc_id", "text_key", F.inline(F.when(F.col("later"), whole).otherwise(parts)))


def _kept(text, ranges) -> tuple[int, int, bytes]:
    words = words_of(text)
    keep = outside(len(words), ranges)
    kept = [words[i] for i in np.flatnonzero(keep)] if ranges else words
    return len(words), len(words) - len(kept), b" ".join(kept)


def _digest_batch(texts, ranges):
    return [(n, r, hashlib.sha256(t).hexdigest()) for n, r, t in (_kept(*x) for x in zip(texts, ranges))]


def _text_batch(texts, ranges):
    return [(None if t is None else _kept(t, r)[2].decode("utf-8", "replace") if r else t.decode("utf-8", "replace"),)
            for t, r in zip(texts, ranges)]


def dedup_substrings(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with repeated windows removed; a text that loses words has the rest joined by one space."""
    rows, ranges = with_ranges(df, repeated_ranges(df, id_col, text_col, **options), id_col, text_col)
    new = fresh("__new", rows.columns)
    rows = rows.withColumn(new, batch_udf("t string", _text_batch)(F.col(f"`{text_col}`").cast("binary"), F.col(ranges)))
    return rows.select(*[F.col(f"{new}.t").alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])


def substring_digest(df: DataFrame, **options) -> DataFrame:
    ranges = repeated_ranges(df, **options).groupBy(F.xxhash64("doc_id").alias("k"), F.col("text_key").alias("key")).agg(
        F.collect_set(F.struct("i", "j")).alias("ranges"))
    rows = _keyed(df, "doc_id", "text").join(ranges, ["k", "key"], "left")
    udf = batch_udf("n_words long, n_removed long, kept_sha256 string", _digest_batch)
    return rows.select("doc_id", udf(F.col("text").cast("binary"), F.col("ranges")).alias("r")).select("doc_id", "r.*")
