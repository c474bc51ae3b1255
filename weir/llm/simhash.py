"""Operator 9, SimHash near-dedup: binary trie self-join.

Fingerprints: a text's words (A-Z lower-cased) in shingles of four, XXH64 with
seed 42 of each, a bit set where over half of the shingles set it. Distinct
fingerprints are joined with themselves in binary tries: node pairs are
traversed together, adding up differing bits, and a pair is dropped once the
budget is exceeded.

Sharding: the 64 bits are cut into ``max_bits + 1`` blocks, and one trie is built
per block with that block's bits leading. Two fingerprints within the budget
agree in at least one whole block, so they meet below one node at the end of the
leading block of that trie; each such node is a unit of work, and nothing is
compared across units. The traversal inside a unit is depth first over chunks of
node pairs, so its memory is bounded; links are reduced to a spanning forest of
the unit before they leave the task (at most one per fingerprint and block,
however dense a group of near copies is). Components are then found by
``weir.llm.components``.

Defined cases: null, empty and blank texts have fingerprint zero and link like
any other; texts with fewer words than a shingle use all their words as one;
repeated rows and exact copies share a fingerprint and a component; a null doc_id
is a member of its group but never its ``component_id`` (null if the group has
no other); an empty table gives no rows; extra columns are ignored by
``simhash_groups`` and kept by ``keep_one_per_group``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.components import components
from weir.llm.text import fresh, on_text, text_key, text_udf
from weir.session import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Shingles whose bits are added up at a time.
_CHUNK = 1 << 15
#: Node pairs held per step of the traversal; pairs of nodes this small are compared leaf by leaf.
_FRONTIER = 1 << 18
_LEAVES = 32


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        stop = ends[shingle - 1:].tolist()
        start = [0, *(ends[:-shingle] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start, stop)), np.uint64, len(stop))
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i:i + _CHUNK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprint_batch(shingle: int):
    def batch(texts):
        return [(int(np.uint64(fingerprint(t, shingle)).astype(np.int64)),) for t in texts]
    return batch


def with_fingerprint(df: DataFrame, keep: list[str], text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns plus ``fp`` (the 64 bits as a signed long)."""
    return on_text(df, text_udf("fp long", _fingerprint_batch(shingle)), keep, text_col)


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each block, bits counted from the top."""
    n = max_bits + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def trie_pairs(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: int, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of the sorted distinct ``v`` whose bits differ in at most
    ``budget`` places, both below one of the trie nodes ``v[lo:hi]`` at ``depth``."""
    stack = [(lo, hi, lo, hi, np.zeros(len(lo), np.int8), depth)]
    while stack:
        a0, a1, b0, b1, diff, d = stack.pop()
        if len(a0) > _FRONTIER:
            h = len(a0) // 2
            for s in (slice(None, h), slice(h, None)):
                stack.append((a0[s], a1[s], b0[s], b1[s], diff[s], d))
            continue
        small = ((a1 - a0) * (b1 - b0) <= _LEAVES) | (d == 64)
        if small.any():
            yield from _leaf_pairs(v, a0[small], a1[small], b0[small], b1[small], budget)
            big = ~small
            a0, a1, b0, b1, diff = a0[big], a1[big], b0[big], b1[big], diff[big]
        if not len(a0):
            continue
        bit = np.uint64(1) << np.uint64(63 - d)
        above = ~(bit | (bit - np.uint64(1)))
        am = np.clip(np.searchsorted(v, (v[a0] & above) | bit), a0, a1)
        bm = np.clip(np.searchsorted(v, (v[b0] & above) | bit), b0, b1)
        own = a0 == b0
        parts = [(a0, am, b0, bm, diff, None), (am, a1, bm, b1, diff, None),
                 (a0, am, bm, b1, diff + 1, None), (am, a1, b0, bm, diff + 1, ~own)]
        nxt = []
        for x0, x1, y0, y1, s, only in parts:
            live = (x0 < x1) & (y0 < y1) & (s <= budget)
            if only is not None:
                live &= only
            nxt.append((x0[live], x1[live], y0[live], y1[live], s[live]))
        stack.append((*[np.concatenate(x) for x in zip(*nxt)], d + 1))


def _leaf_pairs(v, a0, a1, b0, b1, budget):
    """All leaves of small node pairs against each other."""
    na, nb = a1 - a0, b1 - b0
    n = na * nb
    for s in range(0, len(n), 1 << 15):
        c = n[s:s + (1 << 15)]
        k = np.repeat(np.arange(s, s + len(c)), c)
        at = np.arange(len(k)) - np.repeat(np.cumsum(c) - c, c)
        i, j = a0[k] + at // nb[k], b0[k] + at % nb[k]
        hit = (i < j) & (np.bitwise_count(v[i] ^ v[j]) <= budget)
        if hit.any():
            yield i[hit], j[hit]


def _union(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Merge the classes of i and j; a class is labelled by its smallest index."""
    while True:
        a, b = label[i], label[j]
        live = a != b
        if not live.any():
            return label
        i, j, a, b = i[live], j[live], a[live], b[live]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _join_units(max_bits: int, at_once: int = 1 << 17):
    """Task: rows (trie, block, fp) sorted by (trie, block) -> spanning links of each unit."""
    widths = blocks(max_bits)
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(trie: np.ndarray, fp: np.ndarray):
        for t in np.unique(trie):
            first, width = widths[int(t)]
            f = np.unique(fp[trie == t])
            r = (f << np.uint64(first)) | (f >> np.uint64(64 - first)) if first else f
            order = np.argsort(r)
            r, f = r[order], f[order]
            head = r >> np.uint64(64 - width)
            lo = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
            hi = np.r_[lo[1:], len(r)]
            many = hi - lo > 1
            label = np.arange(len(r))
            for i, j in trie_pairs(r, lo[many], hi[many], width, max_bits):
                label = _union(label, i, j)
            k = np.flatnonzero(label != np.arange(len(r)))
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(f[k].astype(np.int64)),
                                                  pa.array(f[label[k]].astype(np.int64))], schema=out)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, block, fp = [], [], []
        held = 0

        def flush(rest: bool):
            """Run all whole units read so far; the last unit may go on in the next batch."""
            nonlocal trie, block, fp, held
            t, b, f = np.concatenate(trie), np.concatenate(block), np.concatenate(fp)
            cut = len(t) if rest else int(np.flatnonzero((t == t[-1]) & (b == b[-1]))[0])
            if cut:
                yield from links(t[:cut], f[:cut])
            trie, block, fp = [t[cut:]], [b[cut:]], [f[cut:]]
            held = len(t) - cut

        for batch in batches:
            if not batch.num_rows:
                continue
            trie.append(batch.column(0).to_numpy())
            block.append(batch.column(1).to_numpy())
            fp.append(batch.column(2).to_numpy().astype(np.uint64))
            held += batch.num_rows
            if held >= at_once:
                yield from flush(False)
        if held:
            yield from flush(True)

    return task


def simhash_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct ``fp`` -> links ``u, v`` with the same connected components as all
    pairs of fingerprints that differ in at most ``max_bits`` bits."""
    units = []
    for i, (first, width) in enumerate(blocks(max_bits)):
        block = F.shiftrightunsigned(F.shiftleft("fp", first), 64 - width)
        units.append(F.struct(F.lit(i).alias("trie"), block.alias("block")))
    rows = fps.select("fp", F.explode(F.array(*units)).alias("x")).select("x.trie", "x.block", "fp")
    rows = rows.repartition("trie", "block").sortWithinPartitions("trie", "block")
    return rows.mapInArrow(_join_units(max_bits), "u long, v long")


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``df``: ``doc_id, text_key, fp, root, component_id``;
    ``root`` is the smallest fingerprint of the component."""
    q = lambda c: F.col(f"`{c}`")
    docs = df.select(q(id_col).alias("doc_id"), text_key(q(text_col)).alias("text_key"), q(text_col).alias("text"))
    # 24 bytes a document, read three times below: cheaper kept than hashed again.
    docs = materialize(with_fingerprint(docs, ["doc_id", "text_key"], "text", shingle))
    fps = docs.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(simhash_links(fps.select("fp"), max_bits))
    fps = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = fps.groupBy("root").agg(F.min("low").alias("component_id"))
    named = fps.join(lows, "root").select(F.col("fp").alias("named_fp"), "root", "component_id")
    return docs.join(named, F.col("fp") == F.col("named_fp")).select("doc_id", "text_key", "fp", "root", "component_id")


def keep_one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that stay: of each component the one with the smallest
    id (null ids last; of rows that repeat an id, the one with the smallest text
    hash; of rows that repeat both, one)."""
    q = lambda c: F.col(f"`{c}`")
    g = simhash_groups(df, id_col, text_col, **options)
    kept = g.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("n"), F.col("doc_id"), F.col("text_key"))).alias("k"))
    keys = [fresh("__id_key", df.columns), fresh("__text_key", df.columns)]
    kept = kept.select(F.xxhash64("k.doc_id").alias(keys[0]), F.col("k.text_key").alias(keys[1]))
    rows = df.withColumns({keys[0]: F.xxhash64(q(id_col)), keys[1]: text_key(q(text_col))})
    return rows.join(kept, keys).dropDuplicates(keys).select(*[q(c) for c in df.columns])


def simhash_digest(df: DataFrame) -> DataFrame:
    g = simhash_groups(df)
    return g.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
