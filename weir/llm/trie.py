"""Operator 11, conversation prefix trie: vertical bitmaps.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it. Turns are hashed where they lie (first 128 bits of
SHA-256 over role and text), so no text is shuffled, then numbered and range-sorted by
conversation. A task cuts its rows into *shards* of consecutive conversations of about
``SHARD_ROWS`` turns and indexes each vertically: (position, turn) -> bitset of the
shard's conversations. Depth-first from the root, a node's children are the
intersections of its bitset with the postings of the next position; a popcount gives its
members, the bits that end here its end list. A local node is named by a hash of its
path, so the shards' nodes meet in one aggregate: whatever a node's size, a shard sends
one row for it.

Sums over subtrees need no walk over the merged trie: each shard learns which of its
nodes it owns (the shard of the smallest member) and which are childless everywhere, sums
its own contributions over its own preorder ranges, and the shards' sums are added.

A conversation longer than ``SEGMENT`` turns is cut into segments, each filed in shards of
its own under the path that leads to it, so that one conversation with any share of all
rows is spread over tasks; the subtree sums then go through the segment levels, last
level first, one round of joins each. The list of ids that end in a node is hashed as a
stream over its shards' sorted pieces; a SHA-256 has one reader by nature, but never more
than one piece in memory.

Defined cases: null role or text counts as empty; turns are ordered by ``turn`` (nulls
first), ties by the hash of role and text; repeated rows are turns of their own; rows with
a null conversation id belong to no conversation and take no part; an empty table gives
no rows; other columns are ignored, whatever their names. Rows of one conversation that
all share one ``turn`` value are numbered by one (spilling) window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.text import word_count, write_table

SHARD_ROWS = 16384
SEGMENT = 4096
#: Turn numbers that are numbered together.
BUCKET = 256


def _sha16(b: bytes) -> bytes:
    return hashlib.sha256(b).digest()[:16]


def turn_key(role: Column, text: Column) -> Column:
    """128-bit hash of a turn; the length in front keeps role and text apart."""
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))


def numbered_turns(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, pos, key, words``: every turn, numbered from 1 within its conversation."""
    q = lambda c: F.col(f"`{c}`")
    role, text = (F.coalesce(q(c), F.lit("")) for c in (role_col, text_col))
    turns = df.where(q(conv_col).isNotNull()).select(
        q(conv_col).cast("long").alias("conv_id"), q(turn_col).alias("turn"),
        turn_key(role, text).alias("key"), word_count(text).alias("words"))
    # Two levels, so that a long conversation is not numbered by one task.
    turns = write_table(turns.withColumn("bucket", F.floor(F.col("turn") / BUCKET)), "turns")
    counts = turns.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("bucket")).rowsBetween(Window.unboundedPreceding, -1)))
    later = counts.where("before > 0").select(F.col("conv_id").alias("c"), F.col("bucket").alias("b"), "before")
    row = F.row_number().over(Window.partitionBy("conv_id", "bucket").orderBy(F.asc_nulls_first("turn"), "key"))
    turns = turns.withColumn("row", row.cast("long"))
    turns = turns.join(later, (F.col("conv_id") == F.col("c")) & F.col("bucket").eqNullSafe(F.col("b")), "left")
    return turns.select("conv_id", (F.col("row") + F.coalesce("before", F.lit(0))).alias("pos"), "key", "words")


def _entries(turns: DataFrame, segment: int) -> DataFrame:
    """``conv_id, seg, entry, more`` of conversations with several segments: the name of the
    path that leads to a segment, and whether another follows."""
    long = turns.where(F.col("pos") > segment).select("conv_id").distinct()
    rows = turns.join(long, "conv_id", "left_semi").withColumn("seg", F.floor((F.col("pos") - 1) / segment).cast("int"))
    keys = F.transform(F.sort_array(F.collect_list(F.struct("pos", "key"))), lambda x: F.hex(x["key"]))
    segs = rows.groupBy("conv_id", "seg").agg(F.unhex(F.sha2(F.unhex(F.array_join(keys, "")), 256)).alias("digest"))
    digests = F.transform(F.sort_array(F.collect_list(F.struct("seg", "digest"))), lambda x: x["digest"])
    name = lambda entry, digest: F.unhex(F.substring(F.sha2(F.concat(entry, digest), 256), 1, 32))
    none = F.expr("array(cast('' AS binary))")
    chain = F.aggregate(digests, none, lambda s, d: F.concat(s, F.array(name(F.element_at(s, -1), d))))
    whole = segs.groupBy("conv_id").agg(chain.alias("chain"))
    out = whole.select("conv_id", F.size("chain").alias("m"), F.posexplode("chain").alias("seg", "entry"))
    # The chain ends with the name of the whole path, which leads to no segment.
    return out.where("seg < m - 1").select("conv_id", "seg", "entry", (F.col("seg") < F.col("m") - 2).alias("more"))


_LOCAL = pa.schema([
    ("seg", pa.int32()), ("shard", pa.int64()), ("idx", pa.int32()), ("up", pa.int32()), ("end", pa.int32()),
    ("key", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("words", pa.int64()),
    ("n", pa.int64()), ("low", pa.int64()), ("ends", pa.string())])
_LOCAL_DDL = ("seg int, shard long, idx int, up int, end int, key binary, parent binary, depth long, words long, "
              "n long, low long, ends string")


def _bits(b: int) -> Iterator[int]:
    while b:
        low = b & -b
        yield low.bit_length() - 1
        b ^= low


def local_trie(seg: int, segment: int, convs: list[int], paths: list[list[tuple[bytes, int]]],
               entries: list[bytes], more: list[bool]) -> dict[str, list]:
    """Nodes of one shard in preorder. ``paths``: each conversation's (turn key, words) in
    this segment; ``convs`` ascending. A segment behind the first starts with the node that
    leads to it, marked by a null ``low``."""
    postings: list[dict[bytes, int]] = []
    words: list[dict[bytes, int]] = []
    ended: dict[int, int] = {}
    starts: dict[bytes, int] = {}
    for c, path in enumerate(paths):
        bit = 1 << c
        starts[entries[c]] = starts.get(entries[c], 0) | bit
        if not more[c]:
            ended[len(path)] = ended.get(len(path), 0) | bit
        while len(postings) < len(path):
            postings.append({})
            words.append({})
        for at, (key, w) in enumerate(path):
            postings[at][key] = postings[at].get(key, 0) | bit
            words[at][key] = w
    out: dict[str, list] = {f: [] for f in ("up", "key", "parent", "depth", "words", "n", "low", "ends")}
    for entry, members in starts.items():
        # bitset, position, hash of the path so far, preorder number and name of the parent, words
        stack = [(members, 0, hashlib.sha256(), -1, None, 0)]
        while stack:
            bits, at, path, up, parent, w = stack.pop()
            name = entry if seg and not at else _sha16(entry + path.digest())
            idx = len(out["up"])
            over = bits & ended.get(at, 0)
            out["up"].append(up)
            out["key"].append(name)
            out["parent"].append(parent)
            out["depth"].append(seg * segment + at)
            out["words"].append(w)
            out["n"].append(bits.bit_count())
            out["low"].append(None if seg and not at else convs[(bits & -bits).bit_length() - 1])
            out["ends"].append(",".join([str(convs[c]) for c in _bits(over)]) if over and not (seg and not at) else None)
            rest = bits & ~over if at < segment else 0
            while rest:
                key = paths[(rest & -rest).bit_length() - 1][at][0]
                child = bits & postings[at][key]
                rest &= ~child
                h = path.copy()
                h.update(key)
                stack.append((child, at + 1, h, idx, name, words[at][key]))
    size = [1] * len(out["up"])
    for i in range(len(size) - 1, -1, -1):
        if out["up"][i] >= 0:
            size[out["up"][i]] += size[i]
    out["idx"] = list(range(len(size)))
    out["end"] = [i + s for i, s in enumerate(size)]
    return out


def _shard_task(segment: int, shard_rows: int):
    """Task: rows ``seg, conv_id, pos, key, words, entry, more`` sorted by the first three
    (pos 0: the conversation itself) -> local nodes."""
    def nodes(seg, convs, paths, entries, more):
        got = local_trie(seg, segment, convs, paths, entries, more)
        got["seg"] = [seg] * len(got["up"])
        got["shard"] = [convs[0]] * len(got["up"])
        for lo in range(0, len(got["up"]), 4096):
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name][lo:lo + 4096], f.type) for f in _LOCAL], schema=_LOCAL)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, 0
        convs: list = []
        paths: list = []
        entries: list = []
        more: list = []
        for batch in batches:
            for seg, conv, pos, key, w, entry, on in zip(*(c.to_pylist() for c in batch.columns)):
                if not convs or seg != now or conv != convs[-1]:
                    if convs and (seg != now or rows >= shard_rows):
                        yield from nodes(now, convs, paths, entries, more)
                        convs, paths, entries, more, rows = [], [], [], [], 0
                    now = seg
                    convs.append(conv)
                    paths.append([])
                    entries.append(entry)
                    more.append(on)
                if pos:
                    paths[-1].append((key, w))
                rows += 1
        if convs:
            yield from nodes(now, convs, paths, entries, more)
    return task


_SUMS = pa.schema([("key", pa.binary()), ("saved", pa.int64()), ("leaves", pa.int64()), ("parent_conv_id", pa.int64())])


def _sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows ``shard, idx, up, end, key, conv_id, saved, leaves`` sorted by shard and
    preorder, a shard whole in one task -> its sums over its nodes' subtrees."""
    def sums(t: pa.Table) -> pa.RecordBatch:
        up, end, conv = (t.column(c).to_numpy() for c in ("up", "end", "conv_id"))
        idx = np.arange(t.num_rows)
        cols = []
        for c in ("saved", "leaves"):
            upto = np.r_[0, np.cumsum(t.column(c).to_numpy())]
            cols.append(pa.array(upto[end] - upto[idx]))
        return pa.RecordBatch.from_arrays(
            [t.column("key").combine_chunks(), *cols, pa.array(conv[np.maximum(up, 0)], mask=up < 0)], schema=_SUMS)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            # A new shard begins with its first node.
            starts = np.flatnonzero(batch.column("idx").to_numpy() == 0)
            starts = starts[starts > 0] if not held else starts
            cut = int(starts[0]) if len(starts) else batch.num_rows
            if cut:
                held.append(batch.slice(0, cut))
            if len(starts):
                yield sums(pa.Table.from_batches(held).combine_chunks())
                held = []
            batch = batch.slice(cut)
    if held:
        yield sums(pa.Table.from_batches(held).combine_chunks())


def _ends_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows ``key, low, ends`` sorted by the first two -> one digest per node."""
    now, digest = None, None
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        keys, shas = [], []
        for key, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if key != now:
                if now is not None:
                    keys.append(now)
                    shas.append(digest.hexdigest())
                now, digest = key, hashlib.sha256(ends.encode())
            else:
                digest.update(b"," + ends.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], schema=schema)
    if now is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], schema=schema)


def prefix_trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Nodes of the trie over ``turns`` (``conv_id, pos, key, words``; ``pos`` from 1, without
    gaps) of ``convs`` (``conv_id``, distinct; with or without turns): ``key`` (name of the
    node), ``parent`` (its parent's), ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``."""
    start = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("key"),
                         F.lit(0).cast("long").alias("words"))
    rows = turns.select("conv_id", "pos", "key", "words").unionByName(start)
    rows = rows.withColumn("seg", F.greatest(F.lit(0), F.floor((F.col("pos") - 1) / segment)).cast("int"))
    rows = rows.join(_entries(turns, segment), ["conv_id", "seg"], "left").select(
        "seg", "conv_id", "pos", "key", "words", F.coalesce("entry", F.lit(b"")).alias("entry"),
        F.coalesce("more", F.lit(False)).alias("more"))
    rows = rows.repartitionByRange("seg", "conv_id").sortWithinPartitions("seg", "conv_id", "pos")
    local = write_table(rows.mapInArrow(_shard_task(segment, shard_rows), _LOCAL_DDL), "local-tries")

    nodes = local.where("low IS NOT NULL").groupBy("key").agg(
        F.min("low").alias("conv_id"), F.sum("n").alias("n_convs"), F.first("parent").alias("parent"),
        F.first("depth").alias("depth"))
    # A segment's first nodes hang below a node of the segment before.
    kids = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = write_table(nodes.join(kids, "key", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes")

    known = nodes.select("key", "conv_id", (F.col("n_children") == 0).alias("leaf"))
    own = (F.col("low") == F.col("conv_id")) & F.col("low").isNotNull()
    mine = local.join(known, "key").select(
        "seg", "shard", "idx", "up", "end", "key", "conv_id", own.alias("own"),
        F.when(F.col("low").isNull(), 0).otherwise(F.col("words") * (F.col("n") - own.cast("long"))).alias("saved"),
        (own & F.col("leaf")).cast("long").alias("leaves"))
    levels = turns.agg(F.max("pos")).first()[0] or 0
    sums = None
    for seg in range(max(0, levels - 1) // segment, -1, -1):
        level = mine.where(F.col("seg") == seg)
        if sums is not None:
            # What hangs below this level's last nodes is added by their owners.
            hung = sums.where(F.col("seg") == seg + 1).select("key", F.col("saved").alias("s"), F.col("leaves").alias("l"))
            level = level.join(hung, "key", "left").withColumns({
                "saved": F.col("saved") + F.when(F.col("own"), F.coalesce("s", F.lit(0))).otherwise(0),
                "leaves": F.col("leaves") + F.when(F.col("own"), F.coalesce("l", F.lit(0))).otherwise(0)})
        level = level.repartition("shard").sortWithinPartitions("shard", "idx")
        level = level.select("shard", "idx", "up", "end", "key", "conv_id", "saved", "leaves").mapInArrow(
            _sum_task, "key binary, saved long, leaves long, parent_conv_id long")
        level = level.groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"),
                                         F.min("parent_conv_id").alias("parent_conv_id")).withColumn("seg", F.lit(seg))
        if levels > segment:
            level = write_table(level, f"sums-{seg}")
        sums = level if sums is None else sums.unionByName(level)
    # The node that leads to a segment is summed there and in its own segment; only the latter has its parent.
    sums = sums.join(nodes.select("key", "depth"), "key").where(
        F.col("seg") == F.floor(F.greatest(F.lit(0), F.col("depth") - 1) / segment)).drop("depth", "seg")
    ended = local.where("ends IS NOT NULL").select("key", "low", "ends").repartition("key").sortWithinPartitions("key", "low")
    ends = ended.mapInArrow(_ends_task, "key binary, ends_sha256 string")
    out = nodes.join(sums, "key").join(ends, "key", "left")
    return out.select("key", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", **options) -> DataFrame:
    """The trie of a table of turns as it is."""
    turns = write_table(numbered_turns(df, conv_col, turn_col, role_col, text_col), "numbered")
    return prefix_trie(turns, turns.where("pos = 1").select("conv_id"), **options)


def rebuilt_turns(turns: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of conversation
    ``c - c % every`` (``%`` truncates, as in SQL); h is the CRC-32 of c's decimal digits,
    unsigned, modulo ``heads``."""
    h = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % heads
    base = F.col("conv_id") - F.col("conv_id") % every
    first = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < heads))
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "key", "words"))).alias("first"))
    convs = turns.where("pos = 1").select("conv_id", base.alias("base"), h("conv_id").alias("h"))
    taken = convs.join(first, "base").select("conv_id", "h", F.explode("first").alias("x")).where("x.pos <= h")
    sizes = first.select("base", F.size("first").cast("long").alias("b"))
    own = turns.select("*", base.alias("base"), h("conv_id").alias("h")).where("pos > h").join(sizes, "base", "left")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.least("h", F.coalesce("b", F.lit(0)))).alias("pos"), "key", "words")
    return taken.select("conv_id", "x.pos", "x.key", "x.words").unionByName(own)


def rebuilt_trie(df: DataFrame, **options) -> DataFrame:
    turns = write_table(numbered_turns(df), "numbered")
    rebuilt = write_table(rebuilt_turns(turns), "rebuilt")
    return prefix_trie(rebuilt, turns.where("pos = 1").select("conv_id"), **options).drop("key", "parent")
