"""Conversation prefix trie: plain Python over whole sequences, segments, awkward rows."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from weir.llm import trie

KIND = "conv_id long, turn long, role string, text string"


def nodes_of(convs):
    """``convs``: id -> list of (role, text). All columns of the trie's nodes."""
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].split()) if p else 0
        saved[p] = own + sum(saved[k] for k in kids[p])
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def ordered(rows):
    convs = defaultdict(list)
    key = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    for c, t, r, x in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, key(r))):
        convs[c].append((r, x))
    return convs


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c / 20) * 20
        out[c] = convs.get(c - base, [])[:h] + turns[h:]
    return out


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(nodes):
    return sorted(tuple(r) for r in nodes.select(*COLS).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND)


def many():
    rows = []
    for c in range(230):
        for t in range(c % 7 + 1):
            rows.append((c, t, ["system", "user", "assistant"][t % 3], f"words {t} of {c % (t + 2)}" if c % 3 else f"hello\tthere {t}"))
    rows += [(c, t, "user", "copy of a copy") for c in range(1000, 1060) for t in range(4)]
    rows += [(5000, t, "user", f"long {t // 3}") for t in range(90)] + [(5001, t, "user", f"long {t // 3}") for t in range(70)]
    rows += [(5002, t, "user", f"long {t // 3}") for t in range(90)] + [(5003, t, "user", f"long {t // 3 if t < 65 else t}") for t in range(99)]
    return rows


@pytest.mark.parametrize("segment,shard_rows", [(4096, 16384), (4096, 20), (8, 50), (7, 1000), (1, 30)])
def test_equals_whole_sequences(spark, segment, shard_rows):
    rows = many()
    got = found(trie.conversation_trie(frame(spark, rows), segment=segment, shard_rows=shard_rows))
    assert got == nodes_of(ordered(rows))


def test_rebuilt_conversations(spark):
    rows = [r for r in many() if r[0] not in (40, 60)] + [(c, 0, "user", "short") for c in (-1, -25, -40, 7003, 7004, 7005, 10**18)]
    got = found(trie.rebuilt_trie(frame(spark, rows)))
    assert got == nodes_of(rebuilt(ordered(rows)))


def test_nulls_ties_repeats_and_empty_texts(spark):
    rows = [(1, None, None, None), (1, 0, "user", "b a"), (1, 0, "user", "a b c"), (1, 0, "user", "a b c"), (2, 5, "", ""),
            (2, 6, "user", "a b c"), (None, 0, "user", "lost"), (3, None, "us", "er x"), (4, None, "user", " x"), (5, 1, "user", None)]
    got = found(trie.conversation_trie(frame(spark, rows)))
    assert got == nodes_of(ordered(rows))
    # A node's names keep role and text apart.
    assert len([r for r in got if r[1] == 1]) == 4


def test_hot_conversation_and_numbering(spark, monkeypatch):
    """One conversation holds most rows: numbered in buckets, filed in segments."""
    monkeypatch.setattr(trie, "BUCKET", 16)
    rows = [(9, t * 3 - 50, "user", f"t{t % 5}") for t in range(500)] + [(c, t, "user", f"t{t % 5}") for c in (3, 4) for t in range(40)]
    got = found(trie.conversation_trie(frame(spark, rows), segment=64))
    assert got == nodes_of(ordered(rows))


def test_end_lists_pass_shard_borders(spark):
    rows = [(c, 0, "user", "same") for c in range(300)]
    got = found(trie.conversation_trie(frame(spark, rows), shard_rows=10))
    assert got == nodes_of(ordered(rows))


def test_empty_table_and_clashing_columns(spark):
    assert trie.conversation_trie(frame(spark, [])).collect() == []
    df = frame(spark, many()[:200])
    for c in ("key", "pos", "words", "seg", "entry", "more", "bucket", "n", "low", "depth", "parent"):
        df = df.selectExpr("*", f"'x' AS {c}")
    assert found(trie.conversation_trie(df)) == nodes_of(ordered(many()[:200]))
