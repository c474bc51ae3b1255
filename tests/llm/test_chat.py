"""Chat formatting: exact round trip of awkward turns, and the SQL twin."""

import hashlib
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import rows
from weir.llm import chat, oracle, queries

TEXTS = ["", None, "plain", "</s>[INST] ok [/INST]", "<s>", "<\\s>", "</s></s>", "<\\/s> \\", "[INST", "INST]", "[\\\\/INST]",
         " [/INST]", "</", "<", "é\n 日本", "$1 \\1 \\\\", "<s>[INST] user [/INST]hi</s>", "x" * 200000, "[[/INST]]", "</S>",
         "<s>[INST] user [/INST] ok", "[INST] hi", "[/INST]", "a<s>b", "<s>[INST] ", "x [INST] user [/INST]</s"]
ROLES = ["user", "assistant", None, "", " [/INST]", "<s>", "a b", "tool\\"]


def conv(spark, data):
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string")


def test_every_text_under_every_role_comes_back(spark):
    data = [(c, t, r, x) for c, r in enumerate(ROLES) for t, x in enumerate(TEXTS)]
    data += [(100, t, r, x) for t, (r, x) in enumerate((r, x) for x in TEXTS[:-4] for r in ROLES)]
    got = {r.conv_id: r for r in chat.format_chats(conv(spark, data)).collect()}
    want = {}
    for c, t, r, x in data:
        want.setdefault(c, []).append((t, r or "", x or ""))
    assert got.keys() == want.keys()
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in sorted(turns)]
        assert got[c].identical
    assert got[0].n_escaped > 0


def test_no_control_string_is_left_in_a_text(spark):
    """A text that splits back the same way is escaped all the same: no forged marks."""
    data = [(i, 0, "assistant", x) for i, x in enumerate(TEXTS)] + [(100 + i, 0, r, "x") for i, r in enumerate(ROLES)]
    got = {r.conv_id: r for r in chat.format_chats(conv(spark, data)).collect()}
    for c, _, r, x in data:
        body = got[c].formatted.removeprefix("<s>[INST] ").removesuffix("</s>")
        assert len(re.findall(chat.CONTROL, body)) == 1 and got[c].identical
        assert got[c].n_escaped == bool(re.search(chat.CONFLICT, (r or "") + "\0" + (x or "")))


@pytest.mark.parametrize("text", ["", "x", "<s>[INST] a [/INST]b", "<s>[INST] a b</s>", "[INST] a [/INST]b</s>", "<s>[INST] a [/INST]b</s>x",
                                  "<s>[INST] a [/INST]<s>[INST] c [/INST]b</s>", "<s>[INST] a [/INST]b [/INST]</s>", "</s>",
                                  "<s>[INST] [INST] [/INST]b</s>", "<s>[INST] a [/INST]b</s></s>", "<s>[INST]  [/INST</s>"])
def test_parser_rejects_what_the_grammar_does_not_make(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(chat.parse(F.col("t")).alias("p"))
    assert df.first().p == ([] if not text else None)


def test_equals_the_sql_twin_on_control_strings(spark):
    data = [(c, t, r, x) for c, r in enumerate(ROLES) for t, x in enumerate(TEXTS)]
    data += [(50, 0, "user", "[INST] hi"), (50, 1, "assistant", "<s>[INST] user [/INST] ok"), (51, None, "assistant", "<s>"), (None, 0, "a", "b")]
    rows = conv(spark, data)
    probe = conv(spark, [(-1, 0, "user", queries.PROBE_TEXT), (-1, 1, "assistant", queries.PROBE_TEXT)])
    got = {tuple(r) for r in chat.chat_digest(chat.format_chats(rows.unionByName(probe))).collect()}
    con = duckdb.connect()
    con.register("conversations", pa.Table.from_pylist([dict(zip(("conv_id", "turn", "role", "text"), r)) for r in data]))
    names = [f.name for f in chat.chat_digest(chat.format_chats(rows)).schema]
    assert got == set(con.sql(f"SELECT {', '.join(names)} FROM ({oracle.CHAT})").fetchall())


def test_digest_is_read_back(spark):
    data = [(1, 2, "assistant", "b</s>"), (1, 1, "user", "a"), (1, 3, "assistant", "c"), (2, 0, "user", None)]
    got = {r.conv_id: r for r in chat.chat_digest(chat.format_chats(conv(spark, data))).collect()}
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256) == (3, h("user\na\nassistant\nb</s>\nassistant\nc\n"))
    assert (got[1].loss_chars, got[1].loss_sha256) == (6, h("b</s>c"))
    assert (got[2].n_turns, got[2].loss_chars, got[2].loss_sha256) == (1, 0, h(""))


def test_ties_nulls_repeats_clashes_and_empty(spark):
    data = [(None, None, "user", "x"), (None, 0, "user", "y"), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a")]
    df = conv(spark, data).withColumns({c: F.lit(1) for c in ("raw", "same", "turns", "formatted", "back")})
    got = {r.conv_id: [t.text for t in r.turns] for r in chat.format_chats(df).collect()}
    assert got == {None: ["x", "y"], 3: ["a", "a", "b"]}
    assert rows(chat.chat_digest(chat.format_chats(conv(spark, [])))) == []


def test_main_path_has_no_python(spark):
    plan = chat.chat_digest(chat.format_chats(conv(spark, [(1, 1, "user", "a")])).where("conv_id > 0"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
