"""Operator 1, chat formatting: grammar round trip (DataFrame functions only).

Grammar of the rendered text (``role`` and ``text`` free of control strings)::

    conversation := turn*
    turn         := "<s>[INST] " role " [/INST]" text "</s>"

Every turn is rendered as it is and reparsed; a turn that does not come back
identical is rendered again with its conflicting content escaped. The parser accepts the
grammar and nothing else: a mark at any place but its own, a missing head or text behind
the last end mark makes it give no turns at all, so a turn that merely happens to split
the same way is not identical. Escaping puts one backslash into each control string, and
one more into each control string that already holds some (``</s>`` -> ``<\\/s>``,
``<\\/s>`` -> ``<\\\\/s>``); the parser takes one away, so escaping is a bijection and one
escaped round always suffices. No control string can straddle a turn's borders, because each opens
with a character that occurs nowhere else in it. The rendered conversation is
parsed as a whole, and every figure below is read back from it.

Defined cases: null role or text counts as empty; turns are ordered by ``turn``
(nulls first), ties and repeated rows by their rendered text, all kept; rows with
a null conv_id form one conversation; an empty table gives no rows; other
columns are ignored, whatever their names. A conversation's rendered text is one
string by definition, so one conversation is limited by Spark's 2 GB per value;
rendering, reparsing and escaping run per row before the grouping, and only the
rendered turn is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOS, EOS = "<s>", "</s>"
ROLE_OPEN, ROLE_CLOSE = "[INST] ", " [/INST]"
#: A control string as it stands, and one with the backslashes it may hold already.
CONTROL = r"</?s>|\[/?INST\]"
CONFLICT = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
LOSS_ROLE = "assistant"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, CONFLICT, r"$1\\$2$3")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, ESCAPED, "$1$2$3")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BOS + ROLE_OPEN), role, F.lit(ROLE_CLOSE), text, F.lit(EOS))


def parse(formatted: Column) -> Column:
    """Deterministic parser: ``array<struct<role, text>>`` of a rendered text, null for a
    text outside the grammar."""
    segments = F.split(formatted, EOS, -1)
    # The last segment is what follows the last end mark: nothing.
    turns = F.slice(segments, F.lit(1), F.size(segments) - 1)

    def halves(seg: Column) -> tuple[Column, Column]:
        body = F.substr(seg, F.lit(len(BOS + ROLE_OPEN) + 1))
        role = F.substring_index(body, ROLE_CLOSE, 1)
        return role, F.substr(body, F.length(role) + F.lit(len(ROLE_CLOSE) + 1))

    def in_grammar(seg: Column) -> Column:
        role, text = halves(seg)
        closed = F.length(seg) >= F.length(role) + F.lit(len(BOS + ROLE_OPEN + ROLE_CLOSE))
        return seg.startswith(BOS + ROLE_OPEN) & closed & ~role.rlike(CONTROL) & ~text.rlike(CONTROL)

    def turn(seg: Column) -> Column:
        role, text = halves(seg)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    whole = (F.element_at(segments, -1) == "") & F.forall(turns, in_grammar)
    return F.when(whole, F.transform(turns, turn))


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``turns`` as parsed back
    from ``formatted``, ``n_rows`` source turns, ``n_escaped`` turns that needed
    escaping and ``identical`` (every turn came back equal to its source)."""
    q = lambda c: F.col(f"`{c}`")
    rows = df.select(q(conv_col).alias("conv_id"), q(turn_col).alias("turn"),
                     F.coalesce(q(role_col), F.lit("")).alias("role"),
                     F.coalesce(q(text_col), F.lit("")).alias("text"))
    source = F.array(F.struct(F.col("role"), F.col("text")))
    rows = rows.withColumn("raw", render(F.col("role"), F.col("text")))
    rows = rows.withColumn("same", parse(F.col("raw")).eqNullSafe(source))
    rows = rows.withColumn("turn_text", F.when(F.col("same"), F.col("raw")).otherwise(
        render(escape(F.col("role")), escape(F.col("text")))))
    rows = rows.withColumn("back", F.col("same") | parse(F.col("turn_text")).eqNullSafe(source))
    convs = rows.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "turn_text"))),
                                 lambda x: x["turn_text"]), "").alias("formatted"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum((~F.col("same")).cast("long")).alias("n_escaped"),
        F.min("back").alias("back"))
    convs = convs.withColumn("turns", parse(F.col("formatted")))
    return convs.select("conv_id", "formatted", "turns", "n_rows", "n_escaped",
                        F.coalesce(F.col("back") & (F.size("turns") == F.col("n_rows")), F.lit(False)).alias("identical"))


def chat_digest(chats: DataFrame) -> DataFrame:
    """Digest columns of ``format_chats``, all read back from the rendered text."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == LOSS_ROLE),
                                    lambda t: t["text"]), "")
    return chats.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "identical")
