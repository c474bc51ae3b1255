"""Encoders and decoders of the wire record.

An *event frame* carries the captured write plus its enrichment:
``seq, ts, prefix, path, buf, size, pid, uid, gid`` and optionally ``user,
group, cmdline, fields, tags, topic, encoder``. ``encode`` turns it into wire
records; ``decode`` turns wire records back into events. Both are single
projections: no shuffle, whole-stage codegen end to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.scalars import (
    b64decode,
    b64encode,
    iso_timestamp,
    nul_cut,
    utf8_repair,
    version_at_least,
    xor255,
)
from weir.session import once
from weir.schema import DEFAULT_ENCODER, EVENT_SCHEMA, EVENT_VERSION, MESSAGE_SIZE_KEY, OBFUSCATION_MARKER


def _lit_or_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def event_path(prefix="prefix", path="path") -> Column:
    """E5: the event path is the watched prefix followed by the path without its
    first character (``./a.log`` under ``/var/log`` -> ``/var/log/a.log``)."""
    return F.concat(F.col(prefix), F.substring(F.col(path), 2, 2147483647))


def message_bytes(buf="buf", size="size") -> Column:
    """The first ``size`` bytes of the written buffer, as BINARY."""
    return F.substr(F.col(buf).cast("binary"), F.lit(1), F.col(size).cast("int"))


def raw_message(buf="buf", size="size") -> Column:
    """What a raw encoder prints: the bytes up to ``size``, cut at the first NUL."""
    return nul_cut(message_bytes(buf, size).cast("string"))


def command_b64(cmdline="cmdline") -> Column:
    """J3 output form: NUL separators become spaces, then base64; '' when unknown."""
    return b64encode(F.coalesce(F.replace(F.col(cmdline), F.lit("\x00"), F.lit(" ")), F.lit("")))


def _with_defaults(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    add = {}
    if "user" not in cols:
        add["user"] = F.lit("")
    if "group" not in cols:
        add["group"] = F.lit("")
    if "cmdline" not in cols:
        add["cmdline"] = F.lit("")
    if "fields" not in cols:
        add["fields"] = F.create_map().cast("map<string,string>")
    if "tags" not in cols:
        add["tags"] = F.array().cast("array<string>")
    return df.withColumns(add) if add else df


def event_struct(df_cols_b64: Column) -> Column:
    """The twelve keys, in wire order; ``@message`` is given by the caller."""
    return F.struct(
        event_path().alias("path"),
        F.col("pid").cast("int").alias("pid"),
        F.col("uid").cast("int").alias("uid"),
        F.col("gid").cast("int").alias("gid"),
        df_cols_b64.alias("@message"),
        iso_timestamp("ts").alias("@timestamp"),
        F.coalesce(F.col("user"), F.lit("")).alias("user"),
        F.coalesce(F.col("group"), F.lit("")).alias("group"),
        command_b64("cmdline").alias("command"),
        F.lit(EVENT_VERSION).alias("@version"),
        F.coalesce(F.col("fields"), F.create_map().cast("map<string,string>")).alias("@fields"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("@tags"),
    )


def encoder_kind(encoder: Column) -> Column:
    """'logstash_base64' | 'logstash' | 'text' | null (unsupported)."""
    return (F.when(encoder.startswith("logstash_base64"), F.lit("logstash_base64"))
            .when(encoder.startswith("logstash"), F.lit("logstash"))
            .when(encoder == "text", F.lit("text")))


def encode_marked(df: DataFrame, encoder=DEFAULT_ENCODER, keep=("seq",)) -> DataFrame:
    """E1-E4 + F5 as one frame: ``keep`` + ``topic`` (when present) + ``encoder`` +
    ``value`` BINARY (the wire bytes, XOR-255 obfuscated when the encoder name holds
    the marker) + ``reason``: null, or why the row must not be sent (``value`` null).

    ``encoder`` is a name or a Column (per-row encoder from a config join).
    """
    df = _with_defaults(df)
    enc = _lit_or_col(encoder)
    kind = F.col("__kind")
    # All twelve keys are on the wire, null values included.
    json_b64 = F.to_json(event_struct(b64encode(message_bytes())), {"ignoreNullFields": "false"})
    json_raw = F.to_json(event_struct(raw_message()), {"ignoreNullFields": "false"})
    text = F.format_string("%s: %s: %s", iso_timestamp("ts"), F.col("path"), raw_message())
    plain = (F.when(kind == "logstash_base64", json_b64)
             .when(kind == "logstash", json_raw)
             .when(kind == "text", text)).cast("binary")
    value = F.when(F.col("__enc").contains(OBFUSCATION_MARKER), xor255(plain)).otherwise(plain)
    keep = [c for c in keep if c in df.columns]
    extra = ["topic"] if "topic" in df.columns else []
    staged = df.withColumn("__kind", encoder_kind(enc)).withColumn("__enc", enc)
    reason = F.when(kind.isNull(), F.concat(F.lit("unsupported encoder: "), F.coalesce(F.col("__enc"), F.lit("null"))))
    return staged.select(*keep, *extra, F.col("__enc").alias("encoder"),
                         F.when(kind.isNotNull(), value).alias("value"), reason.alias("reason"))


def encode(df: DataFrame, encoder=DEFAULT_ENCODER, keep=("seq",)):
    """E1-E4 + F5. Returns ``(good, dead_letters)`` of ``encode_marked``.

    ``good``: ``keep`` columns + ``topic`` (when present) + ``value``.
    ``dead_letters``: ``keep`` columns + ``encoder`` + ``reason`` for rows whose
    encoder is not supported; they are never sent.
    """
    marked = encode_marked(df, encoder, keep)
    keep = [c for c in keep if c in df.columns]
    extra = ["topic"] if "topic" in df.columns else []
    good = marked.where(F.col("reason").isNull()).select(*keep, *extra, "value")
    return good, marked.where(F.col("reason").isNotNull()).select(*keep, "encoder", "reason")


def deobfuscate(value="value") -> Column:
    """Wire bytes whose first byte is not '{' are XOR-255 obfuscated."""
    v = F.col(value).cast("binary") if isinstance(value, str) else value.cast("binary")
    return F.when(F.substr(v, F.lit(1), F.lit(1)) == F.lit(bytearray(b"{")), v).otherwise(xor255(v))


def _decoded(c: Column, gate: Column) -> Column:
    # D3 + D4: base64-decode when the version allows it, then repair UTF-8.
    return utf8_repair(F.when(gate, b64decode(c)).otherwise(c.cast("binary")))


_BAD = "__bad"


def is_json_object(text: Column) -> Column:
    """Is the text one JSON object and nothing else (blanks around it aside)?

    Wrapped in an array it must count as one element, and it must begin and end
    like an object; a text that closes the array itself must also be the one
    member of an object. No value is built.
    """
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    alone = F.json_object_keys(F.concat(F.lit('{"r":'), text, F.lit("}"))) == F.array(F.lit("r"))
    shape = text.rlike(r"\A\s*\{") & text.rlike(r"\}\s*\z")
    return F.coalesce(shape & one & (~text.rlike(r"\}\s*\]\s*,") | alone), F.lit(False))


def decode(df: DataFrame, value="value", keep=(), version_gate=True, columns=None):
    """D1-D6. Returns ``(events, dead_letters)``.

    A record is an event if its text is one JSON object (nothing after it) whose
    integer, map and list keys hold such values; missing keys are null.
    ``events``: ``keep`` + ``columns``: by default the twelve keys and
    ``message_size-added`` (bytes of the decoded message); any other name is read
    from the object as text. Only the keys that are asked for (and those whose type
    is checked) are parsed. ``dead_letters``: ``keep`` + ``value`` (text) + ``reason``.

    With ``version_gate`` (the bus consumer) the base64 fields are decoded only
    when ``@version`` >= 0.1.2; without it (the console consumer) always.
    """
    columns = list(columns) if columns is not None else [*EVENT_SCHEMA.names, MESSAGE_SIZE_KEY]
    known = {f.name: f.dataType for f in EVENT_SCHEMA.fields}
    base64_keys = {"@message", "command", MESSAGE_SIZE_KEY}
    read = [n for n, t in known.items() if t != T.StringType() or n in columns
            or n == "@message" and MESSAGE_SIZE_KEY in columns
            or n == "@version" and version_gate and base64_keys & set(columns)]
    read += [c for c in columns if c not in known and c != MESSAGE_SIZE_KEY]
    schema = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in dict.fromkeys(read)]
                          + [T.StructField(_BAD, T.StringType())])

    staged = once(df.select(*keep, utf8_repair(deobfuscate(value)).alias("__text")))
    # Only texts that are an object are parsed: a parser failure per bad record is
    # costly and the answer (dead letter) is the same.
    parsed = F.when(is_json_object(F.col("__text")), F.from_json("__text", schema, {"columnNameOfCorruptRecord": _BAD}))
    staged = once(staged.select(*keep, "__text", parsed.alias("__e")))
    e = F.col("__e")
    ok = e.isNotNull() & e[_BAD].isNull()
    gate = version_at_least(e["@version"], "0.1.2") if "@version" in schema.names and version_gate else F.lit(True)

    def column(name: str) -> Column:
        if name in ("@message", MESSAGE_SIZE_KEY):
            raw = F.when(gate, b64decode(e["@message"])).otherwise(e["@message"].cast("binary"))
            return utf8_repair(raw) if name == "@message" else F.octet_length(raw).cast("int")
        return _decoded(e[name], gate) if name == "command" else e[name]

    events = staged.where(ok).select(*keep, *[column(n).alias(n) for n in columns])
    dead = staged.where(~ok).select(
        *keep, F.col("__text").alias("value"),
        F.when(e.isNull(), F.lit("not a JSON event")).otherwise(F.lit("a key of another type")).alias("reason"))
    return events, dead


def select_fields(df: DataFrame, names: str) -> DataFrame:
    """Keep the whitespace-separated field names that exist, in the order
    given; unknown names are ignored."""
    wanted = names.split()
    present = [n for n in wanted if n in df.columns]
    return df.select(*[F.col(f"`{n}`") for n in dict.fromkeys(present)])


def render_event(df: DataFrame, keys=None, out="text") -> DataFrame:
    """Readable rendering. Scalars as ``  key: value``; a map as the key line
    then ``     name: value`` lines; a list as ``    -  item`` lines."""
    schema = {f.name: f.dataType for f in df.schema.fields}
    keys = [k for k in (keys or df.columns) if k in schema]
    parts = [F.lit("event:")]
    for k in keys:
        c = F.col(f"`{k}`")
        dt = schema[k]
        if isinstance(dt, T.MapType):
            entries = F.transform(F.map_entries(c), lambda x: F.concat(
                F.lit("     "), x["key"], F.lit(": "), F.coalesce(x["value"].cast("string"), F.lit("None"))))
            parts.append(F.concat_ws("\n", F.lit(f"  {k}: "), F.array_join(entries, "\n")))
        elif isinstance(dt, T.ArrayType):
            # "    -  item" lines with one native array_join (no per-element lambda).
            items = (F.when(c.isNull(), F.lit(None).cast("string"))
                     .when(F.size(c) > 0, F.concat(F.lit("    -  "),
                                                   F.array_join(c.cast("array<string>"), "\n    -  ")))
                     .otherwise(F.lit("")))
            parts.append(F.concat_ws("\n", F.lit(f"  {k}: "), items))
        else:
            parts.append(F.concat(F.lit(f"  {k}: "), F.coalesce(c.cast("string"), F.lit("None"))))
    return df.withColumn(out, F.concat_ws("\n", *parts))


def render_report(df: DataFrame, out="line") -> DataFrame:
    """K4: ``<@timestamp> <path>: <@message>`` report lines of decoded events."""
    return df.withColumn(out, F.concat(F.col("`@timestamp`"), F.lit(" "), F.col("path"), F.lit(": "),
                                       F.col("`@message`")))
