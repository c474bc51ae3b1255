"""Column expressions for encoding, hashing, time and text handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row however often the body
    reads it (a lambda variable; a plain reuse would copy the expression)."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _to_binary(c: Column) -> Column:
    # STRING -> its UTF-8 bytes; BINARY stays BINARY (cast is a no-op then).
    return c.cast("binary")


def b64encode(c) -> Column:
    """Padded base64 of the bytes, no line breaks, whatever the session's
    ``spark.sql.chunkBase64String.enabled`` says."""
    from pyspark.sql import SparkSession

    encoded = F.base64(_to_binary(_col(c)))
    spark = SparkSession.getActiveSession()
    chunked = True
    if spark is not None:
        chunked = spark.conf.get("spark.sql.chunkBase64String.enabled", "true").lower() == "true"
    if chunked:
        encoded = F.regexp_replace(encoded, "[\r\n]", "")
    return encoded


def b64decode(c) -> Column:
    """Tolerant base64 decode to BINARY. Missing padding is accepted (so is a
    surplus one, which is trimmed first); anything undecodable gives null."""
    return F.try_to_binary(F.regexp_replace(_col(c), "=+$", ""), F.lit("base64"))


def djb2(c) -> Column:
    """64-bit unsigned djb2 over the UTF-8 bytes, stopping at the first NUL,
    returned as DECIMAL(20,0). The bytes are split into an array once (read as
    Latin-1 characters) and ``h = h * 33 + byte`` is folded in two 32-bit halves of
    BIGINT, which never overflow."""
    chars = F.decode(_to_binary(F.substring_index(_col(c), "\x00", 1)), "ISO-8859-1")
    codes = F.filter(F.split(chars, ""), lambda x: x != "")
    low = F.lit((1 << 32) - 1).cast("bigint")
    start = F.struct(F.lit(0).cast("bigint").alias("hi"), F.lit(5381).cast("bigint").alias("lo"))

    def step(acc, ch):
        lo = acc["lo"] * 33 + F.ascii(ch)
        return F.struct((acc["hi"] * 33 + F.shiftright(lo, 32)).bitwiseAND(low).alias("hi"),
                        lo.bitwiseAND(low).alias("lo"))

    two32 = F.lit(1 << 32).cast("decimal(20,0)")
    return F.aggregate(codes, start, step, lambda acc: (acc["hi"].cast("decimal(20,0)") * two32
                                                        + acc["lo"].cast("decimal(20,0)")).cast("decimal(20,0)"))


def ts_micros(c) -> Column:
    """Microseconds since the epoch, for TIMESTAMP columns."""
    return F.unix_micros(_col(c).cast("timestamp"))


def iso_timestamp(c) -> Column:
    """C4: ``yyyy-MM-ddTHH:mm:ss.SSS+HHMM`` in the session time zone."""
    return F.date_format(_col(c).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSZ")


def path_join(a, b) -> Column:
    """``a/b``; null when either side is null."""
    return F.concat(_col(a), F.lit("/"), _col(b))


def pairs_to_map(c) -> Column:
    """Flat ``[k1, v1, k2, v2, ...]`` to a map. A repeated key keeps its last
    value (as a JSON reader would for a repeated object key); an odd trailing
    key is dropped."""
    def to_map(arr):
        n = F.floor(F.size(arr) / 2).cast("int")
        entries = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
            F.try_element_at(arr, i * 2 + 1).alias("key"), F.try_element_at(arr, i * 2 + 2).alias("value")))
        last_only = let(entries, lambda es: F.filter(es, lambda e, i: ~F.exists(
            F.slice(es, i + 2, F.greatest(n, F.lit(1))), lambda x: x["key"] == e["key"])))
        return F.when(n <= 0, F.create_map().cast("map<string,string>")).otherwise(F.map_from_entries(last_only))

    return let(_col(c), to_map)


# Byte b read as the Latin-1 character chr(b), mapped to chr(255 - b). translate()
# deletes characters mapped to NUL, so 0xFF goes through a placeholder first.
_XOR_SRC = "".join(chr(i) for i in range(256))
_XOR_DST = "".join(chr(255 - i) for i in range(255)) + "\u0100"


def xor255(c) -> Column:
    """Every byte XOR 255, as BINARY. Native and byte-exact: the bytes are
    read as Latin-1 characters (one per byte), translated, and written back."""
    as_chars = F.decode(_to_binary(_col(c)), "ISO-8859-1")
    flipped = F.replace(F.translate(as_chars, _XOR_SRC, _XOR_DST), F.lit("\u0100"), F.lit("\x00"))
    return F.encode(flipped, "ISO-8859-1")


def nul_cut(c) -> Column:
    """A C string stops at the first NUL."""
    return F.substring_index(_col(c), "\x00", 1)


def utf8_repair(c) -> Column:
    """Bytes (or a string holding raw bytes) to valid UTF-8, invalid
    sequences replaced by U+FFFD."""
    return F.make_valid_utf8(_col(c).cast("string"))


def ruby_to_i(c) -> Column:
    """Integer prefix of a string, like Ruby's ``to_i``: optional sign and
    leading digits after leading white space; 0 when there are none. DECIMAL(38,0),
    since such integers have no largest; more than 38 digits give null, never 0."""
    digits = F.regexp_extract(_col(c), r"^\s*([+-]?[0-9]+)", 1)
    return F.when(digits == "", F.lit(0).cast("decimal(38,0)")).otherwise(digits.try_cast("decimal(38,0)"))


def version_at_least(c, minimum) -> Column:
    """True when the dotted version string is >= ``minimum`` (e.g. "0.1.2").
    Parts are compared as integers, lexicographically (``0.2`` > ``0.1.2`` >
    ``0.1``); a version with a non-numeric part is never >= anything. Native
    expressions only: a pattern check, a cast of the split parts to
    ``array<int>`` and an array comparison."""
    col = F.col(c) if isinstance(c, str) else c
    numeric = col.rlike(r"^[0-9]{1,9}(\.[0-9]{1,9})*$")
    parts = F.split(col, r"\.").cast("array<int>")
    want = F.array(*[F.lit(int(p)) for p in minimum.split(".")])
    return F.coalesce(F.when(numeric, parts >= want), F.lit(False))
