from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from weir.functions import (b64decode, b64encode, djb2, glob_to_regex, globs_to_regex, iso_timestamp,
                            pairs_to_map, path_join, ruby_to_i, version_at_least)

# Golden values of the reference's own tests.
BASE64 = [
    ("", ""),
    ("0", "MA=="),
    ("1", "MQ=="),
    ("42", "NDI="),
    ("hello, world", "aGVsbG8sIHdvcmxk"),
    ("sit amet, consectetur adipiscing elit. Aenean ut gravida.",
     "c2l0IGFtZXQsIGNvbnNlY3RldHVyIGFkaXBpc2NpbmcgZWxpdC4gQWVuZWFuIHV0IGdyYXZpZGEu"),
    ("sit amet, consectetur adipiscing elit. Aenean ut gravida",
     "c2l0IGFtZXQsIGNvbnNlY3RldHVyIGFkaXBpc2NpbmcgZWxpdC4gQWVuZWFuIHV0IGdyYXZpZGE="),
]


def test_base64_golden(spark):
    df = spark.createDataFrame(BASE64, "s string, want string")
    got = df.select("want", b64encode("s").alias("got")).collect()
    assert all(r.got == r.want for r in got)


def test_base64_no_line_breaks_whatever_the_session_says(spark):
    spark.conf.set("spark.sql.chunkBase64String.enabled", "true")
    try:
        long = "x" * 300
        got = spark.range(1).select(b64encode(F.lit(long)).alias("b")).first().b
        assert "\r" not in got and "\n" not in got and len(got) == 400
    finally:
        spark.conf.set("spark.sql.chunkBase64String.enabled", "false")


def test_base64_decode_tolerant(spark):
    df = spark.createDataFrame([("bXkgbWVzc2FnZQ==",), ("bXkgbWVzc2FnZQ",), ("bXkgbWVzc2FnZQ====",),
                                ("not base64!",)], "s string")
    got = [r.d for r in df.select(b64decode("s").cast("string").alias("d")).collect()]
    assert got[:3] == ["my message"] * 3
    assert got[3] is None


def test_djb2_golden(spark):
    got = spark.range(1).select(djb2(F.lit("hello world")).alias("h"), djb2(F.lit("")).alias("e"),
                                djb2(F.lit("é")).alias("u"), djb2(F.lit("a\x00b")).alias("z")).first()
    assert got.h == Decimal(13876786532495509697)
    assert got.e == Decimal(5381)
    assert got.u == Decimal((5381 * 33 + 0xC3) * 33 + 0xA9)      # bytes, not characters
    assert got.z == Decimal(5381 * 33 + ord("a"))                   # stops at NUL


def test_path_join(spark):
    got = spark.range(1).select(path_join(F.lit("lol"), F.lit("xd")).alias("a"),
                                path_join(F.lit(None).cast("string"), F.lit("xd")).alias("b")).first()
    assert got.a == "lol/xd" and got.b is None


def test_iso_timestamp(spark):
    got = spark.range(1).select(iso_timestamp(F.lit("2024-01-01 00:00:07.179575").cast("timestamp")).alias("t")).first()
    assert got.t == "2024-01-01T00:00:07.179+0000"


@pytest.mark.parametrize("pattern,path,hit", [
    ("*.log", "/var/log/a.log", True),          # '*' crosses '/'
    ("*.log", ".hidden.log", True),             # leading dot not special
    ("/var/?og/*", "/var/log/x", True),
    ("[abc]*", "b/x", True),
    ("[!abc]*", "b/x", False),
    ("[^abc]*", "d", True),
    ("[a-c]x", "bx", True),
    ("a\\*b", "a*b", True),                     # backslash escapes
    ("a\\*b", "axxb", False),
    ("a[b", "a[b", True),                       # unmatched '[' is literal
    ("[]]", "]", True),
    ("[[:digit:]]*", "7up", True),
    ("excluded", "excluded", True),
    ("excluded", "test", False),
    ("a.b", "axb", False),                      # '.' is literal
    ("(x)|y", "(x)|y", True),
])
def test_glob(spark, pattern, path, hit):
    df = spark.createDataFrame([(path,)], "p string")
    got = df.select(F.col("p").rlike(globs_to_regex([pattern])).alias("m")).first().m
    assert got == hit, glob_to_regex(pattern)


def test_version_gate(spark):
    df = spark.createDataFrame([("0.1.1",), ("0.1.2",), ("0.1.6",), ("0.2",), ("x.1",), (None,)], "v string")
    got = [r.ok for r in df.select(version_at_least("v", "0.1.2").alias("ok")).collect()]
    assert got == [False, True, True, True, False, False]


def test_ruby_to_i(spark):
    df = spark.createDataFrame([("12",), ("12ab",), ("ab",), ("-3",), ("69}",), ("99999999999999999999",), ("9" * 39,), (None,)],
                               "s string")
    got = [r.n for r in df.select(ruby_to_i("s").alias("n")).collect()]
    assert got == [12, 12, 0, -3, 69, 99999999999999999999, None, None]


def test_pairs_to_map_last_wins(spark):
    got = spark.range(1).select(pairs_to_map(F.array(*[F.lit(x) for x in "a 1 b 2 a 3 c".split()])).alias("m")).first().m
    assert got == {"a": "3", "b": "2"}


def test_split_lines_edges(spark):
    from weir.sources.lines import split_lines

    df = spark.createDataFrame([("a", "x\ny"), ("b", "x\n"), ("c", ""), ("d", "\n\nz"), ("e", "é\nü")],
                               "path string, text string")
    got = sorted((r.path, r.line_no, r.offset, r.nbytes, r.message) for r in split_lines(df).collect())
    assert got == [("a", 0, 0, 2, "x\n"), ("a", 1, 2, 1, "y"),
                   ("b", 0, 0, 2, "x\n"),
                   ("d", 0, 0, 1, "\n"), ("d", 1, 1, 1, "\n"), ("d", 2, 2, 1, "z"),
                   ("e", 0, 0, 3, "é\n"), ("e", 1, 3, 2, "ü")]


def test_tail_cut_inside_character(spark):
    from weir.sources.lines import tail_from_offsets

    files = spark.createDataFrame([("/f", "aé\nb\n")], "path string, text string")
    offsets = spark.createDataFrame([("/f", 2)], "path string, offset long")   # inside 'é'
    lines, new = tail_from_offsets(files, offsets)
    got = sorted((r.offset, r.nbytes, r.message) for r in lines.collect())
    assert got == [(2, 2, "�\n"), (4, 2, "b\n")]
    assert new.first().offset == 6


def test_xor255_every_byte(spark):
    from weir.functions import xor255

    df = spark.createDataFrame([(bytearray(range(256)),), (bytearray(b""),), (None,)], "v binary")
    got = [r.x for r in df.select(xor255("v").alias("x")).collect()]
    assert bytes(got[0]) == bytes(255 - i for i in range(256))
    assert bytes(got[1]) == b"" and got[2] is None


def test_watch_scope_roots(spark):
    from weir.sources import lines

    paths = ["/a/1", "/a/b/2", "/a/b/c/3", "/ab/4", "/x/5", "/a/b/6", None]
    files = spark.createDataFrame([(p, "x\n") for p in paths], "path string, text string")
    for roots in ([], ["/a"], ["/a", "/a/b", "/x/", "/"], [f"/r{i}" for i in range(30)] + ["/a/b"]):
        for rec in (True, False):
            want = [(r, p) for r in roots for p in paths if p and p.startswith(r.rstrip("/") + "/")
                    and (rec or "/" not in p[len(r.rstrip("/")) + 1:])]
            got = [(r.prefix, r.path) for r in lines.watch_scope(files, roots, rec).collect()]
            assert sorted(got) == sorted(want), (roots, rec)
