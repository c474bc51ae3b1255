import datetime as dt
import random
import re

import pytest

from weir.functions.glob import glob_to_regex
from weir.operators.filters import exclude_paths
from weir.operators.joins import asof_join, prefix_anti_join
from weir.operators.patterns import literal_piece, matching_values

T0 = dt.datetime(2024, 1, 1)


def _brute(left, right, by):
    out = {}
    for seq, k, ts in left:
        best = None
        for rk, eff, n, val in right:
            if eff is not None and ts is not None and (not by or rk == k) and eff <= ts and (best is None or (eff, n) > best[0]):
                best = ((eff, n), val)
        out[seq] = best[1] if best else None
    return out


@pytest.mark.parametrize("by", [None, "k"])
@pytest.mark.parametrize("bucket", [60, 3600, 7])
def test_asof_against_brute_force(spark, by, bucket):
    """Null times and keys on both sides, ties of time, few and many right rows."""
    rnd = random.Random(7)
    at = lambda: None if rnd.random() < 0.05 else T0 + dt.timedelta(seconds=rnd.randint(0, 900) * 20)
    left = [(i, rnd.choice(["a", "b", None]), at()) for i in range(400)]
    for n_right in (0, 3, 700):
        right = [(rnd.choice(["a", "b", None]), at(), j, f"v{j}") for j in range(n_right)]
        got = asof_join(spark.createDataFrame(left, "seq long, k string, ts timestamp"),
                        spark.createDataFrame(right, "k string, eff timestamp, n long, val string"),
                        "ts", "eff", by=by, seq="n", bucket_seconds=bucket).collect()
        assert len(got) == len(left)
        assert {r.seq: r.val for r in got} == _brute(left, right, by)


def test_asof_keeps_one_version_a_time_and_halves_a_busy_bucket(spark):
    """Many versions of one time and many times in one bucket: no left row looks at all of them."""
    rnd = random.Random(3)
    at = lambda: T0 + dt.timedelta(milliseconds=rnd.randint(0, 200))
    left = [(i, "a", at()) for i in range(300)]
    right = [("a", at(), rnd.randint(0, 10**6) * 1000 + j if j % 9 else None, f"v{j}") for j in range(3000)]
    right += [("a", T0 + dt.timedelta(milliseconds=300), None, "last")]
    frames = (spark.createDataFrame(left, "seq long, k string, ts timestamp"),
              spark.createDataFrame(right, "k string, eff timestamp, n long, val string"))
    out = asof_join(*frames, "ts", "eff", seq="n")
    want = _brute(left, [(k, t, -1 if n is None else n, v) for k, t, n, v in right], None)
    assert {r.seq: r.val for r in out.collect()} == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" in plan and "filter(__in" not in plan


def test_asof_payload_may_hold_maps_and_clashing_names(spark):
    left = spark.createDataFrame([(1, T0, "left"), (2, None, "left")], "seq long, ts timestamp, val string")
    right = spark.createDataFrame([(T0, 1, {"a": 1}, "right"), (T0, None, {"b": 2}, "right")], "eff timestamp, n long, m map<string,long>, val string")
    got = {r.seq: (r.m, r.val) for r in asof_join(left, right, "ts", "eff", seq="n").collect()}
    assert got == {1: ({"a": 1}, "left"), 2: (None, "left")}


def test_asof_leaves_the_left_rows_where_they_are(spark):
    """A short history reaches the left rows by broadcast: none of their columns is moved."""
    left = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id", "CAST(ts AS timestamp) AS ts", "props")
    history = spark.createDataFrame([(T0, "a"), (T0 + dt.timedelta(days=3), "b")], "eff timestamp, val string")
    out = asof_join(left, history, "ts", "eff")
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    moved = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in final and len(moved) <= 3
    assert out.select("event_id", "props").where("val IS NULL").count() == 0


@pytest.mark.parametrize("whole", [True, False])
def test_pattern_index_against_each_pattern(spark, whole):
    rnd = random.Random(3)
    pieces = ["*", "?", "[a-c]", "[!b]", "a", "b", "ab", "/", ".log", "\\*", "[", "é", "[[:digit:]]", "1"]
    globs = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 5))) for _ in range(150)]
    values = ["".join(rnd.choice(["a", "b", "c", "/", ".log", "*", "[", "é", "1", "\n"]) for _ in range(rnd.randint(0, 7))) for _ in range(400)]
    globs = [g for g in globs if not re.fullmatch(r"[*?]*", g)]
    vals = spark.createDataFrame([(v,) for v in values + [None]], "v string")
    pats = spark.createDataFrame([(g,) for g in globs + [None]], "pattern string")
    rules = [re.compile(f"(?s:{glob_to_regex(g)})") for g in globs]
    want = {v for v in values if (any(r.fullmatch(v) for r in rules) if whole else any(v.startswith(g) for g in globs))}
    for chars in (4_000_000, 60):
        got = [r.v for r in matching_values(vals, "v", pats, whole, shard_chars=chars, parts=3).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_globs_without_wildcards_are_joined_and_not_indexed(spark):
    vals = [f"./a/u{i}.log" for i in range(300)] + ["./a/[x", "", None]
    pats = [f"./a/u{i}.log" for i in range(0, 300, 3)] + ["", "./a/[x", "*/u1?.log", None]
    out = matching_values(spark.createDataFrame([(v,) for v in vals], "v string"), "v",
                          spark.createDataFrame([(p,) for p in pats], "pattern string"), True)
    rules = [re.compile(f"(?s:{glob_to_regex(p)})") for p in pats if p is not None]
    want = sorted(v for v in vals if v is not None and any(r.fullmatch(v) for r in rules))
    assert sorted(r.v for r in out.collect()) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_many_wildcard_led_patterns_and_a_long_path(spark):
    """100,000 patterns that begin with a wildcard, and a path of 20 KB, each walked once."""
    long = "/x" * 10_000 + "/u77777.log"
    paths = spark.createDataFrame([(p,) for p in [long, "./view/u5.log", "./view/u100000.log", "./view/u.log", None]], "path string")
    pats = spark.range(100_000).selectExpr("concat('*/u', id, '.l?g') AS pattern")
    assert {r.path for r in exclude_paths(paths, pats).collect()} == {"./view/u.log", "./view/u100000.log", None}
    assert [r.path for r in exclude_paths(paths, pats.limit(0)).collect() if r.path] == [long, "./view/u5.log", "./view/u100000.log", "./view/u.log"]


@pytest.mark.parametrize("glob,piece", [("abc", ("abc", True)), ("*abc*d", ("abc", False)), ("ab*cde", ("cde", False)), ("a[xyz]bc", ("bc", False)),
                                        ("a[b", ("a[b", True)), ("\\*ab?", ("*ab", True)), ("*", ("", True)), ("[]a]xy", ("xy", False)), ("a\\", ("a\\", True))])
def test_literal_pieces(glob, piece):
    assert literal_piece(glob) == piece


def test_prefix_anti_join_any_length(spark):
    long = "/x" * 2500
    values = ["/var/log/a", "/var/log2", "/tmp/x", "/srv", "/v", "", None, long + "/tail", long, long[:-1]]
    paths = spark.createDataFrame([(p,) for p in values], "path string")
    prefixes = ["/var/log", "/tm", "/nothing/here", long, None]
    got = [r.path for r in prefix_anti_join(paths, "path", spark.createDataFrame([(p,) for p in prefixes], "prefix string")).collect()]
    want = [v for v in values if v is None or not any(p is not None and v.startswith(p) for p in prefixes)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    empty = spark.createDataFrame([("",)], "prefix string")
    assert [r.path for r in prefix_anti_join(paths, "path", empty).collect()] == [None]
    assert prefix_anti_join(paths, "path", empty.where("prefix = 'x'")).count() == len(values)


def test_exclusion_table_matches_list(spark):
    paths = [f"./d{i}/f{j}.log" for i in range(6) for j in range(3)] + ["./a[b", "x\ny", None, ""]
    df = spark.createDataFrame([(p,) for p in paths for _ in range(2)], "path string")
    globs = ["./d[0-3]/*0.log", "*/f2.log", "./d1/f0.log", "./a[[]b", "x?y", "*[z-a]*", "./d4/[!1]*"]
    table = spark.createDataFrame([(g,) for g in [*globs, None]], "pattern string")
    got = sorted((r.path for r in exclude_paths(df, table).collect()), key=repr)
    import fnmatch
    want = [p for p in paths for _ in range(2) if p is None or not any(fnmatch.fnmatchcase(p, g) for g in globs)]
    assert got == sorted(want, key=repr)
    listed = exclude_paths(df.where("path IS NOT NULL"), globs).collect()
    assert sorted(r.path for r in listed) == sorted(p for p in want if p is not None)
