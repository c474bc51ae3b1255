import datetime as dt

from pyspark.sql import functions as F

from weir.operators.backlog import bounded_backlog, drain, route_ready
from weir.operators.config import merge_config, merge_servers, normalize_path, unique_paths, watch_diff
from weir.operators.delivery import missing_ranges
from weir.sources.config import load_config, parse_args

T0 = dt.datetime(2024, 1, 1)


def test_backlog_cap_keeps_newest_in_order(spark):
    df = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=i), p) for i, p in enumerate("abcd")],
                               "seq long, ts timestamp, path string")
    got = [r.path for r in bounded_backlog(df, 2).orderBy("ts", "seq").collect()]
    assert got == ["c", "d"]


def test_drain_replays_backlog_first_through_filters(spark):
    mk = lambda rows: spark.createDataFrame(
        [(s, T0 + dt.timedelta(seconds=t), p, 1) for s, t, p in rows], "seq long, ts timestamp, path string, size long")
    backlog = mk([(1, 0, "./a"), (2, 1, "./skip.log")])
    live = mk([(3, 2, "./a"), (4, 2, "./a")])
    got = [r.seq for r in drain(backlog, live, ["*.log"], quota=10, ordered=True).collect()]
    assert got == [1, 3]


def test_route_ready(spark):
    ev = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(seconds=5)), (3, T0 + dt.timedelta(seconds=9))],
                               "seq long, ts timestamp")
    st = spark.createDataFrame([(T0 + dt.timedelta(seconds=1), True), (T0 + dt.timedelta(seconds=8), False)],
                               "ts timestamp, ready boolean")
    ok, wait = route_ready(ev, st)
    assert [r.seq for r in ok.collect()] == [2]
    assert sorted(r.seq for r in wait.collect()) == [1, 3]


def test_unique_paths(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("b", 2), ("/x/../a/", 3)], "dir string, ord long")
    got = sorted((r.dir, r.ord) for r in unique_paths(df).collect())
    assert got == [("a", 0), ("b", 2)]
    got = spark.range(1).select(normalize_path(F.lit("//var/./log/../tmp/"), "/").alias("n")).first().n
    assert got == "/var/tmp"


def test_merge_servers_add_once_sequence(spark):
    # The reference's add-once sequence: blah new, blah old, blah,foo new, foo old,
    # foo,blah old, empty new, NULL not added.
    known = []
    results = []
    for incoming in ["blah", "blah", "blah,foo", "foo", "foo,blah", "", None]:
        row = spark.createDataFrame([(known, incoming)], "k array<string>, i string")
        merged, new = merge_servers("k", "i")
        r = row.select(merged.alias("m"), new.alias("n")).first()
        results.append(r.n)
        known = r.m
    assert results == [True, False, True, False, False, True, False]


def test_watch_diff_prefix(spark):
    conf = spark.createDataFrame([("/var/log2",), ("/tmp",), ("/srv",)], "dir string")
    watched = spark.createDataFrame([("/var/log",), ("/old",)], "dir string")
    start, stop = watch_diff(conf, watched)
    assert sorted(r.dir for r in start.collect()) == ["/srv", "/tmp"]
    assert sorted(r.dir for r in stop.collect()) == ["/old", "/var/log"]


def test_watch_diff_normalises_both_lists(spark):
    conf = spark.createDataFrame([("/var//log/./a/",), ("/var/log/a",), ("srv/x",), ("/srv/../srv/x",), (None,)], "dir string")
    watched = spark.createDataFrame([("/var/log/a/.",), ("/gone//",)], "dir string")
    start, stop = watch_diff(conf, watched)
    assert [r.dir for r in start.collect()] == ["/srv/x"]
    assert [r.dir for r in stop.collect()] == ["/gone"]


def test_sharded_backlog_any_size_and_order(spark):
    df = spark.range(5000).select(F.col("id").alias("seq"), (F.col("id") % 3).alias("k"),
                                  F.timestamp_seconds(F.col("id") % 700).alias("ts"))
    rows = [(r.k, r.ts, r.seq) for r in df.collect()]
    for n in (7, 1200, 10_000):
        got = sorted((r.k, r.ts, r.seq) for r in bounded_backlog(df, n, shard="k").collect())
        want = [x for k in range(3) for x in sorted((r for r in rows if r[0] == k), reverse=True)[:n]]
        assert got == sorted(want)


def test_prefixes_are_compared_normalised(spark):
    from weir.operators.filters import apply_sleep, exclude_prefixes

    paths = ["/var//log/./click/u1", "/var/log/click", "/var/log2", "var/log/x", None, "/tmp"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    for prefixes in (["/var/./log//", "/var/log/"], spark.createDataFrame([("/var/./log//",), (None,)], "prefix string")):
        got = [r.path for r in exclude_prefixes(df, prefixes).collect()]
        assert sorted(got, key=repr) == sorted(["/tmp", None], key=repr)  # a plain string prefix: /var/log2 goes too
    asleep = apply_sleep(df, ["/var/log/click/"], F.col("path").isNotNull(), col="path")
    assert sorted((r.path for r in asleep.collect()), key=repr) == sorted(["/tmp", "/var/log2", "var/log/x", None], key=repr)


ARGS = ("--topic logs --fields site rack-7 --directories /usr/local/tomcat1/logs "
        "--brokers server:9092 --tags orders --persist no --excluded_files blah --substitutions lol")


def test_parse_args(spark):
    df = spark.createDataFrame([(1, ARGS), (2, "--colour"), (3, "-colour"), (4, "--zookeepers  test "),
                                (5, "--tags a b --tags c")], "id long, line string")
    got = {(r.id, r.key): (r.ok, r["values"]) for r in parse_args(df, keep=("id",)).collect()}
    assert got[(1, "fields")] == (True, ["site", "rack-7"])
    assert got[(1, "substitutions")] == (True, ["lol"])
    assert got[(2, None)][0] is False
    assert not any(k[0] == 3 for k in got)        # '-colour' is a value without option: ignored
    assert got[(4, "zookeepers")] == (True, ["test"])
    assert got[(5, "tags")] == (True, ["c"])      # a repeated option replaces


def test_load_and_merge_config(spark):
    lines = spark.createDataFrame([
        ("f1", 1, 'agent_directories=["/a", "/b"]'),
        ("f1", 2, 'agent_fields={"hostname": "test", "dc": "x"}'),
        ("f1", 3, '#agent_directories=["/c"]'),
        ("f2", 1, 'agent_directories=["/d"]'),
        ("f2", 2, 'monitoring_logging_tags=["t"]'),
        ("f2", 3, 'agent_quota=[500000]'),
        ("f2", 4, 'other=["x"]'),
    ], "file string, line_no long, line string")
    e = load_config(lines)
    merged = {}
    for r in sorted(merge_config(e).collect(), key=lambda r: (r.key, r.pos)):
        assert r.pos == len(merged.setdefault(r.key, []))
        merged[r.key].append(r.value)
    assert merged == {"directories": ["/a", "/b", "/d"], "fields": ["hostname", "test", "dc", "x"],
                      "tags": ["t"], "quota": ["500000"]}


def test_missing_ranges(spark):
    rec = spark.createDataFrame([(i,) for i in [0, 1, 4, 5, 9, 12, 40]], "id long")
    got = sorted(tuple(r) for r in missing_ranges(rec, n=15, block=4).collect())
    assert got == [(2, 3), (6, 8), (10, 11), (13, 14)]
    sent = spark.range(15).agg(F.count("*").alias("n"))
    assert sorted(tuple(r) for r in missing_ranges(rec, expected=sent, block=4).collect()) == got
    twice = rec.unionByName(rec).unionByName(spark.createDataFrame([(None,), (-3,)], "id long"))
    assert sorted(tuple(r) for r in missing_ranges(twice, n=15, block=4).collect()) == got
    empty = spark.createDataFrame([], "id long")
    assert missing_ranges(empty, n=0).count() == 0
    assert [tuple(r) for r in missing_ranges(empty, n=3).collect()] == [(0, 2)]


def test_compare_captures_multiset(spark):
    from weir.operators.delivery import compare_captures

    a = spark.createDataFrame([("p", "x"), ("p", "x"), ("p", "y"), ("q", "z")], "path string, message string")
    b = spark.createDataFrame([("p", "x"), ("p", "w"), ("r", "v")], "path string, message string")
    got = {r.path: (r.n_a, r.n_b, r.only_a, r.only_b) for r in compare_captures(a, b).collect()}
    want = {}
    for k in ("p", "q", "r"):
        ea = a.where(f"path = '{k}'").exceptAll(b).count()
        eb = b.where(f"path = '{k}'").exceptAll(a).count()
        want[k] = (a.where(f"path = '{k}'").count(), b.where(f"path = '{k}'").count(), ea, eb)
    assert got == want == {"p": (3, 2, 2, 1), "q": (1, 0, 1, 0), "r": (0, 1, 0, 1)}


def test_between_markers_rules(spark):
    from weir.operators.filters import between_markers

    rows = [
        ("p1", 1, "x"), ("p1", 2, "START"), ("p1", 3, "a"), ("p1", 4, "START"), ("p1", 5, "b"),
        ("p1", 6, "STOP"), ("p1", 7, "c"),                       # a, b kept; markers and c dropped
        ("p2", 1, "a"), ("p2", 2, "b"),                          # never started: nothing
        ("p3", 1, "STOP"), ("p3", 2, "START"), ("p3", 3, "d"),   # stopped before the start: nothing
        ("p4", 1, "START"), ("p4", 2, "e"),                      # no stop: to the end
        (None, 1, "x"), (None, 2, "START"), (None, 3, "n"), (None, 4, "STOP"), (None, 5, "x"),  # a partition like others
        ("p5", 1, "START"), ("p5", 2, None), ("p5", 3, "STOP"),  # an unknown message is no marker
    ]
    df = spark.createDataFrame(rows, "part string, seq long, msg string")
    kept = between_markers(df, F.col("msg") == "START", F.col("msg") == "STOP", "part", order_by=("seq",))
    got = sorted(((r.part or "", r.msg or "") for r in kept.collect()))
    assert kept.columns == df.columns
    assert got == [("", "n"), ("p1", "a"), ("p1", "b"), ("p4", "e"), ("p5", "")]


def test_normalize_path_edges(spark):
    import posixpath

    cases = ["/../a", "/a/./b/../../c", "rel/x/", "/", "//double//slash", "/a/b/..", "/a/b", "/a/", "/.", "/..", "/a/.b/..c/d..", "/a\nb/c.", ".",
             "/a/..", "/...", "/a//", "/é/日"]
    df = spark.createDataFrame([(c,) for c in cases], "p string")
    got = [r.n for r in df.select(normalize_path("p", "/srv").alias("n")).collect()]
    want = [posixpath.normpath(posixpath.join("/srv", c)).replace("//", "/") for c in cases]
    assert got == want
