"""Streams in event time against their batch operators, under random batch splits."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from weir.operators.backlog import bounded_backlog, drain
from weir.operators.delivery import missing_ranges
from weir.operators.enrich import with_config
from weir.operators.quota import flag_overflow, rate_limit_bounded
from weir.sinks import register_sink, write_routed
from weir.streaming.event_time import live_config, rate_limit_bounded_stream, rate_limit_event_time, spool_until_ready, with_config_stream
from weir.streaming.gaps import missing_ranges_stream

T0 = dt.datetime(2024, 1, 1)
WRITES = "seq long, prefix string, path string, ts timestamp, size long, buf binary, m map<string,long>"
END = 10**6          # seconds: far behind all rows


def at(seconds):
    return (T0 + dt.timedelta(seconds=seconds)).isoformat(timespec="microseconds")


def write(seq, sec, path="a", size=10, prefix="/p"):
    return {"seq": seq, "prefix": prefix, "path": path, "ts": None if sec is None else at(sec), "size": size, "buf": "//4=",
            "m": {"k": seq}}


def files(folder, batches):
    """One file a micro-batch, in order."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        name = os.path.join(folder, f"b{i:03d}.json")
        with open(name, "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in rows)
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))


def stream(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)


def run(df, scratch, name="q", out=None):
    out = out or os.path.join(scratch, f"out-{name}")
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", os.path.join(scratch, f"ck-{name}")) \
        .trigger(availableNow=True).start()
    assert q.awaitTermination(240)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def split(rows, rng, n, disorder):
    """Rows in batches, each row up to ``disorder`` seconds out of order."""
    rows = sorted(rows, key=lambda r: (dt.datetime.fromisoformat(r["ts"]) - T0).total_seconds() + rng.random() * disorder)
    cuts = sorted(rng.randrange(len(rows)) for _ in range(n - 1))
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)]) if a < b]


def closing(k, make=write):
    """Rows that move the watermark behind everything else."""
    return [[make(-1 - i, END + 1000 * i)] for i in range(k)]


def batch(spark, rows, schema=WRITES):
    path = spark.sparkContext.parallelize([json.dumps(r) for r in rows], 2)
    return spark.read.schema(schema).json(path)


def real(df):
    return df.where(f"seq >= 0 AND ts < timestamp'{at(END - 1)}'")


@pytest.mark.parametrize("seed", [1, 2])
def test_quota_equals_batch_for_any_split(spark, scratch, seed):
    rng = random.Random(seed)
    rows = [write(i, rng.choice([i * 0.7, round(i * 0.7)]), rng.choice(["a", "b", "hot", "hot"]), rng.choice([5, 40, 400, None])) for i in range(160)]
    files(f"{scratch}/in", split(rows, rng, 6, 20) + closing(3))
    got = real(run(rate_limit_event_time(stream(spark, f"{scratch}/in", WRITES), 42, delay="25 seconds", keep_dropped=True), scratch))
    want = flag_overflow(batch(spark, rows), 42)
    assert got.where("late").count() == 0
    cols = ["seq", "path", "ts", "size", "overflow", "prefix"]
    assert sorted(map(repr, got.select(*cols).collect())) == sorted(map(repr, want.select(*cols).collect()))
    # Every column comes back as it was.
    assert got.select("seq", "buf", "m").where(f"buf = X'FFFE' AND m['k'] = seq").count() == 160


def test_late_and_untimed_rows_go_to_their_sink(spark, scratch):
    files(f"{scratch}/in", [[write(1, 0), write(2, 100)], [write(3, 200)], [write(4, 50), write(5, None), write(6, 190.5)]] + closing(3))
    out = rate_limit_event_time(stream(spark, f"{scratch}/in", WRITES), 1e9, delay="30 seconds")
    seen = {"late": [], "kept": []}
    for name in seen:
        register_sink(f"et-{name}", lambda d, _, name=name: seen[name].extend(r.seq for r in d.collect() if r.seq > 0))
    q = write_routed(out, {"late": "et-late", "on time": "et-kept"}, F.when(F.col("late"), "late").otherwise("on time"),
                     f"{scratch}/ck", {"availableNow": True})
    assert q.awaitTermination(240)
    assert sorted(seen["late"]) == [4, 5] and sorted(seen["kept"]) == [1, 2, 3, 6]


def test_a_route_without_a_sink_ends_the_stream(spark, scratch):
    files(f"{scratch}/in", [[write(1, 0)]])
    register_sink("only", lambda d, _: d.count())
    q = write_routed(stream(spark, f"{scratch}/in", WRITES), {"x": "only"}, F.lit("y"), f"{scratch}/ck", {"availableNow": True})
    with pytest.raises(Exception, match="no sink for route"):
        q.awaitTermination(120)


@pytest.mark.parametrize("seed", [3, 4])
def test_tracker_equals_batch_for_any_split(spark, scratch, seed):
    rng = random.Random(seed)
    rows = [write(i, i * 0.5, rng.choice("abcdefg") if i % 3 else None, rng.choice([1, 200]), rng.choice(["/p", "/q", None])) for i in range(200)]
    files(f"{scratch}/in", split(rows, rng, 6, 10) + closing(3))
    got = real(run(rate_limit_bounded_stream(stream(spark, f"{scratch}/in", WRITES), 100, max_tracked=3, delay="15 seconds"), scratch))
    want = rate_limit_bounded(batch(spark, rows), 100, max_tracked=3)
    assert sorted((r.seq, r.overflow) for r in got.collect()) == sorted((r.seq, r.overflow) for r in want.collect())


def version(seq, sec, topic):
    return {"no": seq, "effective_from": at(sec), "topic": topic}


VERSIONS = "no long, effective_from timestamp, topic string"


@pytest.mark.parametrize("order", ["early", "late"])
def test_config_in_force_equals_batch(spark, scratch, order):
    rng = random.Random(7)
    rows = [write(i, i * 0.5, rng.choice("abcd")) for i in range(120)]
    versions = [version(1, 10, "t1"), version(2, 25.25, "t2"), version(3, 25.25, "t3"), version(4, 50, "t4")]
    # Early: all at once, before the rows; late: each well after its time, inside the watermark.
    control = [versions] if order == "early" else [[], [versions[2], versions[0]], [versions[1]], [versions[3]]]
    files(f"{scratch}/v", control + [[version(9, END * 2, "never")]])
    files(f"{scratch}/in", split(rows, rng, 4, 5) + closing(3))
    out = with_config_stream(stream(spark, f"{scratch}/in", WRITES), stream(spark, f"{scratch}/v", VERSIONS), version_seq="no",
                             delay="90 seconds", shards=3)
    got = real(run(out, scratch))
    want = with_config(batch(spark, rows), batch(spark, versions, VERSIONS), seq="no")
    assert sorted((r.seq, r.topic or "", r.no or 0) for r in got.collect()) == sorted((r.seq, r.topic or "", r.no or 0) for r in want.collect())


def test_a_version_behind_the_watermark_holds_from_then_on(spark, scratch):
    rows = [write(i, i * 10) for i in range(20)]
    files(f"{scratch}/in", [rows[:10], rows[10:12], rows[12:]] + closing(3))
    files(f"{scratch}/v", [[version(2, 15, "new")], [], [version(1, 5, "old"), version(3, 16, "newest")]])
    out = with_config_stream(stream(spark, f"{scratch}/in", WRITES), stream(spark, f"{scratch}/v", VERSIONS), version_seq="no",
                             delay="1 second", shards=1)
    got = {r.seq: r.topic for r in real(run(out, scratch)).collect()}
    assert got[0] is None and got[2] == "new" and got[19] == "newest" and "old" not in got.values()


def status(sec, **said):
    return {"ts": at(sec), "ready": None, "excludes": None, "quota": None, "sleep_dirs": None, "active": None, **said}


STATUS = "ts timestamp, ready boolean, excludes array<string>, quota double, sleep_dirs array<string>, active boolean"


@pytest.mark.parametrize("seed", [5, 6])
def test_backlog_equals_batch_drain(spark, scratch, seed):
    """Closed for 60 s, then opened with filters of that moment: backlog first, then live rows."""
    rng = random.Random(seed)
    rows = [write(i, i * 0.5, rng.choice(["a", "b", "c.tmp"]), rng.choice([1, 100])) for i in range(240)]
    files(f"{scratch}/in", split(rows, rng, 7, 8) + closing(3))
    files(f"{scratch}/s", [[status(60, ready=True, excludes=["*.tmp"], quota=100)]])
    out = spool_until_ready(stream(spark, f"{scratch}/in", WRITES), stream(spark, f"{scratch}/s", STATUS), n=50,
                            delay="70 seconds", shards=1)
    got = real(run(out, scratch))
    df = batch(spark, rows)
    closed, live = df.where(f"ts < timestamp'{at(60)}'"), df.where(f"ts >= timestamp'{at(60)}'")
    want = drain(bounded_backlog(closed, 50), live, ["*.tmp"], 100)
    assert sorted(r.seq for r in got.collect()) == sorted(r.seq for r in want.collect())
    order = [r.seq for r in got.orderBy("place").collect()]
    assert order == [r.seq for r in want.orderBy("ts", "seq").collect()]
    assert got.where("replayed").count() == want.where(f"ts < timestamp'{at(60)}'").count() > 0
    assert {r.sent_at for r in got.where("replayed").select("sent_at").distinct().collect()} == {T0 + dt.timedelta(seconds=60)}


def simulate(rows, said, n):
    """The gate, row by row."""
    ready, queue, out = False, [], []
    for r in sorted([*rows, *said], key=lambda r: (r["ts"], "seq" in r, r.get("seq", 0))):
        if "seq" in r:
            (out if ready else queue).append(r["seq"])
            del queue[:-n]
        elif r["ready"] is not None:
            if r["ready"] and not ready:
                out += queue
                queue.clear()
            ready = r["ready"]
    return out


def test_gate_through_restarts(spark, scratch):
    """Stopped and started while closed and while open: nothing is lost or doubled."""
    rng = random.Random(11)
    rows = [write(i, i * 0.5) for i in range(300)]
    said = [status(s, ready=r) for s, r in ((20, True), (40, False), (90, True), (91, False), (120, True))]
    parts = split(rows, rng, 9, 4) + closing(3)
    out = f"{scratch}/out"
    for k, upto in enumerate((2, 5, 8, len(parts))):
        files(f"{scratch}/in", parts[:upto])
        files(f"{scratch}/s", [said])
        df = spool_until_ready(stream(spark, f"{scratch}/in", WRITES), stream(spark, f"{scratch}/s", STATUS), n=40, delay="30 seconds", shards=1)
        got = run(df, scratch, out=out)
    assert [r.seq for r in real(got).orderBy("place").collect()] == simulate(rows, said, 40)


def test_live_configuration_filters_by_event_time(spark, scratch):
    rows = [write(i, i, ["a.log", "b.tmp"][i % 2], 10, ["/var/x", "/srv"][i // 2 % 2]) for i in range(40)]
    files(f"{scratch}/in", split(rows, random.Random(1), 3, 5) + closing(3))
    said = [{**status(0), "topic": "t0"}, {**status(10, excludes=["*.tmp"]), "topic": "t1"},
            {**status(20, excludes=[], sleep_dirs=["/var/../var/"], active=True), "topic": "t2"}, {**status(30, active=False), "topic": "t3"}]
    said = [{"effective_from": s.pop("ts"), **s} for s in said]
    files(f"{scratch}/v", [said])
    schema = STATUS.replace("ts timestamp", "effective_from timestamp") + ", topic string"
    out = live_config(stream(spark, f"{scratch}/in", WRITES), stream(spark, f"{scratch}/v", schema), delay="60 seconds", shards=2)
    got = sorted((r.seq, r.topic) for r in real(run(out, scratch)).collect())
    want = [(i, f"t{i // 10}") for i in range(40) if not (10 <= i < 20 and i % 2 or 20 <= i < 30 and i // 2 % 2 == 0)]
    assert got == want


IDS = "id long, sender string, ts timestamp"


def sent(i, sec, sender="s"):
    return {"id": i, "sender": sender, "ts": at(sec)}


@pytest.mark.parametrize("seed", [8, 9])
def test_gaps_equal_batch_for_any_split(spark, scratch, seed):
    rng = random.Random(seed)
    lost = set(rng.sample(range(400), 90)) | set(range(200, 230)) | {0, 1, 399}
    rows = [sent(i, i * 0.5) for i in range(400) if i not in lost] + [sent(5, 2.5), sent(77, 38.5)]
    files(f"{scratch}/in", split(rows, rng, 7, 15) + [[sent(400, END)], [sent(401, END + 9999)], [sent(402, END + 99999)]])
    got = run(missing_ranges_stream(stream(spark, f"{scratch}/in", IDS), delay="20 seconds"), scratch)
    want = missing_ranges(batch(spark, rows, IDS).where(f"id NOT IN ({', '.join(map(str, lost))})"), 400)
    assert sorted((r.first, r.last) for r in got.collect() if r.first < 400) == sorted(map(tuple, want.collect()))
    assert not got.where("late").count()


def test_late_ids_correct_an_emitted_gap(spark, scratch):
    files(f"{scratch}/in", [[sent(0, 0), sent(9, 9, "s"), sent(3, 3, "other")], [sent(10, 500), sent(4, 500, "other")], [sent(11, 1000)],
                            [sent(3, 3), sent(4, 4), sent(9, 9), sent(20, 1001)], [sent(6, 6), sent(21, 5000)], [sent(22, 9000)]])
    got = run(missing_ranges_stream(stream(spark, f"{scratch}/in", IDS), by=["sender"], delay="20 seconds"), scratch)
    s = sorted((r.first, r.last, r.late) for r in got.collect() if '"s"' in r.key)
    assert (1, 8, False) in s and (3, 4, True) in s and (6, 6, True) in s and not [r for r in s if r[:2] == (9, 9)]
    assert (0, 2, False) in [(r.first, r.last, r.late) for r in got.collect() if '"other"' in r.key]


def test_capture_live_encodes_by_the_version_of_each_event(spark, scratch):
    from weir.operators.codec import decode
    from weir.schema import WRITE_SCHEMA
    from weir.streaming.pipeline import capture_live

    rows = [{"seq": i, "ts": at(i), "prefix": "/p", "path": ["a.log", "b.tmp"][i % 2], "buf": "aGk=", "size": 2, "offset": 0, "pid": 1,
             "uid": 0, "gid": 0} for i in range(30)]
    end = [[{**rows[0], "seq": -1, "ts": at(END + k * 1000)}] for k in range(3)]
    files(f"{scratch}/in", split(rows, random.Random(2), 3, 4) + end)
    said = [{"effective_from": at(0), "topic": "t0", "tags": ["x"], "fields": {"dc": "eu"}},
            {"effective_from": at(10), "topic": "t1", "encoder": "csv"},
            {"effective_from": at(20), "encoder": "logstash_base64", "excludes": ["*.tmp"], "fields": {"dc": "us"}}]
    files(f"{scratch}/v", [said])
    versions = stream(spark, f"{scratch}/v", "effective_from timestamp, topic string, tags array<string>, fields map<string,string>, "
                                             "encoder string, excludes array<string>")
    users = spark.createDataFrame([(0, "root")], "uid int, name string")
    out = capture_live(stream(spark, f"{scratch}/in", WRITE_SCHEMA), versions, users, delay="60 seconds", shards=2)
    got = run(out, scratch).where("seq >= 0")
    rejected = got.where("reason IS NOT NULL")
    assert {(r.seq, r.reason) for r in rejected.collect()} == {(i, "unsupported encoder: csv") for i in range(10, 20)}
    events, dead = decode(got.where("reason IS NULL"), keep=["seq", "topic"])
    assert dead.count() == 0
    sent = {r.seq: (r.topic, r["@tags"], r["@fields"], r.user, r["@message"]) for r in events.collect()}
    assert sorted(sent) == [*range(10), *range(20, 30, 2)]
    assert sent[3] == ("t0", ["x"], {"dc": "eu"}, "root", "hi") and sent[20] == ("logs", [], {"dc": "us"}, "root", "hi")
