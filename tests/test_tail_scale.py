"""The tail source with a manifest, roots that change, batch reads of files, and the outbox."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from weir.sinks.outbox import committed, read_outbox, vacuum_outbox, write_outbox
from weir.sources.manifest import Listing, Manifest, ManifestReader, next_roots, tail_batch
from weir.sources.tail import tail_stream


def append(path, data, mode="ab"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode) as f:
        f.write(data)


def run(df, scratch):
    q = df.writeStream.format("parquet").option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/ck").start()
    q.processAllAvailable()
    return q


def got(spark, scratch):
    rows = spark.read.parquet(f"{scratch}/out").collect()
    return sorted((os.path.relpath(r.path, scratch), r.offset, bytes(r.message).decode()) for r in rows)


def reader(scratch, **options):
    return ManifestReader({"manifestPath": f"{scratch}/m", "startingOffsets": "earliest", **options})


def test_roots_are_reread_while_the_stream_runs_and_after_a_restart(spark, scratch):
    a, b, table = f"{scratch}/a/x.log", f"{scratch}/b/y.log", f"{scratch}/roots.txt"
    append(a, b"a0\n")
    append(b, b"b0\n")
    append(table, f"{scratch}/a\n".encode(), "wb")
    opts = {"manifestPath": f"{scratch}/m", "rootsPath": table}
    q = run(tail_stream(spark, [], **opts), scratch)
    try:
        append(a, b"a1\n")
        q.processAllAvailable()
        append(table, f"{scratch}/a/\n{scratch}/b\n{scratch}/b/deeper\n".encode(), "wb")   # b starts at its end
        q.processAllAvailable()
        append(b, b"b1\n")
        append(f"{scratch}/b/new.log", b"n0\n")                                             # created later: from 0
        q.processAllAvailable()
        append(table, f"{scratch}/b\n".encode(), "wb")                                      # a stops
        q.processAllAvailable()
        append(a, b"a2\n")
        append(b, b"b2\n")
        q.processAllAvailable()
    finally:
        q.stop()
    append(table, f"{scratch}/b\n{scratch}/c\n".encode(), "wb")
    append(f"{scratch}/c/z.log", b"z0\n")
    append(b, b"b3\n")
    q = run(tail_stream(spark, [], **opts), scratch)
    try:
        append(f"{scratch}/c/z.log", b"z1\n")
        append(a, b"a3\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert got(spark, scratch) == [("a/x.log", 3, "a1\n"), ("b/new.log", 0, "n0\n"), ("b/y.log", 3, "b1\n"), ("b/y.log", 6, "b2\n"),
                                   ("b/y.log", 9, "b3\n"), ("c/z.log", 3, "z1\n")]
    assert {bool(r.prefix) for r in spark.read.parquet(f"{scratch}/out").collect()} == {True}


def test_next_roots():
    assert next_roots(["/a", "/b"], ["/b", "/b/c", "/ab", "/a2"]) == ["/b", "/ab", "/a2"]
    assert next_roots([], ["/a", "/a"]) == ["/a"]


def test_roots_from_a_table(spark, scratch):
    spark.createDataFrame([(f"{scratch}/a",), (None,), (f"{scratch}/a/../a",)], "dir string").write.parquet(f"{scratch}/roots")
    append(f"{scratch}/a/x", b"1\n")
    r = reader(scratch, rootsPath=f"{scratch}/roots")
    assert r.latestOffset() == {"v": 1, "epoch": 0} and r.roots == [f"{scratch}/a"]


def test_offsets_are_small_and_a_trigger_plans_what_changed(scratch):
    for i in range(300):
        append(f"{scratch}/w/d{i % 7}/f{i}", b"12345678\n" * 3)
    r = reader(scratch, path=f"{scratch}/w")
    first = r.latestOffset()
    assert len(json.dumps(first)) < 100 and len(r.partitions(r.initialOffset(), first)) == 300
    assert r.latestOffset() == first                                  # nothing changed: no new version
    append(f"{scratch}/w/d1/f1", b"new\n")
    os.remove(f"{scratch}/w/d2/f2")
    second = r.latestOffset()
    assert second["v"] == first["v"] + 1
    assert [(os.path.basename(p.path), p.lo, p.hi) for p in r.partitions(first, second)] == [("f1", 27, 31)]
    assert os.path.getsize(f"{scratch}/m/d-{second['v']:012d}.json") < 500
    again = reader(scratch, path=f"{scratch}/w")                      # a restart goes on from the log
    append(f"{scratch}/w/d1/f1", b"x", "wb")                          # truncated meanwhile
    third = again.latestOffset()
    assert [(os.path.basename(p.path), p.lo, p.hi) for p in again.partitions(second, third)] == [("f1", 0, 1)]
    assert [(p.lo, p.hi) for p in again.partitions(first, second)] == [(27, 31)]


def test_cap_holds_from_the_first_batch_and_across_restarts(scratch):
    for name in "abc":
        append(f"{scratch}/w/{name}", b"123456789\n" * 20)
    opts = {"path": f"{scratch}/w", "maxBytesPerTrigger": "30"}
    seen = []
    for _ in range(3):
        r = reader(scratch, **opts)
        start = r.initialOffset() if not seen else seen[-1]
        seen.append(r.latestOffset())
        assert sum(p.hi - p.lo for p in r.partitions(start, seen[-1])) == 30


def test_snapshots_replace_old_versions(scratch, monkeypatch):
    from weir.sources import manifest

    monkeypatch.setattr(manifest, "SNAPSHOT_EVERY", 4)
    r = reader(scratch, path=f"{scratch}/w")
    for i in range(20):
        append(f"{scratch}/w/f{i % 3}", b"line\n")
        r.commit(r.latestOffset())
    log = Manifest(f"{scratch}/m")
    assert len(log.numbers("d")) <= 9 and len(log.numbers("s")) <= 3
    assert log.load() == r.state and r.state["v"] == 20


def test_cold_files_are_looked_at_in_turns(scratch):
    for i in range(400):
        append(f"{scratch}/w/f{i}", b"x\n")
    old = time.time() - 100
    li = Listing(True, cold_seconds=50)
    li.scan([f"{scratch}/w"])
    li.grew = dict.fromkeys(li.sizes, old)
    li.last -= 5                                                      # 5 of 50 seconds: a tenth of the files
    for p in (f"{scratch}/w", ):
        os.utime(p, (old, old))
    append(f"{scratch}/w/f7", b"more\n")
    sizes = li.scan([f"{scratch}/w"])
    assert len(sizes) == 400 and li.looked < 60
    for _ in range(12):
        li.last -= 5
        sizes = li.scan([f"{scratch}/w"])
    assert sizes[f"{scratch}/w/f7"] == 7                              # found within its turn
    append(f"{scratch}/w/sub/new", b"n\n")
    assert f"{scratch}/w/sub/new" in li.scan([f"{scratch}/w"])        # a new directory at once


def test_batch_read_of_files_with_offsets(spark, scratch):
    lines = [f"line {i} {'x' * (i % 17)}\n" for i in range(500)]
    append(f"{scratch}/w/a.log", "".join(lines).encode() + b"part")
    append(f"{scratch}/w/in/b.log", b"b0\nb1\n")
    one, offsets = tail_batch(spark, f"{scratch}/w", whole_lines=True, splitBytes=100)
    append(f"{scratch}/w/a.log", b"ial\nmore\n")                      # behind the ends that were fixed
    rows = one.orderBy("path", "offset").collect()
    assert [bytes(r.message).decode() for r in rows] == [*lines, "b0\n", "b1\n"]
    assert one.rdd.getNumPartitions() > 50
    append(f"{scratch}/w/in/b.log", b"B\n", "wb")
    two, offsets2 = tail_batch(spark, [f"{scratch}/w"], offsets, whole_lines=True)
    assert sorted((os.path.basename(r.path), r.offset, bytes(r.message)) for r in two.collect()) == [
        ("a.log", sum(map(len, lines)), b"partial\n"), ("a.log", sum(map(len, lines)) + 8, b"more\n"), ("b.log", 0, b"B\n")]
    assert tail_batch(spark, f"{scratch}/w", offsets2, whole_lines=True)[0].count() == 0
    flat, _ = tail_batch(spark, f"{scratch}/w", recursive=False)
    assert {os.path.basename(r.path) for r in flat.select("path").distinct().collect()} == {"a.log"}
    assert tail_batch(spark, f"{scratch}/none")[0].count() == 0


def test_filters_decide_before_a_file_is_opened(spark, scratch):
    append(f"{scratch}/w/a.log", b"a\n")
    append(f"{scratch}/w/b.log", b"b\n")
    append(f"{scratch}/v/c.log", b"c\n")
    for p in ("w/b.log", "v/c.log"):
        os.remove(f"{scratch}/{p}")
        os.mkfifo(f"{scratch}/{p}")                                   # reading it would block
    df, _ = tail_batch(spark, [f"{scratch}/w", f"{scratch}/v"])
    # A pipe is no regular file and is not listed; name it as a file whose bytes are due.
    ends = df.sparkSession.read.format("tail")
    folder = f"{scratch}/ends"
    append(f"{folder}/part.json", b"".join(json.dumps({"path": f"{scratch}/{p}", "offset": 2}).encode() + b"\n"
                                           for p in ("w/a.log", "w/b.log", "v/c.log")))
    ends = ends.option("path", f"{scratch}/w,{scratch}/v").option("endsPath", folder).load()
    for cond in (F.col("path") == f"{scratch}/w/a.log", F.col("path").isin(f"{scratch}/w/a.log", "x"), F.col("path").startswith(f"{scratch}/w/a"),
                 (F.col("prefix") == f"{scratch}/w") & F.col("path").startswith(f"{scratch}/w/a")):
        assert [bytes(r.message) for r in ends.where(cond).collect()] == [b"a\n"]


def batches(scratch, n):
    os.makedirs(f"{scratch}/in", exist_ok=True)
    for i in range(n):
        with open(f"{scratch}/in/{i}.json", "w") as f:
            f.write(f'{{"v": {2 * i}}}\n{{"v": {2 * i + 1}}}\n')
        os.utime(f"{scratch}/in/{i}.json", (1_700_000_000 + i,) * 2)


@pytest.mark.parametrize("where", ["before", "behind"])
def test_outbox_has_each_row_once_when_the_driver_fails(spark, scratch, where):
    batches(scratch, 4)
    box = f"{scratch}/box"

    def start():
        df = spark.readStream.schema("v long").option("maxFilesPerTrigger", 1).json(f"{scratch}/in")
        return write_outbox(df, box, "q1", f"{scratch}/ck", trigger={"availableNow": True}, failOnce=f"{where}:{scratch}/tripped")

    with pytest.raises(Exception):
        start().awaitTermination(120)
    assert os.path.exists(f"{scratch}/tripped")
    assert start().awaitTermination(120)
    assert sorted(r.v for r in read_outbox(spark, box, "v long").collect()) == list(range(8))
    assert [r["epoch"] for r in committed(box)] == [0, 1, 2, 3]
    vacuum_outbox(box, "q1")
    assert len(os.listdir(f"{box}/data/q1")) == sum(len(r["files"]) for r in committed(box))


def test_outbox_of_a_batch_frame(spark, scratch):
    df = spark.range(100).selectExpr("id AS v", "CAST(NULL AS string) AS s")
    for _ in range(2):                                                # a retry of the same epoch
        write_outbox(df, f"{scratch}/box", "job", epoch=7)
    write_outbox(df.where("v < 5"), f"{scratch}/box", "job", epoch=8)
    write_outbox(df.where("v < 0"), f"{scratch}/box", "other")
    assert read_outbox(spark, f"{scratch}/box", "v long, s string").count() == 105
    assert read_outbox(spark, f"{scratch}/none", "v long").count() == 0
    with pytest.raises(ValueError):
        write_outbox(df, f"{scratch}/box", "a/b")
