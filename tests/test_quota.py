import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from weir.operators.quota import flag_overflow, previous_time, rate_limit, rate_limit_bounded
from weir.plans import fixtures as fx

T0 = dt.datetime(2024, 1, 1)


def rows(spark, data):
    # (seq, path, seconds, size)
    return spark.createDataFrame(
        [(s, p, T0 + dt.timedelta(seconds=sec), size, "/var") for s, p, sec, size in data],
        "seq long, path string, ts timestamp, size long, prefix string")


def test_golden_overflow(spark):
    # quota 42: same instant -> overflow; ~1 ms later -> overflow; unknown key -> not;
    # 880 bytes one second later -> overflow; 42 bytes after 1 s -> at the quota, kept.
    df = rows(spark, [(1, "a", 0, 42), (2, "a", 0, 42), (3, "a", 0.001, 42), (4, "b", 0, 42),
                      (5, "a", 1.001, 880), (6, "a", 2.001, 42)])
    got = {r.seq: r.overflow for r in flag_overflow(df, 42).collect()}
    assert got == {1: False, 2: True, 3: True, 4: False, 5: True, 6: False}


def test_time_advances_on_drops(spark):
    df = rows(spark, [(1, "a", 0, 10), (2, "a", 0.1, 10), (3, "a", 0.2, 10)])
    kept = [r.seq for r in rate_limit(df, 50).orderBy("seq").collect()]
    # 10 B / 0.1 s = 100 B/s > 50 each time: only the first passes.
    assert kept == [1]


def test_buckets_match_plain_lag_on_hot_key(spark):
    # One hot key spread over many buckets, with ties on ts resolved by seq.
    data = [(i, "hot" if i % 3 else f"k{i % 7}", i * 7.3 % 500 + (i % 2) * 0.0, 5) for i in range(600)]
    df = rows(spark, data)
    w = Window.partitionBy("path").orderBy("ts", "seq")
    want = df.select("seq", F.lag(F.unix_micros("ts")).over(w).alias("prev_us"))
    for seconds in (0.5, 10, 1_000_000):  # buckets of a row, of some, one for all
        got = previous_time(df, bucket_seconds=seconds).select("seq", "prev_us")
        assert sorted(got.collect()) == sorted(want.collect())


def test_null_keys_and_times_are_kept(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 7), (3, "a", None), (4, "a", 9), (5, "a", None)],
                               "seq long, path string, s long").select("seq", "path", F.timestamp_seconds("s").alias("ts"))
    for seconds in (1, 60):
        got = {r.seq: r.prev_us for r in previous_time(df, bucket_seconds=seconds).collect()}
        assert got == {1: None, 2: 5_000_000, 3: None, 4: None, 5: None}


def test_quota_matches_fixture_split(spark):
    w = fx.writes(spark, "/root/testdata/sf0.01")
    assert rate_limit(w, 0.0001).count() == 6353


def test_bounded_tracker_evicts_fifo(spark):
    # Ring of 2: a, b tracked; c evicts a (first in), so a passes again as new.
    df = rows(spark, [(1, "a", 0, 1000), (2, "b", 0.1, 1000), (3, "c", 0.2, 1000), (4, "a", 0.3, 1000),
                      (5, "c", 0.4, 1000)])
    got = {r.seq: r.overflow for r in rate_limit_bounded(df, 10, max_tracked=2).collect()}
    assert got == {1: False, 2: False, 3: False, 4: False, 5: True}


def slow_ring(rows, quota, size):
    """The tracker, row by row: a queue of keys and their last times."""
    rings, out = {}, {}
    for seq, path, sec, n, shard in sorted(rows, key=lambda r: (r[2], r[0])):
        ring = rings.setdefault(shard, {})
        t = round(sec * 1e6)
        if path in ring:
            dt = t - ring[path]
            out[seq] = dt == 0 or n * 1e6 / dt > quota
        else:
            out[seq] = False
            if len(ring) == size:
                del ring[next(iter(ring))]
        ring[path] = t  # an old key keeps its place in the queue
    return out


ORDERS = {
    "random": lambda i, rng: rng.choice("abcdefgh"),
    "one more key than slots, in turn": lambda i, rng: "abcd"[i % 4],      # every row misses
    "slots suffice": lambda i, rng: rng.choice("abc"),                      # nothing is ever evicted
    "a rare fourth": lambda i, rng: rng.choice("abc") if i % 97 else "d",   # guesses stay wrong for long
    "new keys only": lambda i, rng: f"k{i}",
    "blocks": lambda i, rng: "abcdefgh"[i // 60 % 8],
}


@pytest.mark.parametrize("order", ORDERS)
def test_segments_of_a_hot_shard_equal_the_sequential_scan(spark, order):
    rng = random.Random(1)
    data = [(i, ORDERS[order](i, rng), i * 0.25, rng.choice([1, 9]), "hot" if i % 10 else f"s{i % 3}") for i in range(900)]
    df = spark.createDataFrame([(s, p, T0 + dt.timedelta(seconds=sec), n, sh) for s, p, sec, n, sh in data],
                               "seq long, path string, ts timestamp, size long, prefix string")
    want = slow_ring(data, 10, 3)
    for segment_rows in (130, 10_000):
        got = rate_limit_bounded(df, 10, max_tracked=3, segment_rows=segment_rows)
        assert got.columns == [*df.columns, "overflow"]
        assert {r.seq: r.overflow for r in got.collect()} == want


def test_short_segments_make_no_more_than_so_many_pieces(spark, monkeypatch):
    import glob

    from weir.operators import quota
    from weir.session import checkpoint_dir

    monkeypatch.setattr(quota, "PIECES", 4)
    rng = random.Random(2)
    data = [(i, f"p{rng.randint(0, 6)}", i * 0.25, rng.choice([1, 9]), "hot") for i in range(600)]
    df = spark.createDataFrame([(s, p, T0 + dt.timedelta(seconds=sec), n, sh) for s, p, sec, n, sh in data],
                               "seq long, path string, ts timestamp, size long, prefix string")
    folders = lambda: set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/tracker-*/rows"))
    before = folders()
    got = rate_limit_bounded(df, 10, max_tracked=3, segment_rows=5)
    (rows,) = folders() - before
    assert 2 <= len(glob.glob(f"{rows}/part-*")) <= 4
    assert {r.seq: r.overflow for r in got.collect()} == slow_ring(data, 10, 3)
    # One piece a task: by a hash, several could meet in one.
    assert "hashpartitioning(__piece" not in got._jdf.queryExecution().executedPlan().toString()


def test_tracker_takes_null_keys_shards_and_times(spark):
    df = spark.createDataFrame([(1, None, None, 5, None), (2, None, T0, 5, None), (3, "a", T0, 5, None), (4, None, T0, 5, None)],
                               "seq long, path string, ts timestamp, size long, prefix string")
    got = {r.seq: r.overflow for r in rate_limit_bounded(df, 10, max_tracked=2).collect()}
    assert got == {1: False, 2: False, 3: False, 4: True}
    assert rate_limit_bounded(df.limit(0), 10).count() == 0


def test_quota_reads_its_input_once_and_moves_it_once(spark):
    plan = rate_limit(fx.writes(spark, "/root/testdata/sf0.001"), 1)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("+- == Initial Plan ==")[-1]
    assert initial.count("Exchange hashpartitioning") <= 4 and initial.count("FileScan") <= 2


def test_hot_path_is_spread_over_tasks(spark):
    # A third of all writes on one path: its window runs per (path, minute), so
    # the hot path's rows come out of several partitions, and the result still
    # equals a plain lag over the whole path.
    w = fx.writes(spark, "/root/testdata/sf0.01")
    hot = w.withColumn("path", F.when(F.col("seq") % 3 == 0, F.lit("./hot/all.log")).otherwise(F.col("path")))
    # AQE would merge this tiny shuffle into one partition; look at the plan's own partitioning.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = (previous_time(hot).select("path", "prev_us").rdd
                    .mapPartitions(lambda rows: [sum(1 for r in rows if r.path == "./hot/all.log")]).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(per_task) == 3334
    assert max(per_task) < 3334 / 2                      # no task holds the hot path
    want = hot.select("seq", F.lag(F.unix_micros("ts")).over(Window.partitionBy("path").orderBy("ts", "seq"))
                      .alias("prev_us"))
    got = previous_time(hot).select("seq", "prev_us")
    assert sorted(got.collect()) == sorted(want.collect())
