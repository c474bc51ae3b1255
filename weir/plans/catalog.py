"""Registered queries: one per operator of the inventory, each a Spark plan over
the driver's tables (or tables Spark derives from them).

Every query returns scalar columns with stable names; ``weir.plans.oracle``
holds the DuckDB twin of each one that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions import djb2, get_property, iso_timestamp, pairs_to_map, path_join, ts_micros
from weir.operators import backlog as bl
from weir.operators import codec
from weir.operators import config as cfg
from weir.operators import delivery as dv
from weir.operators import enrich as en
from weir.operators import filters as fl
from weir.operators import quota as qt
from weir.plans import fixtures as fx
from weir.plans import streams as st
from weir.session import configure
from weir.sources import config as scfg
from weir.sources import lines as ln
from weir.sources import writes as sw
from weir.streaming import event_time as ev
from weir.streaming.gaps import missing_ranges_stream

# Fixed parameters of the registered queries.
QUOTA = 0.0001                      # bytes/s; splits the events fixture
EXCLUDE_GLOBS = ["./error/*", "*/u1?.log", "./[cv]*/u7.log", "./purchase/u[!0-4]*.log", r"./sign\up/u2.log"]
EXCLUDE_PREFIXES = ["/var/log/view", "/var/log/click/u1"]
SLEEP_DIRS = ["/srv/docs/src1"]
STATIC_FIELDS = {"site": "rack-7", "note": 'two "quoted" words'}
STATIC_TAGS = ["orders", "a/b"]
BACKLOG_N = 1000
SEGMENT_ROWS = 600
REPLAY_SPLIT = "2024-01-15 00:00:00"
ENCODER_BY_TYPE = {"view": "logstash_base64", "click": "logstash", "error": "text",
                   "purchase": "logstash_base64_fpenzoyr", "signup": "csv"}
VERSION_BY_TYPE = {"view": "0.1.1", "click": "0.1.2", "error": "0.2", "purchase": "x.1", "signup": "0.1.6"}
SELECTED_FIELDS = "path @message no_such_field uid"


def _event_type(path_col="path"):
    return F.regexp_extract(F.col(path_col), r"^\./([^/]+)/", 1)


def _enriched(spark, sf, fields=None, tags=None) -> DataFrame:
    w = fx.writes(spark, sf)
    return en.enrich(w, fx.users(spark, sf), fx.groups(spark, sf), fx.procs(spark, sf), fields, tags)


def _wire(spark, sf, encoder="logstash_base64") -> DataFrame:
    good, _ = codec.encode(_enriched(spark, sf, STATIC_FIELDS, STATIC_TAGS), encoder)
    return good


def _decoded(spark, sf, columns=None) -> DataFrame:
    events, _ = codec.decode(_wire(spark, sf), keep=["seq"], version_gate=False, columns=columns)
    return events


# ----------------------------------------------------------------------------- sources

def q_split_lines(spark, sf):
    return ln.split_lines(fx.files(spark, sf))


def q_tail_from_offsets(spark, sf):
    lines, _ = ln.tail_from_offsets(fx.files(spark, sf), fx.offsets(spark, sf))
    return lines.select("path", "line_no", "offset", "nbytes")


def q_tail_new_offsets(spark, sf):
    _, off = ln.tail_from_offsets(fx.files(spark, sf), fx.offsets(spark, sf), whole_lines=True)
    return off


def q_tail_latest(spark, sf):
    lines, _ = ln.tail_from_offsets(fx.files(spark, sf), fx.offsets(spark, sf), starting="latest")
    return lines.select("path", "line_no", "offset", "nbytes")


def q_tail_earliest(spark, sf):
    lines, _ = ln.tail_from_offsets(fx.files(spark, sf), None, starting="earliest", whole_lines=True)
    return lines.select("path", "line_no", "offset", "nbytes")


def _nested_files(spark, sf):
    d = fx.table(spark, sf, "documents")
    path = F.when(F.col("lang") == "en", F.concat(F.lit("/docs/"), F.col("source"), F.lit("/"),
                                                 F.col("doc_id").cast("string"), F.lit(".txt"))) \
        .otherwise(F.concat(F.lit("/docs/"), F.col("doc_id").cast("string"), F.lit(".txt")))
    return d.select(path.alias("path"), "text")


def q_tail_nonrecursive(spark, sf):
    scoped = ln.watch_scope(_nested_files(spark, sf), ["/docs"], recursive=False)
    lines = ln.split_lines(scoped, keep=("prefix",))
    return lines.groupBy("prefix", "path").agg(F.count(F.lit(1)).alias("n_lines"),
                                               F.sum("nbytes").alias("bytes"))


def q_tail_recursive(spark, sf):
    scoped = ln.watch_scope(_nested_files(spark, sf), ["/docs", "/docs/src1"], recursive=True)
    lines = ln.split_lines(scoped, keep=("prefix",))
    return lines.groupBy("prefix", "path").agg(F.count(F.lit(1)).alias("n_lines"),
                                               F.sum("nbytes").alias("bytes"))


def q_multi_source_union(spark, sf):
    w = fx.writes(spark, sf).select("prefix", "path", F.col("size").alias("nbytes"))
    lines = ln.split_lines(fx.files(spark, sf)).select(F.lit("/").alias("prefix"), "path", "nbytes")
    u = ln.union_sources(w, lines)
    return u.select(codec.event_path().alias("event_path"), "prefix", "nbytes") \
        .groupBy("prefix", "event_path").agg(F.count(F.lit(1)).alias("events"),
                                             F.sum("nbytes").cast("bigint").alias("bytes"))


def q_write_events(spark, sf):
    ev = fx.table(spark, sf, "events")
    w = sw.write_events(
        ev, seq=F.col("event_id"), ts=F.col("ts"), prefix=F.lit("/var/log"),
        path=F.concat(F.lit("./"), F.col("event_type"), F.lit(".log")),
        buf=F.concat(F.col("props"), F.lit("\x00tail")), size=F.octet_length("props") + 1,
        uid=F.col("user_id"))
    return w.select("seq", ts_micros("ts").alias("ts_us"), "prefix", "path",
                    F.hex("buf").alias("buf_hex"), "size", "offset", "pid", "uid", "gid")


def q_heartbeat(spark, sf):
    bounds = fx.table(spark, sf, "events").agg(F.min("ts").cast("timestamp").alias("s"),
                                                F.max("ts").cast("timestamp").alias("e"))
    hb = sw.heartbeat(spark, "s", "e", bounds=bounds)
    return hb.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "path", "message") \
        .agg(F.count(F.lit(1)).alias("pings"), F.min(ts_micros("ts")).alias("first_us"),
             F.max(ts_micros("ts")).alias("last_us"))


def q_load_config(spark, sf):
    return scfg.load_config(fx.properties_lines(spark, sf))


def q_parse_args(spark, sf):
    p = scfg.parse_args(fx.argument_lines(spark, sf), keep=("host_id",))
    return p.select("host_id", "ok", "key", F.size("values").alias("n_values"),
                    F.array_join("values", " ").alias("values"))


# ----------------------------------------------------------------------------- sinks

def q_route_topic(spark, sf):
    w = fx.writes(spark, sf)
    w = w.withColumn("ts", F.when(F.col("seq") % 97 != 0, F.col("ts")))  # rows without a time get the default topic
    return en.route_topic(en.with_config(w, fx.config_versions(spark))).select("seq", "topic")


def q_render_report(spark, sf):
    d = _decoded(spark, sf, ["@timestamp", "path", "@message"])
    return codec.render_report(d).select("seq", "line")


# ----------------------------------------------------------------------------- filters

def q_exclude_paths(spark, sf):
    return fl.exclude_paths(fx.writes(spark, sf), EXCLUDE_GLOBS).select("seq", "path")


def _pattern_table(spark, sf):
    lit_paths = fx.table(spark, sf, "customer").select(
        F.concat(F.lit("./view/u"), F.col("c_custkey").cast("string"), F.lit(".log")).alias("pattern"))
    wild = spark.createDataFrame([(p,) for p in EXCLUDE_GLOBS[:3]], "pattern string")
    return lit_paths.unionByName(wild)


def q_exclude_paths_table(spark, sf):
    return fl.exclude_paths(fx.writes(spark, sf), _pattern_table(spark, sf)).select("seq", "path")


def q_exclude_prefixes(spark, sf):
    d = _dir_spellings(spark, sf).select(F.col("ord").alias("seq"), F.col("dir").alias("event_path"))
    return fl.exclude_prefixes(d, EXCLUDE_PREFIXES, col="event_path").select("seq", "event_path")


def q_exclude_prefixes_table(spark, sf):
    d = _dir_spellings(spark, sf).select(F.col("ord").alias("seq"), F.col("dir").alias("event_path"))
    p = fx.table(spark, sf, "customer").select(F.concat(
        F.lit("/var/log/./click/u"), F.col("c_custkey").cast("string")).alias("prefix"))
    return fl.exclude_prefixes(d, p, col="event_path").select("seq", "event_path")


def q_sleep_mode(spark, sf):
    w = fx.writes(spark, sf).select("prefix", "path")
    d = fx.table(spark, sf, "documents").select(
        F.concat(F.lit("/srv/docs/"), F.col("source")).alias("prefix"),
        F.concat(F.lit("./"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"))
    u = ln.union_sources(w, d)
    return fl.apply_sleep(u, SLEEP_DIRS, True).select("prefix", "path")


def _encoder_col():
    et = _event_type()
    c = None
    for k, v in ENCODER_BY_TYPE.items():
        c = F.when(et == k, F.lit(v)) if c is None else c.when(et == k, F.lit(v))
    return c


def q_exclude_paths_index(spark, sf):
    """Paths against a table of wildcard-led patterns, one or two a customer."""
    c = fx.table(spark, sf, "customer")
    key = F.col("c_custkey").cast("string")
    pats = c.where("c_nationkey < 5").select(F.concat(F.lit("*/u"), key, F.lit(".log")).alias("pattern")).unionByName(
        c.where("c_nationkey = 7").select(F.concat(F.lit("[.]/*/u"), key, F.lit(".l?g")).alias("pattern")))
    return fl.exclude_paths(fx.writes(spark, sf), pats).select("seq", "path")


def q_encode_reject(spark, sf):
    _, dead = codec.encode(fx.writes(spark, sf), _encoder_col())
    return dead.select("seq", "encoder", "reason")


def q_between_markers(spark, sf):
    c = fx.table(spark, sf, "conversations")
    return fl.between_markers(c, F.col("role") == "assistant", F.col("role") == "system",
                              "conv_id", order_by=("turn",)).select("conv_id", "turn", "role")


# ----------------------------------------------------------------------------- quota and backlog

def q_rate_limit(spark, sf):
    return qt.rate_limit(fx.writes(spark, sf), QUOTA).select("seq", "path")


def q_flag_overflow(spark, sf):
    return qt.flag_overflow(fx.writes(spark, sf), QUOTA).select("seq", "path", "dt_us", "rate", "overflow")


def q_last_seen(spark, sf):
    return qt.last_seen(fx.writes(spark, sf)).select("path", ts_micros("last_seen").alias("last_seen_us"))


def q_rate_limit_bounded(spark, sf):
    w = fx.writes(spark, sf).withColumn("prefix", F.concat(
        F.lit("/var/log/"), _event_type(), F.lit("/"), (F.col("uid") % 8).cast("string")))
    return qt.rate_limit_bounded(w, QUOTA, max_tracked=5, shard="prefix").select("seq", "path", "overflow")


def q_rate_limit_bounded_segments(spark, sf):
    """Hot prefixes: a shard is scanned in several segments at once, from guessed rings, and repaired."""
    w = fx.writes(spark, sf).withColumn("prefix", F.concat(F.lit("/var/log/"), _event_type()))
    return qt.rate_limit_bounded(w, QUOTA, max_tracked=5, segment_rows=SEGMENT_ROWS).select("seq", "path", "overflow")


def q_stream_rate_limit(spark, sf):
    df = st.feed(fx.writes(spark, sf))
    out = st.drained(ev.rate_limit_event_time(df, QUOTA, delay=st.DELAY, bucket_ms=st.BUCKET_MS), "quota")
    return out.where(F.col("seq").isNotNull()).select("seq", "path")


def q_stream_rate_limit_bounded(spark, sf):
    w = fx.writes(spark, sf).withColumn("prefix", F.concat(
        F.lit("/var/log/"), _event_type(), F.lit("/"), (F.col("uid") % 8).cast("string")))
    df = ev.rate_limit_bounded_stream(st.feed(w), QUOTA, max_tracked=5, delay=st.DELAY, bucket_ms=st.BUCKET_MS)
    return st.drained(df, "tracker").where(F.col("seq").isNotNull()).select("seq", "path", "overflow")


def q_stream_backlog(spark, sf):
    """Closed up to a time, then opened with filters: the backlog first, then live rows."""
    status = spark.createDataFrame([(REPLAY_SPLIT, True, EXCLUDE_GLOBS[:1], QUOTA)],
                                   "at string, ready boolean, excludes array<string>, quota double")
    status = status.select(F.col("at").cast("timestamp").alias("ts"), "ready", "excludes", "quota")
    df = ev.spool_until_ready(st.feed(fx.writes(spark, sf)), st.control_feed(status), n=BACKLOG_N, delay=st.DELAY,
                              bucket_ms=st.BUCKET_MS, shards=1)
    return st.drained(df, "backlog").where(F.col("seq").isNotNull()).select("seq", "path")


def q_bounded_backlog(spark, sf):
    return bl.bounded_backlog(fx.writes(spark, sf), BACKLOG_N).select("seq", "path")


def q_bounded_backlog_sharded(spark, sf):
    w = fx.writes(spark, sf).withColumn("event_type", _event_type())
    return bl.bounded_backlog(w, 50, shard="event_type").select("seq", "event_type")


def q_bounded_backlog_default(spark, sf):
    w = fx.writes(spark, sf).withColumn("event_type", _event_type())
    return bl.bounded_backlog(w, shard="event_type").select("seq", "event_type")


def q_drain_backlog(spark, sf):
    w = fx.writes(spark, sf)
    split = F.lit(REPLAY_SPLIT).cast("timestamp")
    backlog = bl.bounded_backlog(w.where(F.col("ts") < split), BACKLOG_N)
    live = w.where(F.col("ts") >= split)
    return bl.drain(backlog, live, EXCLUDE_GLOBS[:1], QUOTA).select("seq", "path")


def _sink_status(spark, sf):
    ev = fx.table(spark, sf, "events")
    return ev.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("seq"),
                     F.col("event_type").isin("signup", "view", "click").alias("ready"))


def _sink_history(spark, sf):
    """The sink's state from the purchases on: one row a time."""
    ev_ = fx.table(spark, sf, "events").where(F.col("event_type") == "purchase")
    return ev_.groupBy(F.col("ts").cast("timestamp").alias("since")).agg(
        F.max_by(F.concat(F.lit("sink-"), (F.col("event_id") % 5).cast("string")), "event_id").alias("state"))


def q_stream_with_config(spark, sf):
    history = st.control_feed(_sink_history(spark, sf))
    df = ev.with_config_stream(st.feed(fx.writes(spark, sf)), history, effective_col="since", delay=st.DELAY,
                               bucket_ms=st.BUCKET_MS, shards=4)
    return st.drained(df, "config").where(F.col("seq").isNotNull()).select("seq", "state")


def q_with_config_history(spark, sf):
    """The latest order before each shipped line: a history as long as the orders table."""
    history = fx.table(spark, sf, "orders").select(F.col("o_orderdate").cast("timestamp").alias("since"),
                                                   F.col("o_orderkey").alias("n"), F.col("o_orderstatus").alias("state"))
    w = en.with_config(fx.lineitem_writes(spark, sf), history, effective_col="since", seq="n")
    return w.select("seq", "n", "state")


def q_route_ready(spark, sf):
    w = fx.writes(spark, sf)
    w = w.withColumn("ts", F.when(F.col("seq") % 97 != 0, F.col("ts")))  # some rows have lost their time
    j = bl.with_ready(w, _sink_status(spark, sf), status_seq="seq", out="ready")
    return j.select("seq", F.when(F.col("ready"), "sink").otherwise("backlog").alias("route"))


# ----------------------------------------------------------------------------- enrichment

def q_with_user(spark, sf):
    return en.with_user(fx.writes(spark, sf), fx.users(spark, sf)).select("seq", "uid", "user")


def q_with_group(spark, sf):
    return en.with_group(fx.writes(spark, sf), fx.groups(spark, sf)).select("seq", "gid", "group")


def q_with_command(spark, sf):
    w = en.with_command(fx.writes(spark, sf), fx.procs(spark, sf))
    return w.select("seq", "pid", codec.command_b64("cmdline").alias("command"))


def q_with_static(spark, sf):
    w = en.with_static(fx.writes(spark, sf), STATIC_FIELDS, STATIC_TAGS)
    return w.select("seq", F.to_json("fields").alias("fields_json"), F.to_json("tags").alias("tags_json"))


def q_with_config(spark, sf):
    w = fx.writes(spark, sf)
    w = w.withColumn("ts", F.when(F.col("seq") % 97 != 0, F.col("ts")))
    return en.with_config(w, fx.config_versions(spark)).select("seq", "topic", "site", "tag")


# ----------------------------------------------------------------------------- encode / decode

def q_encode_b64(spark, sf):
    return _wire(spark, sf).select("seq", F.col("value").cast("string").alias("value"))


def q_encode_json(spark, sf):
    return _wire(spark, sf, "logstash").select("seq", F.col("value").cast("string").alias("value"))


def q_encode_text(spark, sf):
    return _wire(spark, sf, "text").select("seq", F.col("value").cast("string").alias("value"))


def q_obfuscate(spark, sf):
    return _wire(spark, sf, "logstash_fpenzoyr").select("seq", F.hex("value").alias("value_hex"))


def q_nul_cut(spark, sf):
    ev = fx.table(spark, sf, "events")
    w = sw.write_events(ev, seq=F.col("event_id"), ts=F.col("ts"), prefix=F.lit("/var/log"),
                        path=F.lit("./nul.log"),
                        buf=F.concat(F.col("event_type"), F.lit("\x00"), F.col("props")))
    sent = []
    for name in ("text", "logstash"):
        good, _ = codec.encode(w, name)
        sent.append(good.select("seq", F.lit(name).alias("encoder"), F.col("value").cast("string").alias("value")))
    return sent[0].unionByName(sent[1])


def _mixed_wire(spark, sf):
    good, _ = codec.encode(_enriched(spark, sf), _encoder_col())
    return good


def q_deobfuscate(spark, sf):
    return _mixed_wire(spark, sf).select("seq", F.hex(codec.deobfuscate("value")).alias("value_hex"))


def q_decode_events(spark, sf):
    d = _decoded(spark, sf)
    return d.select("seq", "path", "uid", "@message", "user", "group", "command", "@version",
                    "message_size-added")


def q_dead_letters(spark, sf):
    _, dead = codec.decode(_mixed_wire(spark, sf), keep=["seq"])
    return dead.select("seq", "reason")


def _minimal(spark, sf) -> DataFrame:
    ev = fx.table(spark, sf, "events")
    return ev.select(F.col("event_id").alias("seq"), F.concat(
        F.lit('{"command": "'), F.base64(F.col("event_type").cast("binary")), F.lit('", "@message": "'),
        F.base64(F.col("props").cast("binary")), F.lit('", "kind": "'), F.col("event_type"), F.lit('"}')).alias("value"))


def q_decode_minimal(spark, sf):
    events, _ = codec.decode(_minimal(spark, sf), keep=["seq"], version_gate=False,
                             columns=["command", "@message", "message_size-added", "path", "kind"])
    return events


def q_decode_broken(spark, sf):
    k, v = F.col("seq") % 6, F.col("value")
    broken = (F.when(k == 0, F.concat(v, F.lit(" trailing"))).when(k == 1, F.concat(v, F.lit(","), v))
              .when(k == 2, F.regexp_replace(v, r"^\{", '{"pid": "abc", ')).when(k == 3, F.concat(v, F.lit("]")))
              .otherwise(v))
    _, dead = codec.decode(_minimal(spark, sf).select("seq", broken.alias("value")), keep=["seq"])
    return dead.select("seq", "reason")


def q_decode_versioned(spark, sf):
    wire = _wire(spark, sf)
    et = _event_type_from_json()
    ver = None
    for k, v in VERSION_BY_TYPE.items():
        ver = F.when(et == k, F.lit(v)) if ver is None else ver.when(et == k, F.lit(v))
    rewritten = wire.withColumn("value", F.replace(F.col("value").cast("string"), F.lit('"@version":"0.1.6"'),
                                                   F.concat(F.lit('"@version":"'), ver, F.lit('"'))))
    events, _ = codec.decode(rewritten, keep=["seq"], version_gate=True)
    return events.select("seq", "@version", "@message", "command")


def _event_type_from_json():
    return F.regexp_extract(F.col("value").cast("string"), r'"path":"/var/log/([^/]+)/', 1)


def q_message_size(spark, sf):
    return _decoded(spark, sf, ["message_size-added"])


def q_select_fields(spark, sf):
    d = _decoded(spark, sf, ["path", "@message", "uid"])
    return codec.select_fields(d, SELECTED_FIELDS)


def q_render_event(spark, sf):
    d = _decoded(spark, sf).drop("message_size-added")
    return codec.render_event(d, keys=[c for c in d.columns if c != "seq"]).select("seq", "text")


def q_utf8_repair(spark, sf):
    lines, _ = ln.tail_from_offsets(fx.files(spark, sf), fx.offsets(spark, sf))
    return lines.select("path", "line_no", "message")


# ----------------------------------------------------------------------------- aggregates, sets

def q_merge_config(spark, sf):
    return cfg.merge_config(scfg.load_config(fx.properties_lines(spark, sf)))


def q_missing_ranges(spark, sf):
    sent = fx.table(spark, sf, "events").agg(F.count(F.lit(1)).alias("n"))
    return dv.missing_ranges(fx.received(spark, sf), expected=sent)


def q_explode_numbers(spark, sf):
    w = fx.writes(spark, sf).select("seq", F.col("buf").cast("string").alias("message"))
    n = dv.explode_numbers(w, "message", keep=("seq",))
    return n.select("seq", "pos", "item", F.col("number").cast("bigint").alias("number"))


def q_delivery_summary(spark, sf):
    return dv.delivery_summary(fx.writes(spark, sf))


def q_stream_missing_ranges(spark, sf):
    """What did not arrive of the ids of ``events``: a stream of received ids, and one closing id."""
    ids = fx.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    got = ids.where(F.col("value") > 5).select(F.col("event_id").alias("id"), "ts")
    total = ids.agg(F.count(F.lit(1)).alias("id")).withColumn("ts", F.lit("2090-01-01 00:00:00").cast("timestamp"))
    out = missing_ranges_stream(st.feed(got, last=total), delay=st.DELAY)
    return st.drained(out, "gaps").select("first", "last")


def q_compare_captures(spark, sf):
    w = fx.writes(spark, sf).select("path", F.col("buf").cast("string").alias("message"), "ts", "seq", "size")
    a = w
    b = qt.rate_limit(w, QUOTA)
    return dv.compare_captures(a, b)


def q_volume_by_path(spark, sf):
    return dv.volume_by_path(_decoded(spark, sf, ["path", "message_size-added"]))


def _dir_spellings(spark, sf):
    ev = fx.table(spark, sf, "events")
    k = F.col("event_id") % 4
    base_t = F.col("event_type")
    u = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    d = (F.when(k == 0, F.concat(F.lit("/var/log/"), base_t, F.lit("/"), u))
         .when(k == 1, F.concat(F.lit("/var//log/./"), base_t, F.lit("/"), u, F.lit("/")))
         .when(k == 2, F.concat(F.lit("/var/log/"), base_t, F.lit("/../"), base_t, F.lit("/"), u))
         .otherwise(F.concat(F.lit("var/log/"), base_t, F.lit("/"), u)))
    return ev.select(d.alias("dir"), F.col("event_id").alias("ord"))


def q_unique_paths(spark, sf):
    return cfg.unique_paths(_dir_spellings(spark, sf))


def q_merge_servers(spark, sf):
    s = fx.table(spark, sf, "supplier").join(fx.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    known = F.array(F.concat(F.lower("n_name"), F.lit(":9092")))
    incoming = (F.when(F.col("s_suppkey") % 4 == 0, F.lit(""))
                .when(F.col("s_suppkey") % 4 == 1, F.concat(F.lower("n_name"), F.lit(":9092")))
                .otherwise(F.concat(F.lower("n_name"), F.lit(":9092,"), F.lower(F.col("s_name")), F.lit(":9092"))))
    merged, any_new = cfg.merge_servers(known, incoming)
    return s.select("s_suppkey", F.array_join(merged, ",").alias("merged"), any_new.alias("any_new"))


def q_watch_diff(spark, sf):
    configured = _dir_spellings(spark, sf).select("dir").unionByName(
        spark.createDataFrame([("/srv/new/",)], "dir string"))
    watched = fx.table(spark, sf, "events").where(F.col("event_type").isin("click", "error")).select(
        F.concat(F.lit("/var/./log/"), F.col("event_type")).alias("dir")).unionByName(
        spark.createDataFrame([("/var/log//old",), ("/var/log/view/u1",)], "dir string"))
    start, stop = cfg.watch_diff(configured, watched)
    return start.select(F.lit("start").alias("action"), "dir").unionByName(
        stop.select(F.lit("stop").alias("action"), "dir"))


# ----------------------------------------------------------------------------- scalar functions

def q_djb2(spark, sf):
    return fx.writes(spark, sf).select("seq", "path", djb2("path").cast("string").alias("djb2"))


def q_iso_timestamp(spark, sf):
    return fx.writes(spark, sf).select("seq", iso_timestamp("ts").alias("ts_iso"))


def q_path_join(spark, sf):
    c = fx.table(spark, sf, "customer")
    a = F.when(F.col("c_custkey") % 10 != 0, F.lower("c_mktsegment"))
    return c.select("c_custkey", path_join(a, F.col("c_name")).alias("joined"))


def q_pairs_to_map(spark, sf):
    entries = scfg.load_config(fx.properties_lines(spark, sf)).where(F.col("key") == "fields")
    per_line = entries.groupBy("file", "line_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("idx", "value"))), lambda x: x["value"]).alias("pairs"))
    return per_line.select("file", "line_no", F.explode(pairs_to_map("pairs")).alias("k", "v"))


def q_get_property(spark, sf):
    return get_property(fx.properties_lines(spark, sf), "agent_quota")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in QUERIES.items()}
