"""Row shapes: the captured write (input) and the log event (output)."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's wire format.
EVENT_VERSION = "0.1.6"
DEFAULT_TOPIC = "logs"
DEFAULT_ENCODER = "logstash_base64"
OBFUSCATION_MARKER = "fpenzoyr"
HEARTBEAT_MESSAGE = "ping"
HEARTBEAT_PATH = "/example"
DEFAULT_BACKLOG = 10000
DEFAULT_TRACKED_PATHS = 20
# The twelve keys of an event, in wire order.
EVENT_KEYS = ["path", "pid", "uid", "gid", "@message", "@timestamp", "user", "group",
              "command", "@version", "@fields", "@tags"]
# Field added by consumers.
MESSAGE_SIZE_KEY = "message_size-added"
# Option names accepted on an argument line.
KNOWN_OPTIONS = ["directories", "persist", "excluded_files", "substitutions", "zookeepers",
                 "brokers", "topic", "fields", "tags", "quota", "input", "output", "encoder",
                 "debug", "log"]

# Captured write: one row per write call (or per tailed line).
WRITE_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("prefix", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("buf", T.BinaryType()),
    T.StructField("size", T.LongType()),
    T.StructField("offset", T.LongType()),
    T.StructField("pid", T.IntegerType()),
    T.StructField("uid", T.IntegerType()),
    T.StructField("gid", T.IntegerType()),
])

# Decoded log event, in wire order.
EVENT_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("pid", T.IntegerType()),
    T.StructField("uid", T.IntegerType()),
    T.StructField("gid", T.IntegerType()),
    T.StructField("@message", T.StringType()),
    T.StructField("@timestamp", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("group", T.StringType()),
    T.StructField("command", T.StringType()),
    T.StructField("@version", T.StringType()),
    T.StructField("@fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("@tags", T.ArrayType(T.StringType())),
])
