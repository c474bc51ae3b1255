"""Derived input tables, built by Spark from the driver's parquet tables.

Each builder has a twin SQL text (``SQL``) used as the oracle's ``WITH`` clause,
so a registered query and its oracle start from the same rows. Every fixture
grows with the table it is derived from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured writes (schema 1.2) from ``events``: one write per event."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("/var/log").alias("prefix"),
        F.concat(F.lit("./"), F.col("event_type"), F.lit("/u"), F.col("user_id").cast("string"),
                 F.lit(".log")).alias("path"),
        F.col("props").cast("binary").alias("buf"),
        F.octet_length("props").cast("bigint").alias("size"),
        F.lit(0).cast("bigint").alias("offset"),
        (F.col("event_id") % 32768).cast("int").alias("pid"),
        # Some writers are not in the user table.
        F.when(F.col("event_id") % 13 == 0, F.col("user_id") + 1000000).otherwise(F.col("user_id")).cast("int").alias("uid"),
        (F.col("user_id") % 30).cast("int").alias("gid"),
    )


def lineitem_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk captured writes from ``lineitem``: the order is the file, the ship
    date the time; used for volume (bench)."""
    li = table(spark, sf_dir, "lineitem")
    msg = F.concat_ws(" ", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"),
                      F.col("l_quantity").cast("string"), F.col("l_returnflag"),
                      F.col("l_linestatus"))
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        (F.col("l_shipdate").cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("l_linenumber").cast("decimal(8,6)"))
         ).alias("ts"),
        F.lit("/data/orders").alias("prefix"),
        F.concat(F.lit("./o"), (F.col("l_orderkey") % 1000).cast("string"), F.lit(".log")).alias("path"),
        msg.cast("binary").alias("buf"),
        F.octet_length(msg).cast("bigint").alias("size"),
        F.lit(0).cast("bigint").alias("offset"),
        (F.col("l_partkey") % 32768).cast("int").alias("pid"),
        (F.col("l_suppkey") % 1500).cast("int").alias("uid"),
        (F.col("l_suppkey") % 30).cast("int").alias("gid"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("uid"), F.col("c_name").alias("name"))


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("gid"), F.col("n_name").alias("name"))


def procs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("pid"),
        F.concat(F.col("p_name"), F.lit("\x00"), F.col("p_brand"), F.lit("\x00")).alias("cmdline"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                             F.lit(".txt")).alias("path"), F.col("text"))


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved read positions from an earlier pass: documents in German were not
    there yet (unknown path); the others sit at 0, mid-file (possibly inside a
    UTF-8 character) or past the end (the file was truncated since)."""
    d = table(spark, sf_dir, "documents").where(F.col("lang") != "de")
    off = (F.when(F.col("doc_id") % 3 == 0, F.lit(0))
           .when(F.col("doc_id") % 3 == 1, F.floor(F.octet_length("text") / 2))
           .otherwise(F.octet_length("text") + 10)).cast("bigint")
    return d.select(F.concat(F.lit("/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                             F.lit(".txt")).alias("path"), off.alias("offset"))


def config_versions(spark: SparkSession) -> DataFrame:
    """Live configuration history: each version applies from ``effective_from``."""
    return spark.createDataFrame(
        [("2024-01-05 00:00:00", "logs", "rack-7", "orders"),
         ("2024-01-12 00:00:00", "audit", "rack-8", "test"),
         ("2024-01-20 00:00:00", None, "rack-9", "prod")],
        "effective_from string, topic string, site string, tag string",
    ).select(F.col("effective_from").cast("timestamp").alias("effective_from"), "topic",
             "site", "tag")


def received(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("value") > 5).select(F.col("event_id").alias("id"))


def properties_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key=JSON`` property lines, one file per nation, one line per customer."""
    c = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
        F.col("c_nationkey") == F.col("n_nationkey"))
    kind = F.col("c_custkey") % 5
    seg = F.lower(F.col("c_mktsegment"))
    line = (F.when(kind == 0, F.concat(F.lit('agent_directories=["/var/log/'), seg, F.lit("/"),
                                       F.col("c_custkey").cast("string"), F.lit('"]')))
            .when(kind == 1, F.concat(F.lit('agent_fields={"segment": "'), F.col("c_mktsegment"),
                                      F.lit('", "account": "'), F.col("c_custkey").cast("string"),
                                      F.lit('"}')))
            .when(kind == 2, F.concat(F.lit('monitoring_logging_tags=["'), F.col("c_name"), F.lit('"]')))
            .when(kind == 3, F.concat(F.lit("agent_quota=["),
                                      F.floor(F.col("c_acctbal")).cast("bigint").cast("string"),
                                      F.lit("]")))
            .otherwise(F.concat(F.lit("# owner="), F.col("c_name"))))
    return c.select(
        F.concat(F.lit("/etc/weir/"), F.lower(F.col("n_name")), F.lit(".properties")).alias("file"),
        F.col("c_custkey").alias("line_no"),
        line.alias("line"),
    )


def argument_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One argument line per supplier (host), in the form a live reload writes."""
    s = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation").select("n_nationkey", "n_name"),
        F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey")
    base = F.concat(
        F.lit("--topic logs --fields site "), F.lower(F.col("n_name")),
        F.lit(" host s"), k.cast("string"),
        F.lit("  --directories /var/log/s"), k.cast("string"), F.lit(" /srv/app "),
        F.lit("--tags orders"))
    line = (F.when(k % 7 == 0, F.concat(base, F.lit(" --colour")))
            .when(k % 5 == 0, F.concat(base, F.lit(" --tags  prod "), F.col("n_name")))
            .when(k % 3 == 0, F.concat(F.lit("-x "), base, F.lit(" --persist ")))
            .otherwise(base))
    return s.select(k.alias("host_id"), line.alias("line"))


# ---------------------------------------------------------------------------
# SQL twins (DuckDB) for the oracle.
# ---------------------------------------------------------------------------

SQL = {
    "writes": """writes AS (
  SELECT event_id AS seq, ts, '/var/log' AS prefix,
         './' || event_type || '/u' || CAST(user_id AS VARCHAR) || '.log' AS path,
         props AS buf, CAST(strlen(props) AS BIGINT) AS size, CAST(0 AS BIGINT) AS "offset",
         CAST(event_id % 32768 AS INTEGER) AS pid,
         CAST(CASE WHEN event_id % 13 = 0 THEN user_id + 1000000 ELSE user_id END AS INTEGER) AS uid,
         CAST(user_id % 30 AS INTEGER) AS gid
  FROM events)""",
    "users": """users AS (SELECT CAST(c_custkey AS INTEGER) AS uid, c_name AS name FROM customer)""",
    "groups": """groups AS (SELECT n_nationkey AS gid, n_name AS name FROM nation)""",
    "procs": """procs AS (SELECT CAST(p_partkey AS INTEGER) AS pid,
                  p_name || chr(0) || p_brand || chr(0) AS cmdline FROM part)""",
    "files": """files AS (SELECT '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, text
           FROM documents)""",
    "offsets": """offsets AS (SELECT '/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
                  CAST(CASE WHEN doc_id % 3 = 0 THEN 0
                            WHEN doc_id % 3 = 1 THEN strlen(text) // 2
                            ELSE strlen(text) + 10 END AS BIGINT) AS "offset"
           FROM documents WHERE lang <> 'de')""",
    "config_versions": """config_versions AS (SELECT * FROM (VALUES
  (TIMESTAMP '2024-01-05 00:00:00', 'logs', 'rack-7', 'orders'),
  (TIMESTAMP '2024-01-12 00:00:00', 'audit', 'rack-8', 'test'),
  (TIMESTAMP '2024-01-20 00:00:00', NULL, 'rack-9', 'prod'))
  AS v(effective_from, topic, site, tag))""",
    "received": """received AS (SELECT event_id AS id FROM events WHERE value > 5)""",
    "properties_lines": """properties_lines AS (
  SELECT '/etc/weir/' || lower(n_name) || '.properties' AS file, c_custkey AS line_no,
         CASE c_custkey % 5
           WHEN 0 THEN 'agent_directories=["/var/log/' || lower(c_mktsegment) || '/' || CAST(c_custkey AS VARCHAR) || '"]'
           WHEN 1 THEN 'agent_fields={"segment": "' || c_mktsegment || '", "account": "' || CAST(c_custkey AS VARCHAR) || '"}'
           WHEN 2 THEN 'monitoring_logging_tags=["' || c_name || '"]'
           WHEN 3 THEN 'agent_quota=[' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) || ']'
           ELSE '# owner=' || c_name END AS line
  FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "argument_lines": """argument_lines AS (
  SELECT s_suppkey AS host_id,
         CASE WHEN s_suppkey % 7 = 0 THEN base || ' --colour'
              WHEN s_suppkey % 5 = 0 THEN base || ' --tags  prod ' || n_name
              WHEN s_suppkey % 3 = 0 THEN '-x ' || base || ' --persist '
              ELSE base END AS line
  FROM (SELECT s_suppkey, n_name,
               '--topic logs --fields site ' || lower(n_name) || ' host s' || CAST(s_suppkey AS VARCHAR)
               || '  --directories /var/log/s' || CAST(s_suppkey AS VARCHAR) || ' /srv/app --tags orders' AS base
        FROM supplier JOIN nation ON s_nationkey = n_nationkey))""",
}


def with_ctes(body: str, *names: str) -> str:
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n" + body
