"""Batch jobs as a Spark user submits them.

``python -m weir.plans.jobs capture --input <writes parquet> --output <dir>``
runs the capture pipeline (globs, quota, lookups, as-of configuration,
encoding) over a table of captured writes and writes the wire records as
parquet partitioned by ``rejected`` (dead letters, with their reason) and topic,
in one pass.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import codec, enrich, filters, quota
from weir.session import configure


def capture(spark: SparkSession, writes: DataFrame, output: str, excludes=(), rate: float | None = None,
            users: DataFrame | None = None, groups: DataFrame | None = None, procs: DataFrame | None = None,
            config_versions: DataFrame | None = None, encoder: str = "logstash_base64") -> None:
    configure(spark)
    w = filters.exclude_paths(writes, list(excludes)) if excludes else writes
    w = quota.rate_limit(w, rate)
    w = enrich.enrich(w, users, groups, procs)
    if config_versions is not None:
        w = enrich.with_config(w, config_versions)
        w = w.withColumn("fields", F.when(F.col("site").isNotNull(),
                                          F.create_map(F.lit("site"), F.col("site"))))
        w = w.withColumn("tags", F.when(F.col("tag").isNotNull(), F.array(F.col("tag"))))
    w = enrich.route_topic(w)
    marked = codec.encode_marked(w, encoder, keep=("seq",))
    marked.withColumn("rejected", F.col("reason").isNotNull()) \
        .write.mode("overwrite").partitionBy("rejected", "topic").parquet(output)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="weir")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("capture")
    c.add_argument("--input", required=True, help="parquet table of captured writes (schema 1.2)")
    c.add_argument("--output", required=True)
    c.add_argument("--exclude", action="append", default=[])
    c.add_argument("--quota", type=float, default=None)
    c.add_argument("--users")
    c.add_argument("--groups")
    c.add_argument("--procs")
    c.add_argument("--config-versions")
    c.add_argument("--encoder", default="logstash_base64")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("weir-capture").getOrCreate()

    def opt(path):
        return spark.read.parquet(path) if path else None

    capture(spark, spark.read.parquet(a.input), a.output, a.exclude, a.quota, opt(a.users), opt(a.groups),
            opt(a.procs), opt(a.config_versions), a.encoder)


if __name__ == "__main__":
    main()
