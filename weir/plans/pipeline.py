"""The flagship capture-to-consumer pipeline, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.operators import codec, delivery, enrich, filters, quota
from weir.plans import fixtures as fx
from weir.session import configure

FLAGSHIP_EXCLUDES = ["./error/*"]
FLAGSHIP_QUOTA = 0.0001


def capture_to_wire(spark: SparkSession, sf_dir: str, writes: DataFrame | None = None) -> DataFrame:
    """Writes -> exclude -> quota -> enrich (lookups, as-of config) -> base64 JSON."""
    w = writes if writes is not None else fx.writes(spark, sf_dir)
    w = filters.exclude_paths(w, FLAGSHIP_EXCLUDES)
    w = quota.rate_limit(w, FLAGSHIP_QUOTA)
    w = enrich.enrich(w, fx.users(spark, sf_dir), fx.groups(spark, sf_dir), fx.procs(spark, sf_dir))
    w = enrich.with_config(w, fx.config_versions(spark))
    w = w.withColumn("fields", F.when(F.col("site").isNotNull(),
                                      F.create_map(F.lit("site"), F.col("site"))))
    w = w.withColumn("tags", F.when(F.col("tag").isNotNull(), F.array(F.col("tag"))))
    w = enrich.route_topic(w)
    good, _ = codec.encode(w, "logstash_base64", keep=("seq",))
    return good


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    events, _ = codec.decode(capture_to_wire(spark, sf_dir), keep=["seq"])
    return delivery.volume_by_path(events)
