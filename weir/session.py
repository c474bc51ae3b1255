"""Session helpers: the few SQL settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job of this package expects. All are runtime SQL confs, so they
# can be applied to a session someone else built (the driver, a notebook).
SESSION_CONFS = {
    # Timestamps are rendered as UTC wall time ('+0000').
    "spark.sql.session.timeZone": "UTC",
    # base64() must not insert CRLF every 76 characters (wire format C1).
    "spark.sql.chunkBase64String.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONFS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``weir`` importable in every executor's Python workers (pandas UDFs
    and stateful processors are pickled by reference): zip the package once per
    SparkContext and ``addPyFile`` it. A deployment that already ships the
    package (``--py-files``, an installed wheel) is left alone."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    _SHIPPED.add(key)
    if sc.getConf().get("spark.submit.pyFiles", ""):
        return
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="weir-pyfiles-"), "weir.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _dirs, names in os.walk(pkg):
            if "__pycache__" in d:
                continue
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir`` (set by whoever runs the cluster). Only
    where it is unset and the session is local -- tests, the bench -- a fresh
    scratch folder is taken; on a cluster an unset folder is an error, since a
    folder of the driver's machine is not shared.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="weir-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df):
    """Cut the lineage of a frame that several branches of a plan read: an
    eager, reliable ``checkpoint()`` into the cluster's checkpoint folder (it
    survives executor loss, unlike a cache or a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def once(df: DataFrame) -> DataFrame:
    """Evaluate the (expensive) columns of ``df`` exactly once per row.

    A later filter on such a column would otherwise be pushed below the
    projection with the expression copied into it (JSON parsing, encoding),
    and a column read several times would be recomputed. ``inline`` of a
    one-element array is a generator, which predicates and projections do not
    cross; it emits the same single row.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "weir", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("WEIR_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("WEIR_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in {**SESSION_CONFS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
