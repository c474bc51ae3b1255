"""K5/X2 without duplicates: an outbox with a commit log.

``format("outbox")`` writes a stream's (or a batch frame's) rows in two steps. A task
*sends*: it writes its rows as one Parquet file under a name of its own and reports the name
in its commit message. The driver *commits*: one record per (query, epoch), created
atomically, lists the files of the epoch. ``read_outbox`` reads what the records list and
nothing else. So a task that fails, a driver that fails between send and commit, and an
epoch that runs again all leave files that no record lists; and an epoch that was
committed before its stream was told so is not committed twice.

Folder layout: ``data/<query>/<epoch>-<id>.parquet`` and ``commits/<query>/<epoch>.json``. It must be
shared storage whose "create if absent" is atomic (a local or network file system).
``vacuum_outbox`` removes files of epochs that no record lists and that are older than the
newest record's (an epoch still being written is newer).
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage


@dataclass
class Sent(WriterCommitMessage):
    """One task's file (relative to the outbox) and its rows; None: no rows."""

    file: str | None
    rows: int


def commit_record(root: str, query: str, epoch: int) -> str:
    return os.path.join(root, "commits", query, f"{epoch:012d}.json")


def send_rows(root: str, query: str, batches) -> Sent:
    """Write a task's record batches as one file. The file gets its name when it is whole."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    name = f"data/{query}/{uuid.uuid4().hex}.parquet"
    path, writer, rows = os.path.join(root, name), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if writer is None:
            os.makedirs(os.path.dirname(path), exist_ok=True)
            writer = pq.ParquetWriter(path + ".new", batch.schema)
        writer.write_table(pa.Table.from_batches([batch]))
        rows += batch.num_rows
    if writer is None:
        return Sent(None, 0)
    writer.close()
    os.replace(path + ".new", path)
    return Sent(name, rows)


def commit_epoch(root: str, query: str, epoch: int, messages) -> bool:
    """Create the epoch's record; False if it exists: then its rows are in the outbox already
    and the files of ``messages`` are removed."""
    files = [m.file for m in messages if m is not None and m.file]
    record = commit_record(root, query, epoch)
    os.makedirs(os.path.dirname(record), exist_ok=True)
    own = f"{record}.{uuid.uuid4().hex}"
    with open(own, "w", encoding="utf-8") as f:
        json.dump({"query": query, "epoch": epoch, "files": files, "rows": sum(m.rows for m in messages if m is not None)}, f)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(own, record)  # fails if the record exists
        return True
    except FileExistsError:
        discard(root, messages)
        return False
    finally:
        os.remove(own)


def discard(root: str, messages, record: str | None = None) -> None:
    """Remove the files of ``messages`` that ``record`` does not list."""
    listed = set()
    if record and os.path.exists(record):
        with open(record, encoding="utf-8") as f:
            listed = set(json.load(f)["files"])
    for m in messages:
        if m is not None and m.file and m.file not in listed:
            try:
                os.remove(os.path.join(root, m.file))
            except FileNotFoundError:
                pass


class _Options:
    def __init__(self, options):
        self.root = options["path"]
        self.query = options.get("query", "batch")
        # Tests only: end the driver's part between send and commit, or right behind the commit.
        self.fail = options.get("failOnce")

    def trip(self, where: str) -> None:
        if self.fail and self.fail.startswith(where + ":"):
            marker = self.fail.split(":", 1)[1]
            if not os.path.exists(marker):
                open(marker, "w").close()
                raise RuntimeError(f"stopped {where} the commit")


class OutboxStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options):
        self.to = _Options(options)

    def write(self, iterator):
        return send_rows(self.to.root, self.to.query, iterator)

    def commit(self, messages, batchId):
        self.to.trip("before")
        commit_epoch(self.to.root, self.to.query, batchId, messages)
        self.to.trip("behind")

    def abort(self, messages, batchId):
        # Called too when the driver fails behind the commit.
        discard(self.to.root, messages, commit_record(self.to.root, self.to.query, batchId))


class OutboxWriter(DataSourceArrowWriter):
    """A batch frame: the epoch is an option (0), so the caller's retries do not double it."""

    def __init__(self, options):
        self.to = _Options(options)
        self.epoch = int(options.get("epoch", 0))

    def write(self, iterator):
        return send_rows(self.to.root, self.to.query, iterator)

    def commit(self, messages):
        self.to.trip("before")
        commit_epoch(self.to.root, self.to.query, self.epoch, messages)

    def abort(self, messages):
        discard(self.to.root, messages, commit_record(self.to.root, self.to.query, self.epoch))


class OutboxDataSource(DataSource):
    @classmethod
    def name(cls):
        return "outbox"

    def writer(self, schema, overwrite):
        return OutboxWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return OutboxStreamWriter(self.options)


def register_outbox(spark: SparkSession) -> None:
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(OutboxDataSource)


def write_outbox(df: DataFrame, path: str, query: str, checkpoint: str | None = None, epoch: int = 0,
                 trigger: dict | None = None, **options):
    """Send a stream (one epoch a micro-batch) or a batch frame (``epoch``) to an outbox.
    ``query`` names the sender: its epochs are committed once each."""
    register_outbox(df.sparkSession)
    if not query or "/" in query or query.startswith("."):
        raise ValueError(f"not a name for a folder: {query!r}")
    w = df.writeStream if df.isStreaming else df.write.mode("append")
    w = w.format("outbox").option("path", path).option("query", query).option("epoch", str(epoch))
    for k, v in options.items():
        w = w.option(k, str(v))
    if not df.isStreaming:
        return w.save()
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def committed(path: str) -> list[dict]:
    """All commit records, in order of query and epoch."""
    out = []
    base = os.path.join(path, "commits")
    for query in sorted(os.listdir(base)) if os.path.isdir(base) else ():
        for name in sorted(os.listdir(os.path.join(base, query))):
            if name.endswith(".json"):
                with open(os.path.join(base, query, name), encoding="utf-8") as f:
                    out.append(json.load(f))
    return out


def read_outbox(spark: SparkSession, path: str, schema) -> DataFrame:
    """The committed rows. The records are read as a table; only the list of files they
    name comes to the driver, as for any table format's manifest."""
    files = [os.path.join(path, f) for r in committed(path) for f in r["files"]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def vacuum_outbox(path: str, query: str) -> int:
    """Remove a query's files that no record lists, older than its newest record."""
    mine = [r for r in committed(path) if r["query"] == query]
    folder = os.path.join(path, "data", query)
    if not mine or not os.path.isdir(folder):
        return 0
    newest = os.path.getmtime(commit_record(path, query, max(r["epoch"] for r in mine)))
    listed = {os.path.basename(f) for r in mine for f in r["files"]}
    gone = 0
    for name in os.listdir(folder):
        p = os.path.join(folder, name)
        if name not in listed and os.path.getmtime(p) < newest:
            os.remove(p)
            gone += 1
    return gone
