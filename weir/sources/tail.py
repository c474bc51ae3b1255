"""Follow growing files as a Structured Streaming source.

``spark.readStream.format("tail").option("path", "/a,/b").load()`` emits one row
per new line of every file under the watched directories. The built-in file
source reads a file once and never sees appends, hence this Python data source.

* Offset: ``{"files": {path: byte_end}}`` -- the checkpointed offset map is the
  reference's "last offset" table, so a restart resumes where it stopped.
* ``latestOffset`` lists the directories (recursively unless
  ``recursive=false``), so files and directories created later are picked up
  and start at byte 0; vanished files are forgotten.
* ``startingOffsets``: ``latest`` (files present at start begin at their end)
  or ``earliest`` (everything from byte 0).
* A file now shorter than its offset was truncated: it is read again from 0.
* ``partitions`` gives every changed file its own partitions; a big range is
  cut into ``splitBytes`` slices aligned on newlines by the reader (a slice
  owns the lines that start inside it), so one huge file is read in parallel.
* ``wholeLines=true`` holds back a last line without newline until it is
  complete (the offset stops before it, from the first batch on).
* ``maxBytesPerTrigger`` caps how far the offsets move in one micro-batch,
  stopping on line boundaries. The budget is shared among the files that have
  something unread, those served longest ago first, so busy files do not starve
  others. The API does not tell a source its start before it plans an end, so
  the source notes each planned end in ``progressPath`` (a small file) before
  Spark logs it, and counts the budget from there after a restart; what is read
  is decided by Spark's own offsets alone. Without ``progressPath`` the first
  batch after a (re)start is not capped.
* A file under several roots comes once per root, as with two watches.
* ``message`` is BINARY: the bytes of the line as they are. Lines are read in
  blocks and handed over as Arrow record batches.

Without ``manifestPath`` every offset holds the whole map of files: fine for some
thousands. ``weir.sources.manifest`` has the form for millions, with roots that change
while the stream runs, and the batch reader of the same format.

Executors must see the same paths as the driver (shared storage).
"""

from __future__ import annotations

import os

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

TAIL_SCHEMA = "prefix string, path string, offset bigint, nbytes bigint, message binary, ts timestamp"


def _truthy(v, default=False):
    if v is None:
        return default
    return str(v).lower() in ("1", "true", "yes")


def list_files(roots, recursive=True):
    """``{path: (root, size)}`` for the regular files under the roots."""
    out = {}
    for root in roots:
        if not os.path.isdir(root):
            continue
        if recursive:
            for d, _dirs, names in os.walk(root):
                for n in names:
                    p = os.path.join(d, n)
                    try:
                        out[p] = (root, os.path.getsize(p))
                    except OSError:
                        pass
        else:
            for n in os.listdir(root):
                p = os.path.join(root, n)
                if os.path.isfile(p):
                    out[p] = (root, os.path.getsize(p))
    return out


def last_newline_end(path, lo, hi, block=1 << 16):
    """Byte position just after the last '\\n' in ``[lo, hi)``, or ``lo``."""
    with open(path, "rb") as f:
        pos = hi
        while pos > lo:
            start = max(lo, pos - block)
            f.seek(start)
            chunk = f.read(pos - start)
            i = chunk.rfind(b"\n")
            if i >= 0:
                return start + i + 1
            pos = start
    return lo


def next_newline_end(path, lo, hi, block=1 << 16):
    """Byte position just after the first '\\n' at or after ``lo`` (below ``hi``),
    or ``hi``."""
    with open(path, "rb") as f:
        pos = lo
        while pos < hi:
            f.seek(pos)
            chunk = f.read(min(block, hi - pos))
            if not chunk:
                break
            i = chunk.find(b"\n")
            if i >= 0:
                return pos + i + 1
            pos += len(chunk)
    return hi


def roots_of(path, roots, recursive):
    """The roots that watch a file, in the order given."""
    out = []
    for r in roots:
        base = r.rstrip("/") + "/"
        if path.startswith(base) and (recursive or "/" not in path[len(base):]):
            out.append(r)
    return out


class TailPartition(InputPartition):
    """Bytes ``[lo, hi)`` of the new range ``[.., end)`` of one file: the slice
    owns every line that starts inside it (the first slice starts a line)."""

    def __init__(self, path, prefix, lo, hi, end, first):
        super().__init__((path, lo, hi))
        self.path = path
        self.prefix = prefix
        self.lo = lo
        self.hi = hi
        self.end = end
        self.first = first


def read_slice(partition):
    """The lines of one slice, as Arrow record batches."""
    import time

    import pyarrow as pa

    # Emission time: the read time, one microsecond apart per line, so lines
    # read together still have distinct, ordered times (as events stamped
    # one by one would).
    base_us = time.time_ns() // 1000
    schema = pa.schema([("prefix", pa.string()), ("path", pa.string()), ("offset", pa.int64()), ("nbytes", pa.int64()),
                        ("message", pa.binary()), ("ts", pa.timestamp("us", "UTC"))])
    n = 0
    if partition.lo >= partition.hi:
        return
    with open(partition.path, "rb") as f:
        pos = partition.lo
        if not partition.first:
            # The line running through ``lo`` belongs to the previous slice.
            f.seek(pos - 1)
            if f.read(1) != b"\n":
                f.readline()
                pos = f.tell()
        f.seek(pos)
        stop = min(partition.hi, partition.end)
        while pos < stop:
            # The lines of a block; the last one may run past it.
            block = f.read(min(1 << 20, stop - pos))
            if not block:
                break
            if not block.endswith(b"\n"):
                block += f.readline(max(0, partition.end - pos - len(block)))
            lines = block.split(b"\n")
            last = lines.pop()
            lines = [x + b"\n" for x in lines] + ([last] if last else [])
            sizes = [len(x) for x in lines]
            offsets = []
            for size in sizes:
                offsets.append(pos)
                pos += size
            k = len(lines)
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.prefix] * k, pa.string()), pa.array([partition.path] * k, pa.string()),
                 pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()), pa.array(lines, pa.binary()),
                 pa.array(range(base_us + n, base_us + n + k), pa.int64()).cast(pa.timestamp("us", "UTC"))], schema=schema)
            n += k


class TailStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.roots = [p for p in options.get("path", "").split(",") if p]
        self.recursive = _truthy(options.get("recursive"), True)
        self.starting = options.get("startingOffsets", "latest")
        self.whole_lines = _truthy(options.get("wholeLines"), False)
        self.split_bytes = int(options.get("splitBytes", 64 << 20))
        self.max_bytes = int(options.get("maxBytesPerTrigger", 0)) or None
        self.progress_path = options.get("progressPath")
        self._last = None
        self._turn = 0
        self._served = {}

    def _snapshot(self, previous):
        """New end offsets. ``previous``: the ends planned last, or after a restart
        those noted at the last commit (None: unknown, everything is due)."""
        files = list_files(self.roots, self.recursive)
        ends, pending = {}, []
        for p, (_root, size) in files.items():
            start = (previous or {}).get(p, 0)
            if size < start:
                start = 0  # truncated
            end = last_newline_end(p, start, size) if self.whole_lines and size > start else size
            ends[p] = start
            if end > start:
                pending.append((self._served.get(p, -1), p, start, end))
        if self.max_bytes is None or previous is None:
            ends.update({p: end for _, p, _, end in pending})
            return ends
        self._turn += 1
        budget = self.max_bytes
        share = max(1, self.max_bytes // max(1, len(pending)))
        for _, p, start, end in sorted(pending):
            if budget <= 0:
                break
            capped = min(end, start + min(share, budget))
            if capped < end:
                # Stop on a line boundary: before the cut line, or -- when a
                # single line is longer than the share -- after it.
                capped = last_newline_end(p, start, capped)
                if capped == start:
                    capped = next_newline_end(p, start + min(share, budget), end)
                    if self.whole_lines:
                        capped = min(capped, end)
            ends[p] = capped
            budget -= capped - start
            self._served[p] = self._turn
        return ends

    def _noted(self):
        """The end planned last by an earlier run; where there was none, the
        initial offset; None if no ends are noted."""
        import json

        if not self.progress_path:
            return None
        try:
            with open(self.progress_path, encoding="utf-8") as f:
                return json.load(f)["files"]
        except FileNotFoundError:
            return self.initialOffset()["files"]

    def _note(self, end):
        import json

        with open(self.progress_path + ".new", "w", encoding="utf-8") as f:
            json.dump(end, f)
        os.replace(self.progress_path + ".new", self.progress_path)

    def initialOffset(self):
        # Does not touch the planned state: Spark may call it after the first
        # latestOffset(), and on a restart not at all.
        if self.starting == "earliest":
            return {"files": {}}
        files = list_files(self.roots, self.recursive)
        return {"files": {p: last_newline_end(p, 0, size) if self.whole_lines else size
                          for p, (_r, size) in files.items()}}

    def latestOffset(self):
        prev = self._last["files"] if self._last is not None else self._noted()
        self._last = {"files": self._snapshot(prev)}
        if self.progress_path:
            self._note(self._last)
        return self._last

    def partitions(self, start, end):
        s_files = start.get("files", {})
        parts = []
        for p, e in sorted(end.get("files", {}).items()):
            s = s_files.get(p, 0)
            if e < s:
                # Planned below the start: truncated since, or (planned without
                # knowing the start) nothing new. The file's size tells.
                if os.path.exists(p) and os.path.getsize(p) >= s:
                    continue
                s = 0
            for prefix in roots_of(p, self.roots, self.recursive):
                lo = s
                while lo < e:
                    hi = min(e, lo + self.split_bytes)
                    parts.append(TailPartition(p, prefix, lo, hi, e, lo == s))
                    lo = hi
        return parts

    def read(self, partition):
        return read_slice(partition)

    def commit(self, end):
        pass


class TailDataSource(DataSource):
    """``format("tail")``: new lines of files under watched directories."""

    @classmethod
    def name(cls):
        return "tail"

    def schema(self):
        return TAIL_SCHEMA

    #: The batch reader and the manifest's reader, set by ``register``: classes, so that
    #: they travel with this one.
    readers: tuple = ()

    def reader(self, schema):
        return self.readers[0](self.options)

    def streamReader(self, schema):
        return (self.readers[1] if self.options.get("manifestPath") else TailStreamReader)(self.options)


def register(spark):
    # The data source instance is created in a driver-side Python worker that
    # does not see ``--py-files``; ship this module's code by value.
    import sys

    from pyspark import cloudpickle

    from weir.sources import manifest

    for module in (sys.modules[__name__], manifest):
        cloudpickle.register_pickle_by_value(module)
    TailDataSource.readers = (manifest.BatchReader, manifest.ManifestReader)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TailDataSource)
    return spark


def tail_stream(spark, paths, starting="latest", recursive=True, whole_lines=False, **options):
    """Streaming frame of new lines under ``paths`` (S3, S7 when several)."""
    register(spark)
    if isinstance(paths, str):
        paths = [paths]
    r = (spark.readStream.format("tail").option("path", ",".join(paths))
         .option("startingOffsets", starting).option("recursive", str(recursive).lower())
         .option("wholeLines", str(whole_lines).lower()))
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()
