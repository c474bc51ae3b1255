"""The tail source at scale: an incremental manifest, live roots, and a batch reader.

With ``manifestPath`` the stream's offset is a pointer, ``{"v": version, "epoch": roots}``, into
a log in a folder on shared storage (keep one per query, beside its checkpoint):

* ``d-<v>.json``: what one planned end adds: per changed file the bytes ``[lo, hi)``, and the
  files that vanished. A micro-batch is planned from the versions between its two
  offsets, so planning costs what changed, and a replayed batch reads the same ranges.
* ``s-<v>.json``: all files and their ends, every ``SNAPSHOT_EVERY`` versions; a restart reads
  the last one and the versions behind it. Older files are deleted when a commit has
  gone past them.
* ``r-<epoch>.json``: the watched roots from some version on.

``rootsPath`` names the control table of the roots: a text file (one directory a line) or a
folder of parquet files with a column ``dir``. It is read again at every trigger; when it
changes, the epoch goes up: directories not under a watched one start (existing files
where ``startingOffsets`` says), directories no longer listed stop, files and all, the others
go on undisturbed. The epoch is in the offset, so a restart knows what was watched.

A directory is listed again only when its modification time says so. ``coldScanSeconds``
does the same for files: a file that did not grow for so long is looked at in turns,
each once in so many seconds, so a trigger costs in proportion to the files that change
(default 0: every file at every trigger).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql.datasource import DataSourceReader, DataSourceStreamReader, EqualTo, In, StringStartsWith

from weir.sources.tail import TailPartition, _truthy, last_newline_end, next_newline_end, read_slice, roots_of

SNAPSHOT_EVERY = 64
#: A directory changed this recently may change again without a newer time.
SETTLED_NS = 2_000_000_000


def normal_root(path: str) -> str:
    return os.path.normpath(os.path.join("/", path))


def read_roots(path: str) -> list[str]:
    """The directories of a control table, normalised, each once."""
    if os.path.isdir(path):
        import pyarrow.dataset as ds

        found = [d for d in ds.dataset(path, format="parquet").to_table(columns=["dir"]).column("dir").to_pylist() if d]
    else:
        with open(path, encoding="utf-8") as f:
            found = [line.strip() for line in f if line.strip()]
    return list(dict.fromkeys(normal_root(d) for d in found))


def next_roots(watched: list[str], configured: list[str]) -> list[str]:
    """The roots after a reload (U3): watched ones that are still configured, and configured
    ones that do not lie in a watched one (by whole names: ``/log2`` is not in ``/log``)."""
    stay = [r for r in watched if r in configured]
    for r in configured:
        if not any((r + "/").startswith(w.rstrip("/") + "/") for w in stay):
            stay.append(r)
    return stay


class Listing:
    """The files under some roots, listed again where directories changed."""

    def __init__(self, recursive: bool, cold_seconds: float = 0):
        self.recursive, self.cold_seconds = recursive, cold_seconds
        self.dirs: dict[str, tuple[int, list[str], list[str]]] = {}
        self.sizes: dict[str, int] = {}
        self.grew: dict[str, float] = {}
        self.turn: list[str] = []
        self.last = None
        self.looked = 0

    def _dir(self, d: str, now_ns: int):
        try:
            mtime = os.stat(d).st_mtime_ns
        except OSError:
            self.dirs.pop(d, None)
            return None
        known = self.dirs.get(d)
        if known is None or known[0] != mtime or now_ns - mtime < SETTLED_NS:
            subs, names = [], []
            try:
                with os.scandir(d) as entries:
                    for e in entries:
                        if e.is_dir(follow_symlinks=False):
                            subs.append(e.path)
                        elif e.is_file():
                            names.append(e.path)
            except OSError:
                return None
            known = self.dirs[d] = (mtime, subs, names)
        return known

    def scan(self, roots: list[str]) -> dict[str, int]:
        """``{path: size}``; a cold file whose turn has not come keeps its last size."""
        now = time.time()
        names: dict[str, None] = {}
        for root in roots:
            todo, ns = [root], int(now * 1e9)
            while todo:
                known = self._dir(todo.pop(), ns)
                if known:
                    names.update(dict.fromkeys(known[2]))
                    if self.recursive:
                        todo.extend(known[1])
        due = None
        if self.cold_seconds and self.last is not None:
            # As many cold files as their turn brings in the time since the last look.
            if not self.turn:
                self.turn = list(self.sizes)
            n = int(len(self.sizes) * (now - self.last) / self.cold_seconds) + 1
            due, self.turn = set(self.turn[-n:]), self.turn[:-n]
        self.last, self.looked = now, 0
        out = {}
        for p in names:
            if due is not None and p in self.sizes and p not in due and now - self.grew.get(p, 0) > self.cold_seconds:
                out[p] = self.sizes[p]
                continue
            self.looked += 1
            try:
                out[p] = os.stat(p).st_size
            except OSError:
                continue
            if out[p] != self.sizes.get(p):
                self.grew[p] = now
        self.sizes = out
        self.grew = {p: t for p, t in self.grew.items() if p in out}
        return dict(out)


class Manifest:
    """The log in ``folder``: versions, snapshots and roots."""

    def __init__(self, folder: str):
        self.folder = folder
        os.makedirs(folder, exist_ok=True)

    def _name(self, kind: str, n: int) -> str:
        return os.path.join(self.folder, f"{kind}-{n:012d}.json")

    def put(self, kind: str, n: int, what: dict) -> None:
        name = self._name(kind, n)
        with open(name + ".new", "w", encoding="utf-8") as f:
            json.dump(what, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name + ".new", name)

    def get(self, kind: str, n: int) -> dict:
        with open(self._name(kind, n), encoding="utf-8") as f:
            return json.load(f)

    def numbers(self, kind: str) -> list[int]:
        return sorted(int(n[2:-5]) for n in os.listdir(self.folder) if n.startswith(kind + "-") and n.endswith(".json"))

    def load(self) -> dict | None:
        """The newest state: ``v, epoch, ends`` (None: an empty log)."""
        snaps = self.numbers("s")
        if not snaps:
            return None
        state = self.get("s", snaps[-1])
        for v in self.numbers("d"):
            if v > state["v"]:
                apply_delta(state, self.get("d", v))
        return state

    def drop_before(self, v: int) -> None:
        for kind in "ds":
            for n in self.numbers(kind):
                if n < v:
                    os.remove(self._name(kind, n))


def apply_delta(state: dict, delta: dict) -> None:
    for p in delta["gone"]:
        state["ends"].pop(p, None)
    for p, (_, hi) in delta["files"].items():
        state["ends"][p] = hi
    state["v"], state["epoch"] = delta["v"], delta["epoch"]


class ManifestReader(DataSourceStreamReader):
    def __init__(self, options):
        self.fixed = [p for p in options.get("path", "").split(",") if p]
        self.roots_path = options.get("rootsPath")
        self.starting = options.get("startingOffsets", "latest")
        self.whole_lines = _truthy(options.get("wholeLines"), False)
        self.split_bytes = int(options.get("splitBytes", 64 << 20))
        self.max_bytes = int(options.get("maxBytesPerTrigger", 0)) or None
        self.recursive = _truthy(options.get("recursive"), True)
        self.log = Manifest(options["manifestPath"])
        self.listing = Listing(self.recursive, float(options.get("coldScanSeconds", 0)))
        self.state: dict | None = None
        self.roots: list[str] = []
        self._served: dict[str, int] = {}
        self._snapped = 0

    def _configured(self) -> list[str]:
        return read_roots(self.roots_path) if self.roots_path else self.fixed

    def _begin(self) -> None:
        """The state of an earlier run, or version 0: the files there are, where reading starts."""
        if self.state is not None:
            return
        self.state = self.log.load()
        if self.state is None:
            self.roots = next_roots([], self._configured()) if self.roots_path else self.fixed
            self.log.put("r", 0, {"roots": self.roots})
            sizes = self.listing.scan(self.roots) if self.starting != "earliest" else {}
            self.state = {"v": 0, "epoch": 0, "ends": {p: self._end(p, 0, n) for p, n in sizes.items()}}
            self.log.put("s", 0, self.state)
        else:
            self.roots = self.log.get("r", self.state["epoch"])["roots"]
        self._snapped = self.log.numbers("s")[-1]

    def _end(self, path: str, start: int, size: int) -> int:
        return last_newline_end(path, start, size) if self.whole_lines and size > start else size

    def _pointer(self) -> dict:
        return {"v": self.state["v"], "epoch": self.state["epoch"]}

    def initialOffset(self):
        self._begin()
        # What was watched first; a query whose first batch was never logged starts here again.
        return {"v": 0, "epoch": 0}

    def latestOffset(self):
        self._begin()
        ends, epoch = self.state["ends"], self.state["epoch"]
        roots = next_roots(self.roots, self._configured()) if self.roots_path else self.roots
        started = [r for r in roots if r not in self.roots]
        if roots != self.roots:
            epoch += 1
            self.log.put("r", epoch, {"roots": roots})
        sizes = self.listing.scan(roots)
        files, pending = {}, []
        for p, size in sizes.items():
            start = ends.get(p)
            if start is None:
                start = 0
                if self.starting != "earliest" and roots_of(p, started, self.recursive) and not roots_of(
                        p, [r for r in roots if r not in started], self.recursive):
                    files[p] = [self._end(p, 0, size)] * 2  # was there when its directory was added
                    continue
            elif size == start:
                continue
            elif size < start:
                start = 0  # truncated
                files[p] = [0, 0]
            end = self._end(p, start, size)
            if end > start:
                pending.append((self._served.get(p, -1), p, start, end))
            elif p not in ends:
                files[p] = [0, 0]
        files.update(self._shares(pending))
        gone = [p for p in ends if p not in sizes]
        if files or gone or epoch != self.state["epoch"]:
            delta = {"v": self.state["v"] + 1, "epoch": epoch, "files": files, "gone": gone}
            self.log.put("d", delta["v"], delta)
            apply_delta(self.state, delta)
            self.roots = roots
        return self._pointer()

    def _shares(self, pending: list[tuple]) -> dict[str, list[int]]:
        """What of the unread ranges this end takes: all, or ``maxBytesPerTrigger`` shared among
        the files, those served longest ago first, cut on line borders."""
        if self.max_bytes is None:
            return {p: [lo, hi] for _, p, lo, hi in pending}
        out = {}
        budget, share = self.max_bytes, max(1, self.max_bytes // max(1, len(pending)))
        for _, p, lo, hi in sorted(pending):
            if budget <= 0:
                break
            cut = min(hi, lo + min(share, budget))
            if cut < hi:
                cut = last_newline_end(p, lo, cut)
                if cut == lo:
                    cut = min(next_newline_end(p, lo + min(share, budget), hi), hi)
            out[p] = [lo, cut]
            budget -= cut - lo
            self._served[p] = self.state["v"] + 1
        return out

    def partitions(self, start, end):
        parts = []
        for v in range(start["v"] + 1, end["v"] + 1):
            delta = self.log.get("d", v)
            roots = self.log.get("r", delta["epoch"])["roots"] if delta["files"] else []
            for p, (lo, hi) in sorted(delta["files"].items()):
                for prefix in roots_of(p, roots, self.recursive) if hi > lo else ():
                    parts.extend(slices(p, prefix, lo, hi, self.split_bytes))
        return parts

    def read(self, partition):
        return read_slice(partition)

    def commit(self, end):
        if end["v"] - self._snapped >= SNAPSHOT_EVERY:
            self._begin()
            before = self._snapped
            self.log.put("s", self.state["v"], self.state)
            self._snapped = self.state["v"]
            self.log.drop_before(before)


def slices(path: str, prefix: str, lo: int, hi: int, split_bytes: int) -> list[TailPartition]:
    return [TailPartition(path, prefix, at, min(hi, at + split_bytes), hi, at == lo) for at in range(lo, hi, split_bytes)]


def _json_lines(folder: str) -> dict[str, int]:
    """``path, offset`` records of a folder of JSON lines."""
    out = {}
    for name in sorted(os.listdir(folder)):
        if not name.startswith(("_", ".")):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                out.update({r["path"]: r["offset"] for r in map(json.loads, f)})
    return out


class BatchReader(DataSourceReader):
    """S1/S2 over real files: ``spark.read.format("tail")``. Files are cut into slices of
    ``splitBytes`` on newlines. ``offsetsPath`` and ``endsPath``: folders of JSON lines
    ``{"path", "offset"}`` with the bytes to start and to stop at (see ``tail_batch``). Filters on
    ``path`` and ``prefix`` (equal, in, starts with) decide before a file is opened."""

    def __init__(self, options):
        roots = options.get("rootsPath")
        self.roots = read_roots(roots) if roots else [p for p in options.get("path", "").split(",") if p]
        self.recursive = _truthy(options.get("recursive"), True)
        self.whole_lines = _truthy(options.get("wholeLines"), False)
        self.split_bytes = int(options.get("splitBytes", 64 << 20))
        self.starting = options.get("startingOffsets", "earliest")
        self.offsets_path, self.ends_path = options.get("offsetsPath"), options.get("endsPath")
        self.tests: list = []

    def pushFilters(self, filters):
        for f in filters:
            known = len(getattr(f, "attribute", ())) == 1 and f.attribute[0] in ("path", "prefix")
            if known and isinstance(f, (EqualTo, In, StringStartsWith)):
                self.tests.append((f.attribute[0], type(f).__name__, getattr(f, "value", getattr(f, "values", None))))
            else:
                yield f

    def _wanted(self, path: str, prefix: str) -> bool:
        for column, kind, value in self.tests:
            x = path if column == "path" else prefix
            if not (x == value if kind == "EqualTo" else x in value if kind == "In" else x.startswith(value)):
                return False
        return True

    def ranges(self) -> dict[str, tuple[int, int]]:
        """``{path: (start, end)}`` of all files that some root watches and the filters want."""
        starts = _json_lines(self.offsets_path) if self.offsets_path else {}
        ends = _json_lines(self.ends_path) if self.ends_path else None
        sizes = ends if ends is not None else Listing(self.recursive).scan(self.roots)
        out = {}
        for p, size in sizes.items():
            if not any(self._wanted(p, r) for r in roots_of(p, self.roots, self.recursive)):
                continue
            lo = starts.get(p, 0 if self.starting == "earliest" else size)
            lo = 0 if size < lo else lo
            hi = size if ends is not None or not self.whole_lines or size <= lo else last_newline_end(p, lo, size)
            out[p] = (lo, hi)
        return out

    def partitions(self):
        parts = []
        for p, (lo, hi) in sorted(self.ranges().items()):
            for prefix in roots_of(p, self.roots, self.recursive):
                if self._wanted(p, prefix):
                    parts.extend(slices(p, prefix, lo, hi, self.split_bytes))
        return parts or [TailPartition("", "", 0, 0, 0, True)]

    def read(self, partition):
        return read_slice(partition)


def tail_batch(spark, paths, offsets=None, starting: str = "earliest", recursive: bool = True, whole_lines: bool = False, **options):
    """``(lines, new_offsets)`` of real files, as ``sources.lines.tail_from_offsets`` gives them for
    a table of texts. ``offsets``: a frame ``path, offset`` of an earlier call. The ends are
    fixed here and written to the shared folder, so lines and offsets agree however the
    files grow meanwhile."""
    import uuid

    from pyspark.sql import functions as F

    from weir.session import checkpoint_dir
    from weir.sources.tail import register

    register(spark)
    base = f"{checkpoint_dir(spark).rstrip('/')}/tail-{uuid.uuid4().hex}".removeprefix("file://").removeprefix("file:")
    given = {"path": ",".join([paths] if isinstance(paths, str) else paths), "startingOffsets": starting,
             "recursive": str(recursive).lower(), "wholeLines": str(whole_lines).lower(), **{k: str(v) for k, v in options.items()}}
    if offsets is not None:
        offsets.select("path", F.col("offset").cast("long")).write.json(f"{base}/starts")
        given["offsetsPath"] = f"{base}/starts"
    os.makedirs(f"{base}/ends")
    with open(f"{base}/ends/part.json", "w", encoding="utf-8") as f:
        for p, (_, hi) in BatchReader(given).ranges().items():
            f.write(json.dumps({"path": p, "offset": hi}) + "\n")
    reader = spark.read.format("tail")
    for k, v in {**given, "endsPath": f"{base}/ends"}.items():
        reader = reader.option(k, v)
    return reader.load(), spark.read.schema("path string, offset long").json(f"{base}/ends")
