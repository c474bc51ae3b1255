"""Operator 13, embedding near-dedup: sorted projection passes.

Rows with the same label and the same vector are one *class* from the start (a
partial aggregate, so a vector that holds a third of all rows is one row). Each
pass signs a class's vector against ``BITS`` random hyperplanes of its own; the
signs, concatenated, are its code. All classes are range-sorted by (label,
dimension, code) and every one is compared, by cosine in double precision, with the
``WINDOW`` classes before it. A task sends on a spanning forest of its verified
links; the forests of all passes are united by alternating stars. A pair at the
threshold shares a code's leading bit with a known probability, so the number of
passes follows from the largest label's size (``passes_for``): a pair at the
threshold is missed by all passes with an expected chance of ``MISS`` or less,
closer pairs less often.

Windows are bounded, a dense group is not, so an exact step follows: every pair
inside a component is decided. Components of at most ``BLOCK`` classes are one
block; a larger one is cut by angle to its smallest class (``STEP`` degrees a cell)
and by hash into blocks of about ``BLOCK``. By the triangle inequality a pair of
blocks may lie wholly within the threshold (counted without comparing) or wholly
beyond it (left out); the rest are compared block by block, each pair of blocks a
unit of work of its own. Only counts per class leave a task, never pairs.

Every sort, block and count is bounded per task; the driver sees the largest
label's size and the marks of the star rounds only.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite
component, or whose label is null, links with nothing, is its own component and is
kept; vectors of different dimension do not link. Rows that repeat a vector are
linked with each other, and rows that repeat the id as well count as separate
vectors. Null ids take part but never name a component with another id; -0.0 equals
0.0. An empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.components import components
from weir.llm.simhash import _union
from weir.llm.text import write_table

COSINE = 0.98
WINDOW = 128
BITS = 62
MISS = 0.001
BLOCK = 1024
STEP = 0.5
SEED = 13
#: Rows a window task holds at once.
CHUNK = 4096
#: Sums of products differ by a few ulp with their order; closer to the threshold
#: than this, the cosine is taken from correctly rounded sums.
DOUBT = 1e-12


def passes_for(n: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold among ``n`` vectors is expected to have
    met in a window but for a chance of ``miss``: two codes are neighbours if they share
    about as many leading bits as cut ``n`` to a quarter of a window."""
    bits = max(1.0, math.log2(max(1, 4 * n) / window))
    meet = (1 - math.acos(min(1.0, cosine)) / math.pi) ** bits
    return 1 if meet >= 1 else max(2, math.ceil(math.log(miss) / math.log(1 - meet)))


def _planes(turn: int, dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, turn, dim]).standard_normal((dim, BITS))


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Borders of the runs of rows that agree in all keys."""
    n = len(keys[0])
    if not n:
        return []
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    lo = np.flatnonzero(new)
    return list(zip(lo.tolist(), [*lo[1:].tolist(), n]))


def _rows_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and row borders of a list column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()


def _matrix(flat: np.ndarray, at: np.ndarray, lo: int, hi: int) -> np.ndarray:
    return flat[at[lo]:at[hi]].reshape(hi - lo, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine from correctly rounded sums of products: no order of summing matters."""
    a, b = (np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) for v in (a, b))
    s = [math.fsum((p * q).tolist()) for p, q in ((a, b), (a, a), (b, b))]
    return s[0] / (math.sqrt(s[1]) * math.sqrt(s[2]))


def linked(x: np.ndarray, ux: np.ndarray, y: np.ndarray, uy: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of ``x`` and ``y`` (units ``ux``, ``uy``) reach the cosine."""
    sim = ux @ uy.T
    near = sim >= cosine
    for i, j in np.argwhere(np.abs(sim - cosine) < DOUBT):
        near[i, j] = exact_cosine(x[i], y[j]) >= cosine
    return near


def _coder(passes: int):
    """Task: adds each vector's codes, one per pass."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        power = np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        planes: dict = {}
        for batch in batches:
            flat, at = _rows_of(batch.column("vec"))
            codes = np.zeros((batch.num_rows, passes), np.int64)
            dims = np.diff(at)
            for lo, hi in _runs(dims):
                d = int(dims[lo])
                if d not in planes:
                    planes[d] = [_planes(t, d) for t in range(passes)]
                u = _unit(_matrix(flat, at, lo, hi))
                for t, r in enumerate(planes[d]):
                    codes[lo:hi, t] = (u @ r > 0) @ power
            ends = np.arange(0, (batch.num_rows + 1) * passes, passes, dtype=np.int32)
            col = pa.ListArray.from_arrays(pa.array(ends), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, col], names=[*batch.schema.names, "codes"])
    return task


def _window_task(window: int, cosine: float, chunk: int = CHUNK):
    """Task: rows ``label, dim, cid, vec`` in code order -> spanning forest of the links
    between rows of one label and dimension that lie at most ``window`` places apart."""
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        tail = None  # key, ids and vectors of the last rows

        def flush():
            nonlocal tail
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            label, dim, cid = (t.column(c).to_numpy() for c in ("label", "dim", "cid"))
            flat, at = _rows_of(t.column("vec"))
            for lo, hi in _runs(label, dim):
                key, ids, x = (label[lo], dim[lo]), cid[lo:hi], _matrix(flat, at, lo, hi)
                first = 0
                if tail is not None and tail[0] == key:
                    first = len(tail[1])
                    ids, x = np.r_[tail[1], ids], np.r_[tail[2], x]
                u = _unit(x)
                up = np.arange(len(x))
                for s in range(first, len(x), 256):
                    e, r = min(s + 256, len(x)), max(0, s - window)
                    near = linked(x[s:e], u[s:e], x[r:e], u[r:e], cosine)
                    i, j = np.nonzero(near)
                    i, j = i + s, j + r
                    on = (j < i) & (i - j <= window)
                    if on.any():
                        up = _union(up, i[on], j[on])
                k = np.flatnonzero(up != np.arange(len(x)))
                if len(k):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[k]), pa.array(ids[up[k]])], schema=out)
                tail = (key, ids[-window:], x[-window:])

        n = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= chunk:
                yield from flush()
                n = 0
        if held:
            yield from flush()
    return task


def _cell_task(step: float):
    """Task: ``vec`` and its component's ``pivot`` (null: small component) -> angle cell."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = _rows_of(batch.column("vec"))
            far, to = _rows_of(batch.column("pivot"))
            big = np.asarray(batch.column("pivot").is_valid())
            cell = np.zeros(batch.num_rows, np.int32)
            for i in np.flatnonzero(big):
                c = float(_unit(flat[at[i]:at[i + 1]][None])[0] @ _unit(far[to[i]:to[i + 1]][None])[0])
                cell[i] = int(math.degrees(math.acos(max(-1.0, min(1.0, c)))) / step)
            keep = [i for i, f in enumerate(batch.schema) if f.name != "pivot"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(cell)],
                                             names=[*(batch.schema.names[i] for i in keep), "cell"])
    return task


def _pair_task(cosine: float):
    """Task: rows ``root, a, b, side, cid, n, vec`` sorted by the first four: one run is a
    pair of blocks (side 0 and 1; side 1 is empty where a block meets itself) -> how many
    rows each class links with in the other block (itself and its copies included)."""
    out = pa.schema([("cid", pa.int64()), ("near", pa.int64())])

    def count(side, cid, n, x):
        left, right = side == 0, side == 1
        u = _unit(x)
        if not right.any():
            near = linked(x, u, x, u, cosine)
            np.fill_diagonal(near, True)
            return cid, near @ n
        near = linked(x[left], u[left], x[right], u[right], cosine)
        return np.r_[cid[left], cid[right]], np.r_[near @ n[right], near.T @ n[left]]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rest: bool):
            t = pa.Table.from_batches(held).combine_chunks()
            keys = [t.column(c).to_numpy() for c in ("root", "a", "b")]
            runs = _runs(*keys)
            side, cid, n = (t.column(c).to_numpy() for c in ("side", "cid", "n"))
            flat, at = _rows_of(t.column("vec"))
            got = [count(side[lo:hi], cid[lo:hi], n[lo:hi], _matrix(flat, at, lo, hi))
                   for lo, hi in (runs if rest else runs[:-1])]
            held.clear()
            if not rest:
                held.extend(t.slice(runs[-1][0]).to_batches())
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([g[0] for g in got])),
                                                  pa.array(np.concatenate([g[1] for g in got]))], schema=out)

        n = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= CHUNK:
                yield from flush(False)
                n = sum(b.num_rows for b in held)
        if held:
            yield from flush(True)
    return task


def _takes_part(vec: Column, label: Column) -> Column:
    bad = F.exists(vec, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    fine = label.isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & ~bad & F.exists(vec, lambda e: e != 0)
    return F.coalesce(fine, F.lit(False))


def window_links(classes: DataFrame, passes: int, cosine: float = COSINE, window: int = WINDOW) -> DataFrame:
    """``u, v``: links whose components are those of all pairs the passes' windows verify.
    A pass is written before the next begins, so one pass's shuffle is alive at a time."""
    found = None
    for t in range(passes):
        rows = classes.select("label", F.size("vec").alias("dim"), F.col("codes")[t].alias("code"), "cid", "vec")
        rows = rows.repartitionByRange("label", "dim", "code", "cid").sortWithinPartitions("label", "dim", "code", "cid")
        links = rows.select("label", "dim", "cid", "vec").mapInArrow(_window_task(window, cosine), "u long, v long")
        links = write_table(links, f"pass-{t}")
        found = links if found is None else found.unionByName(links)
    return found


def block_counts(members: DataFrame, cosine: float = COSINE, step: float = STEP) -> DataFrame:
    """``cid, near``: rows that each class links with inside its component, itself and its
    copies included. ``members``: ``cid, root, big, cell, part, n, vec``."""
    block = F.col("cell").cast("long") * F.lit(1 << 32) + F.col("part")
    members = members.withColumn("block", block)
    sizes = members.groupBy("root", "block").agg(
        F.sum("n").alias("w"), F.first("big").alias("big"), F.first("cell").alias("cell"))
    a = sizes.select("root", "big", F.col("block").alias("a"), F.col("w").alias("wa"), F.col("cell").alias("ca"))
    b = sizes.select(F.col("root").alias("root_b"), F.col("block").alias("b"), F.col("w").alias("wb"), F.col("cell").alias("cb"))
    reach = math.degrees(math.acos(cosine))
    pairs = a.join(b, (F.col("root") == F.col("root_b")) & (F.col("a") <= F.col("b"))).drop("root_b")
    pairs = pairs.where((F.col("cb") - F.col("ca") - 1) * step <= reach + 1e-6)
    pairs = pairs.withColumn("sure", F.col("big") & ((F.col("ca") + F.col("cb") + 2) * step <= reach - 1e-6))
    own = F.col("a") == F.col("b")
    sure = pairs.where("sure").select("root", F.explode(F.array(
        F.struct(F.col("a").alias("block"), F.col("wb").alias("w")),
        F.struct(F.col("b").alias("block"), F.when(~own, F.col("wa")).otherwise(0).alias("w")))).alias("x"))
    sure = sure.groupBy("root", "x.block").agg(F.sum("x.w").alias("near"))
    counted = members.select("root", "block", "cid").join(sure, ["root", "block"]).select("cid", "near")
    sides = pairs.where("NOT sure").select("root", "a", "b", F.explode(F.when(own, F.array(
        F.struct(F.col("a").alias("block"), F.lit(0).alias("side")))).otherwise(F.array(
            F.struct(F.col("a").alias("block"), F.lit(0).alias("side")),
            F.struct(F.col("b").alias("block"), F.lit(1).alias("side"))))).alias("x"))
    sides = sides.select("root", "a", "b", "x.block", "x.side")
    rows = members.select("root", "block", "cid", "n", "vec").join(sides, ["root", "block"])
    rows = rows.repartition("root", "a", "b").sortWithinPartitions("root", "a", "b", "side")
    compared = rows.select("root", "a", "b", "side", "cid", "n", "vec").mapInArrow(_pair_task(cosine), "cid long, near long")
    return counted.unionByName(compared).groupBy("cid").agg(F.sum("near").alias("near"))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    cosine: float = COSINE, window: int = WINDOW, passes: int | None = None, block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: ``vec_id, n_links, component_id, kept``."""
    q = lambda c: F.col(f"`{c}`")
    rows = df.select(q(id_col).alias("vec_id"), q(label_col).alias("label"),
                     F.transform(q(vec_col), lambda e: e.cast("double")).alias("vec"))
    rows = rows.withColumn("label", F.when(_takes_part(F.col("vec"), F.col("label")), F.col("label")))
    valid = rows.where(F.col("label").isNotNull())
    if passes is None:
        most = valid.groupBy("label").count().agg(F.max("count")).first()[0] or 0
        passes = passes_for(most, cosine, window)
    classes = valid.groupBy("label", "vec").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low"))
    classes = classes.withColumn("cid", F.monotonically_increasing_id())
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    ddl = ", ".join(f"{c} {t}" for c, t in kinds.items())
    classes = write_table(classes.mapInArrow(_coder(passes), f"{ddl}, codes array<long>"), "vectors")

    roots = components(window_links(classes, passes, cosine, window))
    comp = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    sizes = comp.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    parts = lambda m: F.greatest(F.lit(1), F.ceil(m / block))
    pivots = sizes.where(F.col("m") > block).join(
        classes.select(F.col("cid").alias("root"), F.col("vec").alias("pivot")), "root").drop("m")
    members = classes.select("cid", "n", "vec").join(comp, F.col("cid") == F.col("node")).drop("node")
    members = members.join(pivots, "root", "left").select("root", "cid", "n", "vec", "pivot")
    members = members.withColumn("big", F.col("pivot").isNotNull()).select("root", "cid", "n", "vec", "big", "pivot")
    members = write_table(members.mapInArrow(
        _cell_task(STEP), "root long, cid long, n long, vec array<double>, big boolean, cell int"), "members")
    cells = members.groupBy("root", "cell").agg(parts(F.count(F.lit(1))).alias("parts"))
    dealt = members.join(cells, ["root", "cell"]).withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts"))).drop("parts")
    near = block_counts(dealt, cosine)

    named = classes.select("cid", "label", "vec", "n", "low").join(comp, F.col("cid") == F.col("node"), "left")
    named = named.withColumn("root", F.coalesce("root", "cid")).where("n > 1 OR node IS NOT NULL").drop("node")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "root").join(near, "cid", "left").select(
        "label", "vec", (F.coalesce("near", "n") - 1).alias("n_links"), "component_id")
    lone = F.col("n_links").isNull()
    out = rows.join(named, ["label", "vec"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(lone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
