"""Many values against many patterns (F2, F3, U3): a pattern index.

The patterns, prefixes or globs, are dealt into shards of about ``SHARD_CHARS``
characters. A shard becomes one automaton over a literal piece of each pattern: the
whole prefix, or the longest run of a glob without wildcards. A value is walked
through each shard's automaton once, whatever its length and the number of patterns,
and only patterns whose piece it holds (at its start, where the pattern begins with
the piece) are tried on it, until one matches.

Distinct values are dealt to about ``PARTS`` tasks, shards and their parts together; a task
gets its shard's patterns first and then a stream of values, so it holds one shard and one
batch of values. More patterns make more shards and fewer copies of each. No value is
expanded into parts, no pattern kind shares a join key. Globs without wildcards are no part
of the index: they match the values that equal them, by an equi join.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.functions.glob import _bracket, glob_to_regex

SHARD_CHARS = 4_000_000
PARTS = 64
#: Patterns without any literal piece, or sharing one, are tried this many at a time.
TOGETHER = 200


def literal_piece(glob: str) -> tuple[str, bool]:
    """The longest run of a glob without wildcards, and whether the glob begins with it."""
    runs: list[tuple[str, bool]] = []
    run, i = "", 0
    start = True
    while i < len(glob):
        ch = glob[i]
        bracket = _bracket(glob, i) if ch == "[" else None
        if ch == "\\" and i + 1 < len(glob):
            run += glob[i + 1]
            i += 2
        elif ch in "*?" or bracket:
            runs.append((run, start))
            run, start = "", False
            i = bracket[1] if bracket else i + 1
        else:
            run += ch
            i += 1
    runs.append((run, start))
    return max(runs, key=lambda r: len(r[0]))


class Patterns:
    """The patterns of one shard, ready to be tried on values."""

    def __init__(self, patterns: list[str], whole: bool):
        import re

        import ahocorasick

        self.compile = lambda some: re.compile("(?s:" + "|".join(f"(?:{glob_to_regex(p)})" for p in some) + ")")
        self.whole = whole
        self.always = []
        pieces: dict[str, list] = {}
        for p in patterns:
            piece, first = literal_piece(p) if whole else (p, True)
            if piece:
                pieces.setdefault(piece, [[], []])[first].append(p)
            else:
                self.always.append(p)
        self.always = self._together(self.always)
        self.auto = ahocorasick.Automaton()
        for piece, (inner, first) in pieces.items():
            self.auto.add_word(piece, [len(piece), self._together(inner), self._together(first)])
        if pieces:
            self.auto.make_automaton()
        self.any = bool(pieces)

    def _together(self, patterns: list[str]) -> list:
        """Lists of patterns; each is compiled when a value first comes to it."""
        return [patterns[i:i + TOGETHER] for i in range(0, len(patterns), TOGETHER)]

    def _hit(self, tries: list, value: str) -> bool:
        for i, t in enumerate(tries):
            if isinstance(t, list):
                t = tries[i] = self.compile(t)
            if t.fullmatch(value):
                return True
        return False

    def match(self, value: str) -> bool:
        if not self.whole:
            if self.always:  # the empty prefix
                return True
            return self.any and any(end + 1 == n for end, (n, *_) in self.auto.iter(value))
        if self._hit(self.always, value):
            return True
        done = set()
        for end, entry in self.auto.iter(value) if self.any else ():
            n, inner, first = entry
            if end + 1 == n and first and self._hit(first, value):
                return True
            if inner and id(entry) not in done:
                done.add(id(entry))
                if self._hit(inner, value):
                    return True
        return False


def _match_task(whole: bool):
    """Task: rows ``shard, part, v, pattern`` sorted by shard and part, patterns (null ``v``)
    first -> the values that match."""
    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out = pa.schema([("v", pa.string())])
        place, patterns, index = None, [], None
        for batch in batches:
            hits = []
            for shard, part, v, pattern in zip(*(c.to_pylist() for c in batch.columns)):
                if (shard, part) != place:
                    place, patterns, index = (shard, part), [], None
                if v is None:
                    patterns.append(pattern)
                    continue
                if index is None:
                    index = Patterns(patterns, whole)
                if index.match(v):
                    hits.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.string())], schema=out)
    return task


def matching_values(values: DataFrame, col: str, patterns: DataFrame, whole: bool,
                    shard_chars: int = SHARD_CHARS, parts: int = PARTS) -> DataFrame:
    """The distinct values of ``col`` that match some ``pattern``: as a glob over the whole
    value, or (``whole=False``) as a plain prefix. Nulls match nothing."""
    pats = patterns.select(F.col("pattern").cast("string").alias("pattern")).where(F.col("pattern").isNotNull()).distinct()
    vals = values.select(F.col(f"`{col}`").cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
    if not whole:
        return _indexed(vals, pats, whole, shard_chars, parts).select(F.col("v").alias(col)).distinct()
    wild = F.col("pattern").rlike(r"[*?\[\\]")
    same = vals.join(pats.where(~wild).withColumnRenamed("pattern", "v"), "v", "left_semi")
    return same.unionByName(_indexed(vals, pats.where(wild), whole, shard_chars, parts)).select(F.col("v").alias(col)).distinct()


def _indexed(vals: DataFrame, pats: DataFrame, whole: bool, shard_chars: int, parts: int) -> DataFrame:
    """The values ``v`` that the index of ``pats`` finds, once for each shard that holds a match."""
    chars = pats.agg(F.sum(F.length("pattern") + 1).alias("n"))
    sizes = chars.select(F.greatest(F.lit(1), F.ceil(F.coalesce("n", F.lit(0)) / shard_chars)).cast("int").alias("n"))
    sizes = sizes.select(F.struct("n", F.ceil(F.lit(parts) / F.col("n")).cast("int").alias("parts")).alias("s")).scalar()
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    rules = pats.withColumn("s", sizes).withColumn("shard", F.pmod(F.xxhash64("pattern"), F.col("s.n")).cast("int"))
    rules = rules.withColumn("part", every(F.col("s.parts")))
    vals = vals.withColumn("s", sizes).withColumn("part", F.pmod(F.xxhash64("v"), F.col("s.parts")).cast("int"))
    vals = vals.withColumn("shard", every(F.col("s.n")))
    rows = rules.select("shard", "part", F.lit(None).cast("string").alias("v"), "pattern").unionByName(
        vals.select("shard", "part", "v", F.lit(None).cast("string").alias("pattern")))
    rows = rows.repartition("shard", "part").sortWithinPartitions("shard", "part", F.asc_nulls_first("v"))
    return rows.mapInArrow(_match_task(whole), "v string")
