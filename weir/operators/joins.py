"""Join building blocks shared by the operators: lookups, prefix anti join and
as-of join. Each has one path for every size: broadcasts are left to the planner
and AQE, which check the sizes themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.operators.patterns import matching_values


def lookup_join(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Left join to a dimension keyed by ``on`` (unique).

    The planner broadcasts a dimension whose scan statistics are under
    ``spark.sql.autoBroadcastJoinThreshold``, and AQE re-plans from the real
    shuffle sizes (broadcasting a side that turned out small, splitting a hot
    key of the fact side with the skew join)."""
    return df.join(dim, on, "left")


def prefix_matches(values: DataFrame, col: str, prefixes: DataFrame) -> DataFrame:
    """The distinct values of ``col`` that start with some ``prefix``."""
    return matching_values(values, col, prefixes.select(F.col("prefix").alias("pattern")), whole=False)


def prefix_anti_join(df: DataFrame, col: str, prefixes: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``col`` does not start with any ``prefix`` (a null
    ``col`` starts with none, an empty prefix starts every other)."""
    return df.join(prefix_matches(df, col, prefixes), col, "left_anti")


#: Time width of an as-of bucket.
ASOF_BUCKET_SECONDS = 60


def _last_until(cell: str, t: Column) -> Column:
    """The last element of the array ``cell`` (sorted by ``t``) whose ``t`` is not after ``t``;
    null when there is none. Looks at log2 of the elements."""
    def halve(ends: Column, _: Column) -> Column:
        middle = F.shiftright(ends["lo"] + ends["hi"] + 1, 1)
        fits = (ends["lo"] < ends["hi"]) & (F.get(F.col(cell), middle - 1)["t"] <= t)
        return F.struct(F.when(fits, middle).otherwise(ends["lo"]).alias("lo"),
                        F.when(fits | (ends["lo"] >= ends["hi"]), ends["hi"]).otherwise(middle - 1).alias("hi"))

    steps = F.sequence(F.lit(0), F.floor(F.log2(F.size(cell))).cast("int"))
    first = F.struct(F.lit(0).alias("lo"), F.size(cell).alias("hi"))
    return F.get(F.col(cell), F.aggregate(steps, first, halve, lambda ends: ends["lo"]) - 1)


def asof_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by=None, seq: str | None = None,
              bucket_seconds: float = ASOF_BUCKET_SECONDS) -> DataFrame:
    """Left rows with the columns of the latest ``right`` row whose ``right_ts``
    is <= ``left_ts`` (same ``by`` keys); nulls when there is none.

    Of right rows with the same time the one with the largest ``seq`` counts
    (without ``seq``, the largest payload in column order). A left row without a
    time is kept with nulls; a right row without a time counts for nothing. Null
    ``by`` keys match each other.

    The right side, one row a time, is gathered per ``(by, time bucket)``: the rows inside
    the bucket, sorted, and the one carried in from the buckets before. Buckets that only left rows
    fall into get the carried row alone; they come from one aggregate over the left
    side's keys and times. The left rows themselves are never sorted or packed: one
    equi join finds their bucket -- without moving them where the planner sees that the
    gathered side is small, and with AQE splitting a busy bucket -- and the last
    element not after the row's time is found by halving.
    """
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    q = lambda c: F.col(f"`{c}`")
    payload = [c for c in right.columns if c not in by and c not in left.columns]
    width = int(bucket_seconds * 1_000_000)
    keys = [f"__by{i}" for i in range(len(by))]
    key_cols = [q(c).alias(k) for c, k in zip(by, keys)]
    micros = lambda c: F.unix_micros(q(c).cast("timestamp"))
    bucket = lambda t: F.floor(t / width)
    pay = F.struct(*[q(c) for c in payload])
    version = F.struct(micros(right_ts).alias("t"), (q(seq) if seq else pay).alias("tie"), pay.alias("pay"))
    kind = right.select(version.alias("v")).schema[0].dataType

    versions = right.where(q(right_ts).isNotNull()).select(*key_cols, bucket(micros(right_ts)).alias("__b"), version.alias("__v"))
    places = left.where(q(left_ts).isNotNull()).select(*key_cols, bucket(micros(left_ts)).alias("__b")).distinct()
    both = versions.unionByName(places.withColumn("__v", F.lit(None).cast(kind))).repartition(*keys, "__b")
    # Of the versions of one time only the last can be met; a tie that is null comes first.
    both = both.groupBy(*keys, "__b", F.col("__v")["t"].alias("__t")).agg(F.max_by("__v", F.struct(F.col("__v")["tie"])).alias("__v"))
    # Compared by time alone: a payload may hold maps.
    before = lambda x, y: F.when(x["t"] < y["t"], -1).when(x["t"] == y["t"], 0).otherwise(1)
    cells = both.groupBy(*keys, "__b").agg(F.array_sort(F.collect_list("__v"), before).alias("__in"))
    along = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    ending = F.when(F.size("__in") > 0, F.element_at("__in", -1))
    cells = cells.withColumn("__carry", F.last(ending, ignorenulls=True).over(along))
    cells = cells.where((F.size("__in") > 0) | F.col("__carry").isNotNull()).select(
        *[F.col(k).alias(f"{k}c") for k in keys], F.col("__b").alias("__bc"), "__in", "__carry")

    t = micros(left_ts)
    same = bucket(t) == F.col("__bc")
    for c, k in zip(by, keys):
        same = same & q(c).eqNullSafe(F.col(f"{k}c"))
    found = left.join(cells, same, "left")
    latest = F.coalesce(F.when(F.size("__in") > 0, _last_until("__in", t)), F.col("__carry"))["pay"]
    return found.withColumn("__pay", latest).select(*[q(c) for c in left.columns], *[F.col("__pay")[c].alias(c) for c in payload])
