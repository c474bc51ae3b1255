"""Control tables: property files (S12) and argument lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.functions.scalars import let
from weir.schema import KNOWN_OPTIONS
from weir.session import once

# Defaults: key prefixes a property line must carry to be read, keys read as they
# are, and the words removed from a key (in this order). A deployment passes its own.
PROPERTY_PREFIXES = ("monitoring_logging_", "agent_")
PROPERTY_EXACT_KEYS = ("monitoring_top_substitutions",)
PROPERTY_STRIP = ("monitoring_", "agent_", "logging_", "top_")


def read_property_files(spark: SparkSession, globs) -> DataFrame:
    """Property files as ``(file, file_ord, line_no, line)``. Files are read
    whole (config files are small), ordered by glob position then name."""
    if isinstance(globs, str):
        globs = [globs]
    out = None
    for gi, g in enumerate(globs):
        df = (spark.read.text(g, wholetext=True)
              .select(F.input_file_name().alias("file"), F.col("value").alias("text"))
              .select("file", F.lit(gi).alias("glob_ord"),
                      F.posexplode(F.split(F.col("text"), "\n")).alias("line_no", "line")))
        out = df if out is None else out.unionByName(df)
    return out.select("file", F.struct("glob_ord", "file").alias("file_ord"),
                      F.col("line_no").cast("bigint").alias("line_no"), "line")


def load_config(lines: DataFrame, file: str = "file", line_no: str = "line_no", line: str = "line",
                file_ord: str | None = None, prefixes=PROPERTY_PREFIXES, exact_keys=PROPERTY_EXACT_KEYS,
              strip=PROPERTY_STRIP) -> DataFrame:
    """``key=JSON`` lines to ``(file, line_no, key, idx, value)``.

    Only keys that start with one of ``prefixes``, or are one of ``exact_keys``, are
    read; the words of ``strip`` are removed from the key. A JSON object contributes ``k1, v1, k2, v2, ...`` (in object
    order), an array its elements. The merged value of a key is the list of
    all its rows ordered by ``(file order, line_no, idx)`` -- see
    ``merge_config``. Non-JSON values give no rows.
    """
    parts = F.split(F.col(line), "=", 2)
    # try_element_at: Catalyst may evaluate these before the size check (ANSI mode).
    k0 = F.try_element_at(parts, F.lit(1))
    js = F.try_element_at(parts, F.lit(2))
    known = F.lit(False)
    for p in prefixes:
        known = known | k0.startswith(p)
    for k in exact_keys:
        known = known | (k0 == k)
    key = k0
    for s in strip:
        key = F.replace(key, F.lit(s), F.lit(""))
    is_obj = F.ltrim(js).startswith("{")
    pairs = let(F.from_json(js, "map<string,string>"), lambda obj: F.flatten(
        F.transform(F.json_object_keys(js), lambda k: F.array(k, obj[k]))))
    values = F.when(is_obj, pairs) \
        .otherwise(F.from_json(js, "array<string>"))
    ord_col = [F.col(file_ord).alias("file_ord")] if file_ord else []
    staged = lines.where((F.size(parts) == 2) & known).select(
        F.col(file).alias("file"), *ord_col, F.col(line_no).alias("line_no"), key.alias("key"),
        values.alias("__values"))
    return staged.select("file", *(["file_ord"] if file_ord else []), "line_no", "key",
                         F.posexplode("__values").alias("idx", "value"))


def parse_args(df: DataFrame, line: str = "line", keep=()) -> DataFrame:
    """Argument lines to ``(keep..., ok, key, values)``, one row per final key.

    Tokens are separated by runs of spaces. A token longer than two characters
    starting with ``--`` names an option; following tokens are its values. A
    repeated option replaces the earlier one. An unknown option (``--version``
    included) rejects the whole line: ``ok`` is false and a single row with a
    null key is returned. Tokens before the first option are ignored. All of it
    is array functions on the row -- no shuffle.
    """
    is_opt = lambda t: (F.length(t) > 2) & t.startswith("--")
    known = [f"--{k}" for k in KNOWN_OPTIONS]

    def entries(toks, opt_pos):
        at = lambda i: F.try_element_at(toks, i)
        last_pos = F.filter(opt_pos, lambda i: ~F.exists(opt_pos, lambda j: (j > i) & (at(j) == at(i))))
        return F.struct(
            (~F.exists(opt_pos, lambda i: ~at(i).isin(known))).alias("ok"),
            F.transform(last_pos, lambda i: F.struct(
                F.substring(at(i), 3, 1 << 20).alias("key"),
                F.slice(toks, i + 1, F.coalesce(F.array_min(F.filter(opt_pos, lambda j: j > i)), F.size(toks) + 1) - i - 1)
                .alias("values"))).alias("e"))

    def positions(toks):
        numbered = F.transform(toks, lambda t, i: F.when(is_opt(t), i + 1))
        return F.filter(numbered, lambda i: i.isNotNull())

    # The tokens, then the option positions, are evaluated once per row.
    parsed = let(F.filter(F.split(F.col(line), " "), lambda x: x != ""),
                 lambda toks: let(positions(toks), lambda pos: entries(toks, pos)))
    staged = once(df.select(*keep, parsed.alias("__p")))
    staged = staged.select(*keep, F.col("__p.ok").alias("ok"), F.col("__p.e").alias("__e"))
    good = staged.where("ok").select(*keep, "ok", F.explode("__e").alias("__x")) \
        .select(*keep, "ok", F.col("__x.key").alias("key"), F.col("__x.values").alias("values"))
    rejected = staged.where(~F.col("ok")).select(*keep, "ok", F.lit(None).cast("string").alias("key"),
                                                 F.lit(None).cast("array<string>").alias("values"))
    return good.unionByName(rejected)
