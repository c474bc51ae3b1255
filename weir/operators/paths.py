"""Path normalisation shared by the filters and the configuration operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: A path that is not normalised: relative, or with an empty, ``.`` or ``..`` segment.
_ODD = r"(?s)\A(?!/)|//|/\.\.?(?:/|\z)|(?<=.)/\z"


def normalize_path(c, cwd: str = "/") -> Column:
    """Absolute, normalised path: relative paths are taken from ``cwd``, repeated
    slashes and ``.`` are dropped and ``..`` removes the previous segment. Paths that
    are normalised already, most of them, are only looked at."""
    col = F.col(c) if isinstance(c, str) else c
    absolute = F.when(col.startswith("/"), col).otherwise(F.concat(F.lit(cwd.rstrip("/") + "/"), col))
    segs = F.split(absolute, "/")
    stack = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when((s == "") | (s == "."), acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))))
    return F.when(~col.rlike(_ODD), col).otherwise(F.concat(F.lit("/"), F.array_join(stack, "/")))
