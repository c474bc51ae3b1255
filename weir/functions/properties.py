"""Value of a named property, first match in each file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def get_property(lines: DataFrame, name: str, file_col: str = "file",
                 line_no_col: str = "line_no", line_col: str = "line") -> DataFrame:
    """For each file, the stripped text after the first ``=`` of the first line
    whose text before the ``=`` equals ``name``. Files without such a line give
    no row (the caller left-joins to get a null).

    ``min_by`` is a partial aggregate, so a file with a huge number of lines is
    combined map-side before the shuffle.
    """
    parts = F.split(F.col(line_col), "=", 2)
    return (
        lines.where((F.size(parts) == 2) & (F.try_element_at(parts, F.lit(1)) == F.lit(name)))
        .groupBy(file_col)
        .agg(F.min_by(F.regexp_replace(F.try_element_at(parts, F.lit(2)), r"^\s+|\s+$", ""),
                      F.col(line_no_col)).alias("value"))
    )
