"""Scalar column functions (C1-C9). All are Catalyst expressions; none runs Python per row."""

from weir.functions.scalars import (  # noqa: F401
    b64encode,
    b64decode,
    djb2,
    iso_timestamp,
    ts_micros,
    path_join,
    pairs_to_map,
    xor255,
    nul_cut,
    utf8_repair,
    ruby_to_i,
    version_at_least,
)
from weir.functions.glob import glob_to_regex, globs_to_regex, glob_match  # noqa: F401
from weir.functions.properties import get_property  # noqa: F401
