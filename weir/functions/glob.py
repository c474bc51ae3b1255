"""Shell glob -> regular expression, for ``rlike`` (Java) and RE2 alike.

Semantics of ``fnmatch(pattern, path, 0)``: ``*`` and ``?`` also match ``/``
and a leading dot, ``[...]`` / ``[!...]`` / ``[^...]`` are bracket expressions
(with POSIX classes), a backslash quotes the next character and an unmatched
``[`` is a literal. Python's ``fnmatch.translate`` differs (no backslash
escapes), hence this translator. It runs once per pattern on the driver, or per
pattern row inside tasks; matching itself is the native ``rlike``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_META = set("\\.^$|?*+()[]{}")
_CLASS_META = set("\\]-[^&")

# POSIX bracket classes as explicit character sets.
_POSIX = {
    "alpha": "a-zA-Z",
    "digit": "0-9",
    "alnum": "a-zA-Z0-9",
    "upper": "A-Z",
    "lower": "a-z",
    "space": " \\t\\n\\x0B\\f\\r",
    "blank": " \\t",
    "xdigit": "0-9A-Fa-f",
    "cntrl": "\\x00-\\x1F\\x7F",
    "print": "\\x20-\\x7E",
    "graph": "\\x21-\\x7E",
    "punct": "!-/:-@\\[-`{-~",
}


def _lit(ch: str) -> str:
    return "\\" + ch if ch in _META else ch


def _class_lit(ch: str) -> str:
    return "\\" + ch if ch in _CLASS_META else ch


def _bracket(pat: str, i: int):
    """Parse a bracket expression starting at pat[i] == '['. Returns (regex, next
    index) or None when it is not terminated (then '[' is a literal)."""
    j = i + 1
    negate = False
    if j < len(pat) and pat[j] in "!^":
        negate = True
        j += 1
    items: list[str] = []
    first = True
    while j < len(pat):
        ch = pat[j]
        if ch == "]" and not first:
            body = "".join(items)
            if not body:
                return ("." if negate else "(?!)"), j + 1
            return ("[^" + body + "]" if negate else "[" + body + "]"), j + 1
        first = False
        if ch == "[" and j + 1 < len(pat) and pat[j + 1] == ":":
            end = pat.find(":]", j + 2)
            if end != -1 and pat[j + 2:end] in _POSIX:
                items.append(_POSIX[pat[j + 2:end]])
                j = end + 2
                continue
        if ch == "\\" and j + 1 < len(pat):
            ch = pat[j + 1]
            j += 1
        # range a-b (the '-' is not last before ']')
        if j + 2 < len(pat) and pat[j + 1] == "-" and pat[j + 2] != "]":
            hi = pat[j + 2]
            k = j + 3
            if hi == "\\" and j + 3 < len(pat):
                hi = pat[j + 3]
                k = j + 4
            if ord(ch) <= ord(hi):  # a reversed range holds no character
                items.append(_class_lit(ch) + "-" + _class_lit(hi))
            j = k
            continue
        items.append(_class_lit(ch))
        j += 1
    return None


def glob_to_regex(pattern: str) -> str:
    """Unanchored regex body for one glob."""
    out: list[str] = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out.append(".*")
            while i + 1 < len(pattern) and pattern[i + 1] == "*":
                i += 1
        elif ch == "?":
            out.append(".")
        elif ch == "\\":
            if i + 1 < len(pattern):
                i += 1
                out.append(_lit(pattern[i]))
            else:
                out.append("\\\\")
        elif ch == "[":
            parsed = _bracket(pattern, i)
            if parsed is None:
                out.append("\\[")
            else:
                out.append(parsed[0])
                i = parsed[1]
                continue
        else:
            out.append(_lit(ch))
        i += 1
    return "".join(out)


def globs_to_regex(patterns) -> str | None:
    """One anchored, dot-all regex matching when any glob matches; None for no patterns."""
    bodies = [glob_to_regex(p) for p in patterns]
    if not bodies:
        return None
    return "(?s)\\A(?:" + "|".join(bodies) + ")\\z"


def glob_match(c, patterns) -> Column:
    """True when the column matches any of the globs (false for an empty list)."""
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(patterns, str):
        patterns = [patterns]
    regex = globs_to_regex(list(patterns))
    if regex is None:
        return F.lit(False)
    return col.rlike(regex)
