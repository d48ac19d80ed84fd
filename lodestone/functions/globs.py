"""Shell-style patterns as anchored Java regular expressions.

``*`` crosses ``/``, ``?`` is any character, ``[..]`` and ``[!..]`` are classes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPECIAL = r"([\\.^$|(){}+])"


def glob_regex(pattern: str) -> str:
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[":
            end = pattern.find("]", i + (2 if pattern[i : i + 1] == "!" else 1))
            if end < 0:
                out.append(r"\[")
                continue
            body = pattern[i:end].replace("\\", "\\\\").replace("[", r"\[").replace("&&", r"&\&")
            if body.startswith("!"):
                body = "^" + body[1:]
            elif body.startswith("^"):
                body = "\\" + body
            out.append(f"[{body}]")
            i = end + 1
        else:
            out.append("\\" + c if c in r"\.^$|(){}+]" else c)
    return f"(?s)^{''.join(out)}\\z"


def glob_regex_column(pattern: Column) -> Column:
    """The same for patterns held in a column."""
    p = F.regexp_replace(pattern, _SPECIAL, r"\\$1")
    p = F.regexp_replace(F.regexp_replace(p, r"\*", ".*"), r"\?", ".")
    p = F.regexp_replace(p, r"\[!", "[^")
    return F.concat(F.lit("(?s)^"), p, F.lit("\\z"))


def matches(text: Column, pattern: str | Column) -> Column:
    if isinstance(pattern, str):
        return text.rlike(glob_regex(pattern))
    return F.rlike(text, glob_regex_column(pattern))


def matches_any(text: Column, patterns: list[str] | Column) -> Column:
    """Whether any pattern matches; false for none."""
    if isinstance(patterns, Column):
        return F.exists(patterns, lambda p: F.rlike(text, glob_regex_column(p)))
    out = F.lit(False)
    for p in patterns:
        out = out | matches(text, p)
    return out
