"""Replacements in texts, by a passage that may differ in white space.

``edit_text`` looks for the old passage as it is; if it is not there, for the one
run of lines that has the same words when lines are stripped and blank ones do
not count; if there is none, and the old passage is a whole HTML document or has
at least three lines and six tenths of the text's, the whole text is replaced.
An old passage of blank lines alone matches as it is or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .text import strip

# fixed values: what ends a line, and how a document begins
LINE = "(?s)(.*?(?:\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029])|.+\\z)"
DOCUMENT = r"(?i)^(<!doctype|<html)"


def lines_of(text: Column) -> Column:
    """The lines of a text with their ends; none of an empty one."""
    return F.regexp_extract_all(text, F.lit(LINE), F.lit(1))


def _said(text: Column) -> Column:
    """(at, words) of the lines that are not blank."""
    numbered = F.transform(lines_of(text), lambda x, i: F.struct(i.alias("at"), strip(x).alias("words")))
    return F.filter(numbered, lambda x: x["words"] != "")


def _run_of_lines(text: Column, old: Column) -> Column:
    """The one run of as many lines as ``old`` has whose words are its words;
    null if there is none or more than one.  Runs that differ in blank lines
    around are different runs."""

    def find(x: Column) -> Column:
        here, want, size, height = x["here"], F.transform(x["old"], lambda y: y["words"]), F.size(x["lines"]), x["height"]
        q = F.size(want)
        at = lambda k: F.get(here, k)["at"]

        def runs(k: Column) -> Column:
            """First places of the runs of lines that hold the lines from k on and no others."""
            low = F.greatest(F.coalesce(at(k - 1) + 1, F.lit(0)), at(k + q - 1) - height + 1)
            high = F.least(at(k), F.coalesce(at(k + q), size) - height)
            return F.struct(low.alias("low"), F.greatest(high - low + 1, F.lit(0)).alias("n"))

        same = lambda k: F.forall(F.sequence(F.lit(0), q - 1), lambda j: F.get(here, k + j)["words"] == F.get(want, j))
        found = F.transform(F.filter(F.sequence(F.lit(0), F.size(here) - q), same), runs)
        one = lambda rs: F.when(F.aggregate(rs, F.lit(0), lambda a, r: a + r["n"]) == 1, F.get(F.filter(rs, lambda r: r["n"] == 1), F.lit(0))["low"])
        place = F.when((q > 0) & (F.size(here) >= q), let(found, one))
        return let(place, lambda p: F.when(p.isNotNull(), F.array_join(F.slice(x["lines"], p + 1, height), "")))

    parts = F.struct(_said(text).alias("here"), _said(old).alias("old"), lines_of(text).alias("lines"), F.size(lines_of(old)).alias("height"))
    return let(parts, find)


def edit_text(text: Column, old: Column, new: Column) -> Column:
    """struct(text, how): how is exact, lines, document, ambiguous or absent; only
    the first three change the text."""

    def edit(x: Column) -> Column:
        t, o, n = x["text"], x["old"], x["new"]
        swap = lambda part: F.concat(F.substr(t, F.lit(1), F.position(part, t) - 1), n, F.substr(t, F.position(part, t) + F.length(part)))
        result = lambda value, how: F.struct(value.alias("text"), F.lit(how).alias("how"))
        times = F.when(o == "", F.length(t) + 1).otherwise(F.floor((F.length(t) - F.length(F.replace(t, o, F.lit("")))) / F.length(o)))
        height, size = F.size(lines_of(o)), F.size(lines_of(t))
        whole = strip(o).rlike(DOCUMENT) | ((size > 0) & (height >= F.greatest(F.lit(3), F.floor(size * 0.6))))
        loose = lambda run: F.when(run.isNotNull(), result(swap(run), "lines")).when(whole, result(n, "document")).otherwise(result(t, "absent"))
        choose = lambda c: F.when(c == 1, result(swap(o), "exact")).when(c > 1, result(t, "ambiguous")).otherwise(let(_run_of_lines(t, o), loose))
        return let(times, choose)

    return let(F.struct(text.alias("text"), old.alias("old"), new.alias("new")), edit)


def edit_all(text: Column, edits: Column) -> Column:
    """struct(text, hows): edits(old, new) one after the other."""
    zero = F.struct(text.alias("text"), F.array().cast("array<string>").alias("hows"))

    def step(a: Column, e: Column) -> Column:
        return let(edit_text(a["text"], e["old"], e["new"]), lambda r: F.struct(r["text"].alias("text"), F.concat(a["hows"], F.array(r["how"])).alias("hows")))

    return F.aggregate(edits, zero, step)


def recover_nested_fence(raw: Column) -> Column:
    """struct(language, headers, code) of an answer that put its code in a fence
    inside the fence of its headers; null if it did not."""
    headers = r"(?:#|//)\s*filepath:\s*[^\n]+\n(?:#|//)\s*action:\s*(?:CREATE|MODIFY)"
    pattern = rf"(?is)```language\s*\n({headers})\s*\n```([A-Za-z0-9_+\-]+)\s*\n(.*?)```"
    part = lambda k: F.regexp_extract(raw, pattern, k)
    return F.when(raw.rlike(pattern), F.struct(part(2).alias("language"), part(1).alias("headers"), F.regexp_replace(part(3), r"\s+\z", "").alias("code")))
