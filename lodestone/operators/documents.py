"""Documents made of lines: reading, searching, Markdown rules, edits."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import globs, paths, text


def read_lines(files: DataFrame, key: str = "path", first: int | None = None, last: int | None = None, most_bytes: int = 2 << 20) -> DataFrame:
    """(key, line, text) with lines from 1, within a range; larger files than
    ``most_bytes`` are left out."""
    got = files.where(F.octet_length("text") <= most_bytes).select(key, F.posexplode(text.lines(F.col("text"))).alias("p", "t"))
    got = got.select(key, (F.col("p") + 1).alias("line"), F.col("t").alias("text"))
    if first is not None:
        got = got.where(F.col("line") >= first)
    return got if last is None else got.where(F.col("line") <= last)


def search(files: DataFrame, pattern: str, file_pattern: str = "*", limit: int = 50) -> DataFrame:
    """Lines that match a pattern, case ignored, by path and line."""
    named = files.where(globs.matches(paths.name(F.col("path")), file_pattern) & ~paths.is_hidden(F.col("path")) & F.col("text").rlike(f"(?Uim){pattern}"))
    hit = read_lines(named, most_bytes=1 << 31).where(F.col("text").rlike(f"(?Ui){pattern}"))
    return hit.orderBy("path", "line").limit(max(1, limit))


def find_files(files: DataFrame, pattern: str, limit: int = 100) -> DataFrame:
    named = globs.matches(F.col("path"), pattern) | globs.matches(paths.name(F.col("path")), pattern)
    return files.where(named & ~paths.is_hidden(F.col("path"))).select("path").orderBy("path").limit(limit)


def directory(files: DataFrame, folder: str, depth: int = 3) -> DataFrame:
    """(path, is_dir) below a folder, folders first, then by name, case ignored."""
    base = folder.strip("/")
    files = files.where(~paths.is_hidden(F.col("path")))
    rel = files.where(F.col("path").startswith(base + "/")).select(F.substring("path", len(base) + 2, 1 << 30).alias("p")) if base else files.select(F.col("path").alias("p"))
    parts = rel.select(F.split("p", "/").alias("s"))
    rows = parts.select(F.explode(F.sequence(F.lit(1), F.least(F.size("s"), F.lit(depth)))).alias("d"), "s").select(
        F.array_join(F.slice("s", F.lit(1), F.col("d")), "/").alias("path"), (F.col("d") < F.size("s")).alias("is_dir")
    )
    return rows.distinct().orderBy(F.col("is_dir").desc(), F.lower("path"))


def compact_tree(files: DataFrame, depth: int = 3, per_folder: int = 30, most: int = 100) -> DataFrame:
    """A short tree: so many entries per folder and lines in all."""
    rows = directory(files, "", depth).withColumn("parent", F.regexp_replace("path", "/?[^/]*$", ""))
    w = Window.partitionBy("parent").orderBy(F.col("is_dir").desc(), F.lower("path"))
    return rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= per_folder).orderBy("path").limit(most).select("path", "is_dir")


def markdown_sections(files: DataFrame, key: str = "path") -> DataFrame:
    """(key, line, section, kind, item) of rule files: list items and
    ``name: value`` directives with the lower-cased ## header above them."""
    rows = files.select(key, F.posexplode(text.lines(F.col("text"))).alias("line", "raw")).withColumn("s", text.strip(F.col("raw")))
    w = Window.partitionBy(key).orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.when(F.col("s").startswith("##"), F.lower(text.strip(F.regexp_replace("s", "^#+", ""))))
    rows = rows.withColumn("section", F.coalesce(F.last(head, ignorenulls=True).over(w), F.lit("")))
    body = F.when(F.col("s").startswith("# "), text.strip(F.substring("s", 3, 1 << 30))).otherwise(F.col("s"))
    item = F.when(F.col("s").rlike(r"^[-*] "), text.strip(F.substring("s", 3, 1 << 30)))
    kind = F.when(F.col("s").startswith("##") | (F.col("s") == "") | (F.col("s").startswith("#") & ~F.col("s").startswith("# ")), None).when(item.isNotNull(), "item").when(body.rlike(r"^\w[\w_]*\s*:\s*.+$"), "directive")
    return rows.withColumn("kind", kind).where("kind is not null").select(key, "line", "section", "kind", F.coalesce(item, body).alias("item"))


def rule_kind(section: Column) -> Column:
    return F.when(section.isin("safety", "blocked", "blocked_commands"), "blocked_command").when(section.isin("allowed", "allowed_commands"), "allowed_command").when(section == "hooks", "hook").otherwise("convention")


def directives(files: DataFrame, key: str = "path", aliases: dict[str, str] | None = None) -> DataFrame:
    """(key, name, value) of directives; names by their aliases."""
    got = markdown_sections(files, key).where("kind = 'directive'")
    name = F.lower(F.regexp_extract("item", r"^(\w[\w_]*)\s*:", 1))
    if aliases:
        name = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), name), name)
    return got.select(key, name.alias("name"), text.strip(F.regexp_extract("item", r"^\w[\w_]*\s*:\s*(.+)$", 1)).alias("value"))


def markdown_skill(files: DataFrame, key: str = "path") -> DataFrame:
    """(key, name, description, checklist) from front matter and check boxes."""
    front = F.regexp_extract("text", r"(?s)\A---\n(.*?)\n---", 1)
    return files.select(
        key, F.regexp_extract(front, r"(?m)^name:\s*(.+)$", 1).alias("name"), F.regexp_extract(front, r"(?m)^description:\s*(.+)$", 1).alias("description"),
        F.regexp_extract_all("text", F.lit(r"(?m)^\s*- \[[ xX]\]\s*(.+)$"), F.lit(1)).alias("checklist"),
    )


def exact_edits(edits: DataFrame) -> DataFrame:
    """edits(id, text, old, new) with the text after and how often ``old`` stood
    in it; only a single occurrence is replaced."""
    got = text.edit_exact(F.col("text"), F.col("old"), F.col("new"))
    return edits.select("id", got["text"].alias("after"), got["found"].alias("found"))


def unified_diffs(changes: DataFrame) -> DataFrame:
    """changes(path, before, after) with a unified diff."""
    import difflib

    def one(p, b, a):
        b, a = (b or "").splitlines(keepends=True), (a or "").splitlines(keepends=True)
        return "".join(difflib.unified_diff(b, a, fromfile=f"a/{p}", tofile=f"b/{p}"))

    @F.pandas_udf("string")
    def batch(path: pd.Series, before: pd.Series, after: pd.Series) -> pd.Series:
        return pd.Series([one(*x) for x in zip(path, before, after)])

    return changes.withColumn("diff", batch("path", "before", "after"))


def change_summary(changes: DataFrame) -> DataFrame:
    """(path, action) of the last change of each path(seq, path, is_new)."""
    last = changes.groupBy("path").agg(F.max_by("is_new", "seq").alias("n"), F.max("seq").alias("seq"))
    return last.select("path", F.when(F.col("n"), "created").otherwise("modified").alias("action"), "seq")


def undo_set(changes: DataFrame, count: int = 1) -> DataFrame:
    """The last changes in the order in which they are undone."""
    return changes.orderBy(F.col("seq").desc()).limit(max(1, count))


def file_accesses(log: DataFrame) -> DataFrame:
    """(path, accesses, last_ts, edited, relevance) from log(path, ts, edit)."""
    got = log.groupBy("path").agg(F.count(F.lit(1)).alias("accesses"), F.max("ts").alias("last_ts"), F.bool_or("edit").alias("edited"))
    return got.withColumn("relevance", F.least(F.lit(10.0), F.col("accesses") + F.when(F.col("edited"), 3).otherwise(0)))


def _named(kind: str):
    return lambda v: F.struct(F.lit(kind).alias("type"), v.alias("value"))


def constraints(prompts: DataFrame) -> DataFrame:
    """(id, type, value) of literal constraints that prompts(id, text) state:
    HTTP status codes, quoted strings to return, assignments."""
    found = F.flatten(
        F.array(
            *[
                F.transform(F.regexp_extract_all("text", F.lit(p), F.lit(1)), _named(k))
                for k, p in (("status", r"(?i)\bstatus(?: code)?\s+(\d{3})\b"), ("string", r"(?i)\b(?:return|returns|print|prints)\s+[\"']([^\"'\n]+)[\"']"), ("assignment", r"\b([A-Za-z_]\w*\s*=\s*[\w.\"'-]+)"))
            ]
        )
    )
    return prompts.select("id", F.explode(F.array_distinct(found)).alias("c")).select("id", "c.*")


def constraints_met(wanted: DataFrame, code: DataFrame) -> DataFrame:
    """(id, type, value, met): whether a line of code(id, text) holds the value."""
    rows = code.select("id", F.explode(text.lines(F.col("text"))).alias("t"))
    hit = wanted.join(rows, "id").groupBy("id", "type", "value").agg(F.bool_or(F.contains("t", F.col("value"))).alias("met"))
    return wanted.join(hit, ["id", "type", "value"], "left").select("id", "type", "value", F.coalesce("met", F.lit(False)).alias("met"))
