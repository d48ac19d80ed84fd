"""Sources: source trees, JSON-lines ledgers, captured tool output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths


def relative(root: str):
    """Path of a read file below the root, without its scheme."""
    base = root.rstrip("/").split("://")[-1]
    clean = F.regexp_replace("path", r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/")
    return F.substring(clean, F.length(F.lit("/" + base.lstrip("/"))) + 2, F.lit(1 << 30))


def source_tree(spark: SparkSession, root: str, ignored: list[str] | None = None) -> DataFrame:
    """(path, mtime_ns, size, content) of supported sources below a folder.
    Listings prune by suffix; ignored folders leave after it."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{" + ",".join(s[1:] for s in paths.LANGUAGES) + "}").load(root)
    )
    rows = files.select(relative(root).alias("path"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"), F.col("length").alias("size"), "content")
    return rows.where(paths.is_source(F.col("path"), ignored))


def listing(spark: SparkSession, root: str, ignored: list[str] | None = None) -> DataFrame:
    """Metadata of the same files; the contents are never read."""
    return source_tree(spark, root, ignored).drop("content")


def fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256, size) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(relative(root).alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, value) of the lines of JSON-lines files."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), "value")


def json_documents(spark: SparkSession, path: str, schema: str, version: str | None = None, strict: bool = False) -> DataFrame:
    """Whole-file JSON documents by a schema.  Broken ones and those of another
    ``schema_version`` are left out, or raise where ``strict``."""
    raw = spark.read.option("wholetext", True).text(path).select(F.from_json("value", schema).alias("d"), F.get_json_object("value", "$.schema_version").alias("v"), F.try_parse_json("value").alias("j"))
    ok = F.col("j").isNotNull() if version is None else F.col("j").isNotNull() & F.col("v").eqNullSafe(version)
    if strict:
        return raw.select(F.when(ok, F.col("d")).otherwise(F.raise_error(F.lit("document is broken or of another version"))).alias("d")).select("d.*")
    return raw.where(ok).select("d.*")


def git_status(text: DataFrame, limit: int = 200) -> DataFrame:
    """(ordinal, path) from captured ``git status --porcelain`` text(text); a
    rename's new name, each path once."""
    rows = text.select(F.posexplode(F.split("text", r"\r?\n")).alias("ordinal", "l")).where(F.length("l") > 3)
    path = F.trim(F.element_at(F.split(F.substring("l", 4, 1 << 20), " -> "), -1))
    return rows.select("ordinal", path.alias("path")).where("path <> ''").groupBy("path").agg(F.min("ordinal").alias("ordinal")).orderBy("ordinal").limit(max(1, limit))


def git_log(text: DataFrame) -> DataFrame:
    """(ordinal, commit, author, date, subject) from captured tab-separated log
    text; lines of fewer fields are left out."""
    rows = text.select(F.posexplode(F.split("text", r"\r?\n")).alias("ordinal", "l")).withColumn("p", F.split("l", "\t", 4)).where(F.size("p") == 4)
    return rows.select("ordinal", *[F.get("p", F.lit(i)).alias(c) for i, c in enumerate(("commit", "author", "date", "subject"))])


def search_results(pages: DataFrame, html_col: str = "html", limit: int = 10) -> DataFrame:
    """(page_id, rank, url, title) of the links of a result page, redirects
    unwrapped and decoded."""
    a = r"(?is)<a\s[^>]*?href=[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    z = F.arrays_zip(F.regexp_extract_all(html_col, F.lit(a), F.lit(1)).alias("u"), F.regexp_extract_all(html_col, F.lit(a), F.lit(2)).alias("t"))
    rows = pages.select("page_id", F.posexplode(F.slice(z, 1, limit)).alias("p", "x"))
    wrapped = F.regexp_extract("x.u", r"[?&]uddg=([^&]+)", 1)
    return rows.select(
        "page_id", (F.col("p") + 1).alias("rank"), F.when(wrapped != "", F.url_decode(wrapped)).otherwise(F.col("x.u")).alias("url"),
        F.trim(F.regexp_replace("x.t", r"<[^>]+>", "")).alias("title"),
    )


def policy_rules(spark: SparkSession, text: str) -> tuple[DataFrame, dict[str, str]]:
    """(rules, defaults) of a policy file in JSON or its YAML subset: lists
    ``allow``, ``ask``, ``deny`` of ``capability: pattern``, and ``defaults``."""
    import json

    try:
        data = json.loads(text)
    except json.JSONDecodeError:
        data, key = {}, None
        for raw in text.splitlines():
            line = raw.split("#")[0].rstrip()
            if not line.strip():
                continue
            if not raw.startswith((" ", "-")) and line.endswith(":"):
                key = line[:-1].strip()
            elif line.strip().startswith("- ") and key:
                data.setdefault(key, []).append(line.strip()[2:].strip().strip("'\""))
            elif ":" in line and key:
                k, _, v = line.strip().partition(":")
                data.setdefault(key, {})[k.strip()] = v.strip().strip("'\"")
    rows = []
    for decision in ("allow", "ask", "deny"):
        for item in data.get(decision) or []:
            capability, _, pattern = str(item).partition(":")
            rows.append((decision, capability.strip().lower().replace("-", "_"), pattern.strip() or "*"))
    return spark.createDataFrame(rows, "decision string, capability string, pattern string"), dict(data.get("defaults") or {})
