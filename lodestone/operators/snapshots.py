"""Comparing states of files: incremental refresh, drift, scope checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.globs import matches_any


def refresh_plan(old: DataFrame, listing: DataFrame) -> DataFrame:
    """path and action of old(path, mtime_ns, size) against a new listing:
    reused, indexed or removed."""
    o = old.select("path", F.col("mtime_ns").alias("om"), F.col("size").alias("os"), F.lit(True).alias("o"))
    n = listing.select("path", F.col("mtime_ns").alias("nm"), F.col("size").alias("ns"), F.lit(True).alias("n"))
    same = (F.col("om") == F.col("nm")) & (F.col("os") == F.col("ns"))
    return o.join(n, "path", "full").select(
        "path", F.when(F.col("n").isNull(), "removed").when(F.col("o").isNotNull() & F.coalesce(same, F.lit(False)), "reused").otherwise("indexed").alias("action")
    )


def refresh_stats(plan: DataFrame) -> DataFrame:
    count = lambda a: F.count_if(F.col("action") == a).alias(a)
    return plan.agg(F.count_if(F.col("action") != "removed").alias("scanned"), count("indexed"), count("reused"), count("removed"))


def refresh(old: DataFrame, listing: DataFrame, parse) -> DataFrame:
    """The new snapshot: unchanged rows of the old one, and ``parse(rows)`` of
    new or changed listing rows."""
    same = ["path", "mtime_ns", "size"]
    kept = old.join(listing.select(same), same, "left_semi")
    fresh = listing.join(old.select(same), same, "left_anti")
    return kept.unionByName(parse(fresh))


def update_paths(old: DataFrame, present: DataFrame, asked: DataFrame) -> DataFrame:
    """Point refresh: rows of ``asked`` paths replaced by ``present`` ones, and
    dropped where they are no longer present."""
    rest = old.join(asked.select("path").distinct(), "path", "left_anti")
    return rest.unionByName(present.join(asked.select("path").distinct(), "path", "left_semi"))


def changed_paths(before: DataFrame, after: DataFrame) -> DataFrame:
    """Paths whose sha256 differs, new and removed ones included."""
    b, a = before.select("path", F.col("sha256").alias("b")), after.select("path", F.col("sha256").alias("a"))
    return b.join(a, "path", "full").where(~F.col("b").eqNullSafe(F.col("a"))).select("path")


def fingerprint(content: Column) -> Column:
    return F.struct(F.sha2(content, 256).alias("sha256"), F.octet_length(content).cast("bigint").alias("size"))


def tree_fingerprints(files: DataFrame, ignored=(".git", "node_modules", ".venv", "__pycache__", ".pytest_cache")) -> DataFrame:
    """(path, sha256) of files(path, content) outside ignored folders."""
    skip = F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(x) for x in ignored]))
    return files.where(~skip).select("path", F.sha2("content", 256).alias("sha256"))


def out_of_scope(changed: Column, allowed: Column) -> Column:
    """Changed paths that no allowed pattern matches; none if nothing is said."""
    return F.when(F.size(allowed) > 0, F.filter(changed, lambda p: ~matches_any(p, allowed))).otherwise(F.array().cast("array<string>"))


def not_changed(expected: Column, changed: Column) -> Column:
    """Expected paths that did not change, in their order."""
    return F.filter(expected, lambda p: ~F.array_contains(changed, p))


def drift(evidence: DataFrame, current: DataFrame) -> DataFrame:
    """(id, claim, verdict) of evidence records against current(path, sha256):
    FAIL if a recorded hash differs, MATCH if all agree, RERUN_REQUIRED for
    commands without hashes, else RECORDED."""
    parts = evidence.select("id", F.explode("artifacts").alias("x")).where("x.sha256 is not null and x.sha256 <> ''")
    now = current.select("path", F.col("sha256").alias("now"))
    seen = (
        parts.select("id", F.col("x.path").alias("path"), F.col("x.sha256").alias("want"))
        .join(now, "path", "left")
        .groupBy("id").agg(F.bool_and(F.col("want").eqNullSafe(F.col("now"))).alias("ok"))
    )
    return evidence.select("id", "kind", "claim").join(seen, "id", "left").select(
        "id", "claim",
        F.when(F.col("ok") == False, "FAIL").when(F.col("ok"), "MATCH").when(F.col("kind") == "command", "RERUN_REQUIRED").otherwise("RECORDED").alias("verdict"),  # noqa: E712
    )


def trust(candidates: DataFrame, approvals: DataFrame) -> DataFrame:
    """(path, state) of configuration files against approvals(path, sha256,
    approved): APPROVED for these bytes, CHANGED since, or PENDING."""
    known = approvals.select("path", F.col("sha256").alias("known"), "approved")
    return candidates.join(known, "path", "left").select(
        "path",
        F.when(F.col("approved") & (F.col("known") == F.col("sha256")), "APPROVED").when(F.col("known").isNotNull() & (F.col("known") != F.col("sha256")), "CHANGED").otherwise("PENDING").alias("state"),
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, limit: int | None = None) -> DataFrame:
    """Foreign-key check: child rows whose key is set and has no parent."""
    out = child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
    return out.orderBy(key).limit(limit) if limit else out


def mutation_verified(expected: Column, actual: Column, whole: Column) -> Column:
    """A write must give the text itself, an edit must be contained in it."""
    return F.when(whole, expected.eqNullSafe(actual)).otherwise(F.coalesce(F.contains(actual, expected), F.lit(False)))
