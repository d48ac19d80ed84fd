"""Repository graph: queries over the ``files`` table (see ``schemas``).

Edges are materialised once as (importer, target) rows by two equi-joins, never
by comparing all files with all imports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from ..functions import paths, text
from ..functions.globs import glob_regex_column


def symbols(files: DataFrame) -> DataFrame:
    return files.select(F.explode("symbols").alias("s")).select("s.*")


def find_symbols(files: DataFrame, query: str, limit: int = 50) -> DataFrame:
    """Declarations by exact (0), prefix (1) or substring (2) name."""
    needle = query.strip().lower()
    names = [F.lower("name"), F.lower("qualified_name")]
    rank = (
        F.when((names[0] == needle) | (names[1] == needle), 0)
        .when(names[0].startswith(needle) | names[1].startswith(needle), 1)
        .when(names[0].contains(needle) | names[1].contains(needle), 2)
    )
    out = symbols(files).withColumn("rank", rank).where(F.col("rank").isNotNull() & F.lit(needle != ""))
    return out.orderBy("rank", "path", "line").limit(max(1, limit))


def find_callers(files: DataFrame, symbol: str, limit: int = 100) -> DataFrame:
    """Files that refer to a symbol, tests first."""
    needle = symbol.strip()
    hit = files.where(F.array_contains("references", needle) & F.lit(needle != ""))
    return hit.select("path", "language", "is_test").orderBy(F.col("is_test").desc(), "path").limit(max(1, limit))


def _listed(files: DataFrame, column: str, name: str, query: str) -> DataFrame:
    needle = query.lower().strip()
    out = files.select("path", F.explode(column).alias(name), "language")
    return out.where(F.lower(name).contains(needle)) if needle else out


def routes(files: DataFrame, query: str = "") -> DataFrame:
    return _listed(files, "routes", "route", query).orderBy("route", "path")


def models(files: DataFrame, query: str = "") -> DataFrame:
    return _listed(files, "database_models", "model", query).orderBy("model", "path")


def import_edges(files: DataFrame) -> DataFrame:
    """(importer, target) pairs: an import is one of the target's module names,
    or ends with ``/stem`` or ``.stem``."""
    imports = files.select(F.col("path").alias("importer"), F.explode("imports").alias("i")).select(
        "importer", paths.import_name(F.col("i")).alias("name")
    ).distinct()
    named = files.select(F.col("path").alias("target"), F.explode(paths.module_names(F.col("path"))).alias("name"))
    by_name = imports.join(named, "name").select("importer", "target")
    # a stem may hold dots: every tail of the import after a / or . is a key
    tails = imports.select(
        "importer",
        F.explode(
            F.filter(
                F.transform(F.sequence(F.lit(2), F.greatest(F.length("name"), F.lit(2))), lambda k: F.when(F.substr("name", k - 1, F.lit(1)).isin("/", "."), F.substr(F.col("name"), k))),
                lambda x: x.isNotNull() & (x != ""),
            )
        ).alias("tail"),
    )
    stems = files.select(F.col("path").alias("target"), paths.stem(F.col("path")).alias("tail"))
    by_tail = tails.join(stems, "tail").select("importer", "target")
    return by_name.unionByName(by_tail).where("importer <> target").distinct()


def dependencies(files: DataFrame, path: str, edges: DataFrame | None = None) -> DataFrame:
    """One row: sorted imports of a path and files that import it."""
    edges = import_edges(files) if edges is None else edges
    own = files.where(F.col("path") == path).select(F.explode_outer("imports").alias("i")).agg(F.sort_array(F.collect_set("i")).alias("imports"))
    back = edges.where(F.col("target") == path).agg(F.sort_array(F.collect_set("importer")).alias("imported_by"))
    return own.join(back)  # one row each


def neighbours(edges: DataFrame, path: str) -> DataFrame:
    """Files next to a path, either way."""
    out = edges.where(F.col("importer") == path).select(F.col("target").alias("path"))
    return out.unionByName(edges.where(F.col("target") == path).select(F.col("importer").alias("path"))).distinct()


def impacted_tests(files: DataFrame, changed: DataFrame, edges: DataFrame | None = None, depth: int = 4) -> DataFrame:
    """Tests that changed(path) files reach over up to ``depth`` imports.
    Tests are reached but not expanded; changed tests count themselves."""
    edges = cut((import_edges(files) if edges is None else edges).select("importer", "target"))
    kind = files.select("path", "is_test")
    start = changed.select(paths.strip_dots(F.col("path")).alias("path")).distinct()
    seen = start.select("path", F.lit(0).alias("level"), F.lit(True).alias("grows"))
    front = start.select(F.col("path").alias("target"))
    for k in range(depth):
        reached = edges.join(front.hint("merge"), "target").select(F.col("importer").alias("path")).distinct()
        reached = reached.join(seen.select("path").hint("merge"), "path", "left_anti").join(kind, "path")
        reached = cut(reached.select("path", F.lit(k + 1).alias("level"), (~F.col("is_test")).alias("grows")))
        seen = seen.unionByName(reached)
        front = reached.where("grows").select(F.col("path").alias("target"))
    own = start.join(kind.where("is_test"), "path", "left_semi")
    return seen.where("level > 0 and not grows").select("path").unionByName(own).distinct()


def relevance(
    files: DataFrame, query: str, fields: dict[str, tuple[Column, int]] | None = None, changed: DataFrame | None = None, key: str = "path", limit: int = 40
) -> DataFrame:
    """Rank rows by the query's terms: each field that contains a term adds the
    field's weight; recent changes add 2, tests 4 for queries about tests.
    Terms match as substrings.  Columns: key, score, rank."""
    import re

    words = [w for w in dict.fromkeys(re.findall(r"[A-Za-z_][A-Za-z0-9_-]{2,}", query.lower())) if w not in text.STOP_WORDS]
    join = lambda c: F.lower(F.array_join(c, " "))
    fields = fields or {
        "path": (F.lower("path"), 8),
        "symbols": (join(F.transform("symbols", lambda s: s["name"])), 6),
        "routes": (join(F.col("routes")), 7),
        "models": (join(F.col("database_models")), 7),
        "imports": (join(F.col("imports")), 2),
    }
    score = F.lit(0)
    for _, (value, weight) in fields.items():
        for w in words:
            score = score + F.when(value.contains(w), weight).otherwise(0)
    out = files
    if changed is not None:
        marks = changed.select(F.col(key)).distinct().withColumn("__changed", F.lit(2))
        out = out.join(marks, key, "left")
        score = score + F.coalesce("__changed", F.lit(0))
    if "is_test" in files.columns and any(t in query.lower() for t in ("test", "bug", "fix", "regression")):
        score = score + F.when(F.col("is_test"), 4).otherwise(0)
    top = out.select(key, score.alias("score")).where("score > 0").orderBy(F.col("score").desc(), key).limit(max(1, limit))
    from pyspark.sql import Window

    # the rank of at most ``limit`` rows
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(), key)))


def summary(files: DataFrame) -> DataFrame:
    """One row of counts."""
    n = lambda c: F.sum(F.coalesce(F.size(c), F.lit(0))).cast("bigint")
    return files.agg(
        F.count(F.lit(1)).alias("files"), n("symbols").alias("symbols"), n("imports").alias("imports"), F.count_if("is_test").alias("tests"),
        n("routes").alias("routes"), n("database_models").alias("database_models"), F.count_if("configuration").alias("configuration_files"),
        F.count_if(F.coalesce("parse_error", F.lit("")) != "").alias("parse_errors"),
    )


def language_histogram(files: DataFrame) -> DataFrame:
    return files.groupBy("language").agg(F.count(F.lit(1)).alias("files"))


# fixed values: frameworks by a part of an import, then by a file
FRAMEWORKS = [
    ("fastapi", "FastAPI"), ("django", "Django"), ("flask", "Flask"), ("express", "Express"), ("next", "Next.js"), ("react", "React"),
    ("vue", "Vue"), ("@angular/core", "Angular"), ("spring", "Spring"),
]
FRAMEWORK_FILES = [("next.config.js", "Next.js"), ("next.config.mjs", "Next.js"), ("prisma/schema.prisma", "Prisma")]


def frameworks(files: DataFrame) -> DataFrame:
    """(framework, ordinal) of those in use."""
    used = files.select(F.explode("imports").alias("i")).select(F.lower("i").alias("i")).distinct()
    marks = [F.max(F.when(F.col("i").contains(m), F.struct(F.lit(k).alias("ordinal"), F.lit(l).alias("framework")))) for k, (m, l) in enumerate(FRAMEWORKS)]
    by_import = used.agg(F.array(*marks).alias("a")).select(F.explode("a").alias("x")).where("x is not null").select("x.framework", "x.ordinal")
    table = F.create_map(*[F.lit(x) for kv in FRAMEWORK_FILES for x in kv])
    by_file = files.where(F.col("path").isin([p for p, _ in FRAMEWORK_FILES])).select(
        F.element_at(table, F.col("path")).alias("framework"), F.lit(len(FRAMEWORKS)).alias("ordinal")
    )
    return by_import.unionByName(by_file).groupBy("framework").agg(F.min("ordinal").alias("ordinal"))


def owners(files: DataFrame, rules: DataFrame) -> DataFrame:
    """(path, owners): rules(rule_no, pattern, owners) by glob, the last rule
    that matches wins; a pattern also matches below any folder."""
    p = F.regexp_replace("pattern", "^/+", "")
    p = F.when(p.endswith("/"), F.concat(p, F.lit("**"))).otherwise(p)
    table = rules.select("rule_no", F.col("owners").alias("rule_owners"), glob_regex_column(p).alias("re"), glob_regex_column(F.concat(F.lit("**/"), p)).alias("re2"))
    got = files.select("path").join(table, F.rlike("path", F.col("re")) | F.rlike("path", F.col("re2")))
    last = got.groupBy("path").agg(F.max_by("rule_owners", "rule_no").alias("owners"))
    return files.select("path").join(last, "path", "left").select("path", F.coalesce("owners", F.array().cast("array<string>")).alias("owners"))


def codeowners(content: DataFrame) -> DataFrame:
    """rules(rule_no, pattern, owners) from the text of a CODEOWNERS file."""
    out = content.select(F.posexplode(text.lines(F.col("text"))).alias("rule_no", "line")).select("rule_no", F.split(F.trim("line"), r"\s+").alias("p"))
    return out.where((~F.get("p", F.lit(0)).startswith("#")) & (F.size("p") >= 2)).select(
        "rule_no", F.get("p", F.lit(0)).alias("pattern"), F.slice("p", F.lit(2), F.size("p") - 1).alias("owners")
    )


def active_files(files: DataFrame, mentioned: Column, token_limit: int, limit: int = 20) -> DataFrame:
    """files(path, relevance, content) by boosted relevance while the contents
    before a row stay under half the token limit."""
    from pyspark.sql import Window

    got = files.withColumn("score", F.col("relevance") * F.when(mentioned, 2).otherwise(1)).orderBy(F.col("score").desc(), "path").limit(limit)
    w = Window.orderBy(F.col("score").desc(), "path").rowsBetween(Window.unboundedPreceding, -1)
    used = F.coalesce(F.sum(F.floor(F.length("content") / 3)).over(w), F.lit(0))
    return got.withColumn("tokens_before", used).where(F.col("tokens_before") < token_limit / 2)
