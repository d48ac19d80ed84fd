"""Source parsing: the ``files`` table from path and content.

Python sources need a syntax tree, so this runs in Arrow batches; everything
that a path or a hash decides stays in built-in expressions.
"""

from __future__ import annotations

import ast
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths, text
from ..schemas import FILES, SYMBOL

ROUTE_VERBS = {"get", "post", "put", "patch", "delete", "route", "websocket"}
MODEL_BASES = {"Base", "Model", "Document", "DeclarativeBase"}
# fixed values: declarations, imports, routes and models of other languages
IMPORTS = [
    r"\b(?:import|from)\s+(?:[^'\"]*?\s+from\s+)?['\"]([^'\"]+)['\"]", r"\brequire\s*\(\s*['\"]([^'\"]+)['\"]\s*\)",
    r"^\s*import\s+([A-Za-z0-9_./:-]+)", r"^\s*use\s+([A-Za-z0-9_:]+)",
]
DECLARATIONS = [
    ("class", r"\bclass\s+([A-Za-z_$][\w$]*)"), ("function", r"\b(?:function|func|fn)\s+([A-Za-z_$][\w$]*)"),
    ("function", r"\b(?:const|let|var)\s+([A-Za-z_$][\w$]*)\s*=\s*(?:async\s*)?\([^)]*\)\s*=>"),
]
NO_CALLS = {"if", "for", "while", "switch", "catch", "return"}
ROUTE_CALL = r"\b(?:app|router|server)\.(get|post|put|patch|delete|use)\s*\(\s*['\"]([^'\"]+)"
ROUTE_TEXT = r"\b(?:GET|POST|PUT|PATCH|DELETE)\s+['\"]([^'\"]+)['\"]"
SQL_TABLE = r"\bCREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?[\"`]?([A-Za-z_]\w*)"
PRISMA_MODEL = r"^\s*model\s+([A-Za-z_]\w*)"
JS_MODEL = r"\b(?:mongoose\.model|sequelize\.define)\s*\(\s*['\"]([^'\"]+)"


def parse_python(source: str, path: str) -> dict:
    """imports, symbols, references, routes, models of one Python source."""
    out = {"imports": [], "symbols": [], "references": [], "routes": [], "database_models": []}

    def named(node):
        return node.id if isinstance(node, ast.Name) else node.attr if isinstance(node, ast.Attribute) else None

    def walk(node, outer):
        for child in ast.iter_child_nodes(node):
            inner = outer
            if isinstance(child, ast.Import):
                out["imports"] += [a.name for a in child.names]
            elif isinstance(child, ast.ImportFrom):
                out["imports"].append("." * child.level + (child.module or ""))
            elif isinstance(child, ast.Call):
                if (n := named(child.func)) is not None:
                    out["references"].append(n)
            elif isinstance(child, (ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef)):
                is_class = isinstance(child, ast.ClassDef)
                kind = "class" if is_class else "method" if outer else "function"
                inner = [*outer, child.name]
                out["symbols"].append({"name": child.name, "kind": kind, "path": path, "line": child.lineno, "qualified_name": ".".join(inner)})
                if is_class and any(named(b) in MODEL_BASES for b in child.bases):
                    out["database_models"].append(child.name)
                for d in [] if is_class else child.decorator_list:
                    verb = d.func.attr.lower() if isinstance(d, ast.Call) and isinstance(d.func, ast.Attribute) else ""
                    if verb in ROUTE_VERBS and d.args and isinstance(d.args[0], ast.Constant) and isinstance(d.args[0].value, str):
                        out["routes"].append(f"{verb.upper()} {d.args[0].value}")
            walk(child, inner)

    walk(ast.parse(source), [])
    return out


def parse_other(source: str, path: str, language: str) -> dict:
    """The same from patterns, for sources in other languages."""
    symbols = [
        {"name": m[1], "kind": kind, "path": path, "line": source.count("\n", 0, m.start()) + 1, "qualified_name": m[1]}
        for kind, pattern in DECLARATIONS
        for m in re.finditer(pattern, source)
    ]
    own = {s["name"] for s in symbols}
    suffix = "." + path.rpartition(".")[2].lower()
    models = re.findall(PRISMA_MODEL, source, re.M) if suffix == ".prisma" else []
    models += re.findall(SQL_TABLE, source, re.I) if suffix == ".sql" else []
    models += re.findall(JS_MODEL, source) if language in ("typescript", "javascript") else []
    return {
        "imports": [x for p in IMPORTS for x in re.findall(p, source, re.M)],
        "symbols": symbols,
        "references": [c for c in re.findall(r"\b([A-Za-z_$][\w$]*)\s*\(", source) if c not in own and c not in NO_CALLS],
        "routes": [f"{m[1].upper()} {m[2]}" for m in re.finditer(ROUTE_CALL, source, re.I)] + [m[0].strip("'\"") for m in re.finditer(ROUTE_TEXT, source)],
        "database_models": models,
    }


def parse_files(sources: DataFrame, owner_rules: DataFrame | None = None) -> DataFrame:
    """The ``files`` table of sources(path, mtime_ns, size, content binary).
    Content that is not UTF-8, or Python that does not parse, gives a row with
    ``parse_error`` and empty lists."""
    from .graph import owners

    parts = T.StructType.fromDDL(
        f"imports array<string>, symbols array<{SYMBOL}>, `references` array<string>, routes array<string>, database_models array<string>, parse_error string"
    )

    def run(frames):
        import pandas as pd

        for f in frames:
            rows = []
            for path, language, content in zip(f["path"], f["language"], f["content"]):
                got, error = {}, ""
                try:
                    source = bytes(content).decode("utf-8")
                    got = parse_python(source, path) if language == "python" else parse_other(source, path, language)
                except (UnicodeDecodeError, SyntaxError, ValueError, RecursionError, MemoryError) as e:  # the parser reports its own depth so
                    error = f"{type(e).__name__}: {e}"
                once = lambda k: sorted(dict.fromkeys(got.get(k, [])))
                rows.append((once("imports"), got.get("symbols", []), once("references"), once("routes"), once("database_models"), error))
            cols = pd.DataFrame(rows, columns=[x.name for x in parts])
            yield pd.concat([f.drop(columns=["content"]).reset_index(drop=True), cols], axis=1)

    p = F.col("path")
    base = sources.select(
        "path", "mtime_ns", "size", paths.language(p).alias("language"), F.sha2("content", 256).alias("sha256"),
        paths.is_configuration(p).alias("configuration"), paths.is_test(p).alias("is_test"), "content",
    )
    schema = T.StructType([*[x for x in base.schema if x.name != "content"], *parts])
    out = base.mapInPandas(run, schema)
    if owner_rules is None:
        out = out.withColumn("owners", F.array().cast("array<string>"))
    else:
        out = out.join(owners(out.select("path"), owner_rules), "path", "left")
    return out.select([x.name for x in T.StructType.fromDDL(FILES)])


# ------------------------------------------------------------ model outputs

TAGS = ["THINKING", "FILES", "TEST", "RESPONSE", "CLARIFICATION"]


def tagged_output(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with one column per section of a tagged model output; null for
    sections that are not there."""
    out = df
    for tag in TAGS:
        found = F.regexp_extract(text_col, rf"(?is)<{tag}>(.*?)</{tag}>", 1)
        out = out.withColumn(tag.lower(), F.when(F.col(text_col).rlike(rf"(?is)<{tag}>.*?</{tag}>"), text.strip(found)))
    return out


def json_output(df: DataFrame, schema: str, text_col: str = "text", out_col: str = "parsed") -> DataFrame:
    """The first fenced JSON block, else the text itself, read by a schema."""
    fenced = F.regexp_extract(text_col, r"(?s)```(?:json)?\s*(\{.*?\}|\[.*?\])\s*```", 1)
    return df.withColumn(out_col, F.from_json(F.when(fenced != "", fenced).otherwise(F.col(text_col)), schema))


def task_list(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, id, description, files) from a task list in JSON; ids by position
    where missing; what cannot be read is one task without scope."""
    item = "struct<id:string,description:string,files:array<string>>"
    got = json_output(df, f"array<{item}>", text_col)
    good = F.col("parsed").isNotNull() & (F.size("parsed") > 0) & F.forall("parsed", lambda t: t["description"].isNotNull())
    one = F.array(F.struct(F.lit(None).cast("string").alias("id"), F.col(text_col).alias("description"), F.array().cast("array<string>").alias("files")))
    rows = got.select(key, F.posexplode(F.when(good, F.col("parsed")).otherwise(one)).alias("pos", "t"))
    return rows.select(key, F.coalesce("t.id", F.concat(F.lit("task-"), (F.col("pos") + 1).cast("string"))).alias("id"), "t.description", F.coalesce("t.files", F.array().cast("array<string>")).alias("files"))


def patch_proposals(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, path, body) of fenced files in a model output: a label line with
    the path, then the fence."""
    pattern = r"(?m)^(?:#+\s*|\*\*)?(?:file:\s*)?`?([A-Za-z0-9_./-]+\.[A-Za-z0-9]+)`?(?:\*\*)?:?\s*\n```[A-Za-z0-9]*\n([\s\S]*?)\n```"
    named = F.regexp_extract_all(text_col, F.lit(pattern), F.lit(1))
    bodies = F.regexp_extract_all(text_col, F.lit(pattern), F.lit(2))
    return df.select(key, F.explode(F.arrays_zip(named.alias("path"), bodies.alias("body"))).alias("x")).select(key, "x.path", "x.body")


def truncated(code: str) -> str:
    """SQL of a boolean: a code text that ends inside brackets or a fence."""
    n = lambda a: f"(length({code}) - length(replace({code}, '{a}', '')))"
    return f"({n('(')} > {n(')')} or {n('[')} > {n(']')} or {n('{')} > {n('}')} or rtrim({code}) like '%...')"


def last_json_object(df: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, json): the last line of an output that is a JSON object."""
    rows = df.select(key, F.posexplode(F.split(text_col, r"\r?\n")).alias("pos", "t"))
    ok = text.strip(F.col("t")).startswith("{") & F.try_parse_json("t").isNotNull()
    return rows.where(ok).groupBy(key).agg(F.max_by(text.strip(F.col("t")), "pos").alias("json"))
