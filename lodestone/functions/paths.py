"""Predicates and values of repository paths, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: suffixes of source files and their language
LANGUAGES = {
    ".py": "python", ".pyi": "python", ".js": "javascript", ".jsx": "javascript", ".mjs": "javascript", ".cjs": "javascript",
    ".ts": "typescript", ".tsx": "typescript", ".go": "go", ".rs": "rust", ".java": "java", ".kt": "kotlin", ".kts": "kotlin",
    ".rb": "ruby", ".php": "php", ".cs": "csharp", ".swift": "swift", ".sql": "sql", ".graphql": "graphql", ".prisma": "prisma",
    ".json": "configuration", ".toml": "configuration", ".yaml": "configuration", ".yml": "configuration", ".xml": "configuration",
}
# fixed values: path parts that hold no sources
IGNORED_PARTS = [
    ".git", ".hg", ".svn", ".pytest_cache", ".ruff_cache", ".mypy_cache", "__pycache__", "build", "dist", "node_modules", "vendor",
    "coverage", "verification_evidence", ".venv", "venv",
]
# fixed values: file names and folders of configuration
CONFIGURATION_NAMES = [
    "package.json", "pyproject.toml", "cargo.toml", "go.mod", "pom.xml", "build.gradle", "dockerfile", "makefile", "tsconfig.json",
    "vite.config.ts", "next.config.js", "next.config.mjs",
]
CONFIGURATION_PARTS = [".github", "config", "configs"]
# fixed values: what a tool's directory listing leaves out
HIDDEN_EXCEPTIONS = [".env", ".gitignore", ".eslintrc", ".prettierrc"]
HIDDEN_FOLDERS = [
    ".git", "__pycache__", "node_modules", ".next", ".venv", "venv", "dist", "build", ".cache", ".tox", ".mypy_cache", ".pytest_cache", "env", ".env", ".idea",
    ".vscode", "target", "coverage", ".ruff_cache", ".nuxt", ".output", ".turbo", "Library", "Applications", "Pictures", "Music", "Movies", "Downloads", "System",
    "Volumes", ".Trash", ".DocumentRevisions-V100",
]
BINARY_SUFFIXES = [
    ".pyc", ".pyo", ".so", ".dylib", ".dll", ".exe", ".o", ".a", ".class", ".jar", ".png", ".jpg", ".jpeg", ".gif", ".ico", ".svg", ".webp", ".woff", ".woff2",
    ".ttf", ".eot", ".zip", ".tar", ".gz", ".bz2", ".7z", ".pdf", ".doc", ".docx",
]
# fixed values: what a web view must not show
SENSITIVE_NAMES = [".netrc", ".npmrc", ".pypirc", "credentials.json", "id_dsa", "id_ecdsa", "id_ed25519", "id_rsa"]
SENSITIVE_FOLDERS = [".aws", ".git", ".ssh"]


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """Lower-cased last suffix with its dot; empty if there is none."""
    return F.lower(F.regexp_extract(name(path), r"[^.](\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(name(path), r"(?<=[^.])\.[^.]+$", "")


def language(path: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, suffix(path)), F.lit("unknown"))


def is_source(path: Column, ignored: list[str] | None = None) -> Column:
    """A supported suffix and no ignored part (extra ones may be added)."""
    parts = F.array(*[F.lit(p) for p in [*IGNORED_PARTS, *(ignored or [])]])
    return suffix(path).isin(list(LANGUAGES)) & ~F.arrays_overlap(F.split(path, "/"), parts)


def is_hidden(path: Column, exceptions: list[str] = HIDDEN_EXCEPTIONS) -> Column:
    """A file that directory tools leave out: dot files but for exceptions,
    binary suffixes, and whatever is in a folder that they leave out."""
    n = name(path)
    folders = F.split(path, "/")
    folders = F.slice(folders, 1, F.greatest(F.size(folders) - 1, F.lit(0)))
    below = F.exists(folders, lambda f: f.isin(HIDDEN_FOLDERS) | (f.startswith(".") & ~f.isin(".", "..", *exceptions)))
    return (n.startswith(".") & ~n.isin(exceptions)) | suffix(path).isin(BINARY_SUFFIXES) | below


def is_test(path: Column) -> Column:
    low = F.lower(path)
    n = name(low)
    inside = F.concat(F.lit("/"), low)
    return any_of(
        inside.contains("/test/"), inside.contains("/tests/"), n.startswith("test_"), n.endswith("_test.py"),
        n.contains(".test."), n.contains(".spec."), n.endswith("_test.go"),
    )


def is_configuration(path: Column, parts: list[str] = CONFIGURATION_PARTS) -> Column:
    return any_of(
        F.lower(name(path)).isin(CONFIGURATION_NAMES),
        F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(p) for p in parts])),
        suffix(path).isin(".yaml", ".yml", ".toml"),
    )


def strip_dots(path: Column) -> Column:
    """Leading ``.`` and ``/`` characters removed, as characters."""
    return F.regexp_replace(path, r"^[./]+", "")


def module_names(path: Column) -> Column:
    """Names by which a file can be imported, without repeats."""
    bare = F.regexp_replace(path, r"(?<=[^./])\.[^./]+$", "")
    parent = F.regexp_replace(bare, r"/?[^/]*$", "")
    names = F.array(bare, F.replace(bare, F.lit("/"), F.lit(".")), stem(path), F.concat(F.lit("./"), bare))
    package = F.when(stem(path) == "__init__", F.array(parent, F.replace(parent, F.lit("/"), F.lit(".")))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.filter(F.transform(F.concat(names, package), lambda x: F.regexp_replace(x, r"^[./]+|[./]+$", "")), lambda x: x != ""))


def import_name(imported: Column) -> Column:
    """An import as it is compared with module names."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(imported, r"\.js$", ""), r"\.ts$", ""), r"^[./]+|[./]+$", "")


def is_identifier(value: Column) -> Column:
    return value.rlike(r"^[A-Za-z0-9][A-Za-z0-9_.-]{0,127}\z") & ~value.isin(".", "..")


def is_inside(path: Column, root: Column) -> Column:
    """Whether a normalised path is the root or below it."""
    base = F.regexp_replace(root, r"/+$", "")
    return (path == base) | path.startswith(F.concat(base, F.lit("/")))


def is_sensitive(path: Column) -> Column:
    """Files that a web view must not show."""
    n = F.lower(name(path))
    return any_of(n == ".env", n.startswith(".env."), n.isin(SENSITIVE_NAMES), F.arrays_overlap(F.split(F.lower(path), "/"), F.array(*map(F.lit, SENSITIVE_FOLDERS))))
