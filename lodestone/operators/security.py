"""Scans of sources, SQL scripts, URLs and packages."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import addresses, paths, text
from ..functions.binding import let

# fixed values: findings by severity and kind
PATTERNS = [
    ("critical", "private-key", r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"),
    ("high", "hardcoded-credential", r"(?i)\b(?:api[_-]?key|password|passwd|secret|token)\s*[:=]\s*['\"][^'\"\n]{8,}['\"]"),
    ("high", "shell-injection", r"\b(?:eval|exec)\s*\([^)]*(?:input|request|argv|query)"),
    (
        "high", "sql-injection",
        r"(?i)\b(?:execute|executemany|query)\s*\(\s*(?:f['\"]|['\"][^'\"\n]*['\"]\s*\.format\(|[^)\n]*\+\s*(?:input|request|params|query|user))",
    ),
    ("medium", "unsafe-cors", r"(?i)(?:allow_origins|access-control-allow-origin).{0,20}(?:\*|all)"),
    ("medium", "weak-hash", r"\b(?:hashlib\.)?(?:md5|sha1)\s*\("),
]
PLACEHOLDERS = ["changeme", "change-me", "dummy", "example", "fake", "placeholder", "sample", "test", "your-", "your_", "xxxx"]
SKIPPED_PARTS = [".git", "node_modules", ".venv", "venv", "dist", "build", "verification_evidence"]
TEST_PARTS = ["tests", "test", "benchmarks", "fixtures"]
SCANNED = [
    ".c", ".cc", ".cpp", ".cs", ".env", ".go", ".h", ".hpp", ".ini", ".java", ".js", ".json", ".jsx", ".kt", ".php", ".ps1", ".py", ".rb", ".rs", ".sh",
    ".sql", ".toml", ".ts", ".tsx", ".yaml", ".yml",
]
SCANNED_NAMES = ["Dockerfile", "Gemfile", "Makefile"]
MOST_BYTES = 2_000_000
# fixed values: statements that lose data
DESTRUCTIVE = [
    (r"(?i)\bDROP\s+(?:TABLE|COLUMN|DATABASE|SCHEMA)\b[^;]*", "drop"),
    (r"(?i)\bTRUNCATE\b[^;]*", "truncate"),
    (r"(?is)\bDELETE\s+FROM\b(?![^;]*\bWHERE\b)[^;]*", "unbounded-delete"),
    (r"(?i)\bRENAME\s+(?:TO|COLUMN)\b[^;]*", "rename"),
]


def scannable(files: DataFrame, explicit: bool = False) -> DataFrame:
    """Rows that a scan reads: source suffixes, no skipped folder, no test
    folder unless asked for, at most 2 MB."""
    parts = F.split("path", "/")
    bad = F.arrays_overlap(parts, F.array(*[F.lit(p) for p in SKIPPED_PARTS]))
    tests = F.arrays_overlap(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(*[F.lit(p) for p in TEST_PARTS]))
    keep = ~bad & (paths.suffix(F.col("path")).isin(SCANNED) | paths.name(F.col("path")).isin(".env", *SCANNED_NAMES)) & (F.octet_length("text") <= MOST_BYTES)
    return files.where(keep if explicit else keep & ~tests)


def _finding(severity: str, kind: str):
    return lambda m, i: F.struct(F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), m.alias("match"), i.alias("i"))


def _risk(kind: str):
    return lambda m: F.struct(F.lit(kind).alias("kind"), F.substring(m, 1, 500).alias("excerpt"))


def scan(files: DataFrame) -> DataFrame:
    """(path, severity, kind, line) of every finding in files(path, text).

    For each pattern the text is split at its matches; a finding's line is one
    more than the newlines before it.  Placeholders are no credentials, and a
    pattern being compiled nearby is no finding."""
    found = []
    for severity, kind, pattern in PATTERNS:
        hits = F.regexp_extract_all("text", F.lit(f"(?U){pattern}"), F.lit(0))
        gaps = F.split("text", f"(?U){pattern}", -1)
        rows = F.transform(hits, _finding(severity, kind))
        found.append(files.where(F.col("text").rlike(f"(?U){pattern}")).select("path", "text", F.explode(rows).alias("f"), gaps.alias("gaps"), hits.alias("hits")))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    nl = lambda c: F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))
    before = F.aggregate(F.slice("gaps", F.lit(1), F.col("f.i") + 1), F.lit(0), lambda a, x: a + nl(x)) + F.aggregate(
        F.slice("hits", F.lit(1), F.col("f.i")), F.lit(0), lambda a, x: a + nl(x)
    )
    out = out.withColumn("line", before + 1)
    near = F.array_join(F.slice(text.lines(F.col("text")), F.greatest(F.col("line") - 2, F.lit(1)), F.lit(4) - F.greatest(F.lit(3) - F.col("line"), F.lit(0))), "\n")
    low = F.lower("f.match")
    fake = F.lit(False)
    for p in PLACEHOLDERS:
        fake = fake | low.contains(p)
    return out.where(~((F.col("f.kind") == "hardcoded-credential") & fake) & ~near.contains("re.compile")).select(
        "path", F.col("f.severity").alias("severity"), F.col("f.kind").alias("kind"), "line"
    )


def scan_verdict(findings: DataFrame) -> DataFrame:
    """One row: FAILED with any critical or high finding, else PASSED."""
    blocking = F.count_if(F.col("severity").isin("critical", "high"))
    return findings.agg(F.when(blocking > 0, "FAILED").otherwise("PASSED").alias("verdict"), blocking.alias("blocking"), F.count(F.lit(1)).alias("findings"))


def migration_risks(scripts: DataFrame) -> DataFrame:
    """The input's rows by destructive statement: kind, excerpt."""
    each = F.flatten(
        F.array(
            *[
                F.transform(F.regexp_extract_all("sql", F.lit(p), F.lit(0)), _risk(k))
                for p, k in DESTRUCTIVE
            ]
        )
    )
    return scripts.withColumn("r", F.explode(each)).select(*scripts.columns, "r.*")


def naive_secret_lines(files: DataFrame) -> DataFrame:
    """(path, line) of lines of sources that name a credential."""
    ok = paths.suffix(F.col("path")).isin(".py", ".js", ".ts", ".env") | (paths.name(F.col("path")) == ".env")
    return files.where(ok).select("path", F.posexplode(text.lines(F.col("text"))).alias("p", "t")).where(
        F.col("t").rlike(r"(?i)password|secret|api_key|private_key")
    ).select("path", (F.col("p") + 1).alias("line"))


# fixed values: addresses that a fetch must not reach
METADATA_HOSTS = ["metadata.google.internal", "metadata.goog", "metadata.azure.com", "metadata.oraclecloud.com"]
DANGEROUS_TYPES = ["application/x-executable", "application/x-sharedlib", "application/x-mach-binary", "application/x-dosexec"]


def url_verdict(url: Column, allowed_hosts: list[str] | None = None, allow_localhost: bool = False, allow_private: bool = False) -> Column:
    """Why a URL must not be fetched, null if it may; addresses in any way of
    writing, names are not resolved."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    rest = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(rest), r"\.+$", ""), r"^\[|\]$", "")

    def judged(x: Column) -> Column:
        name = x["host"]
        lies = lambda networks: F.coalesce(addresses.within(x["at"], networks), F.lit(False))
        out = F.when(name == "", "empty_host").when(name.isin(METADATA_HOSTS) | lies(addresses.METADATA), "metadata")
        if not allow_localhost:
            out = out.when((name == "localhost") | lies(addresses.LOOPBACK), "loopback")
        if not allow_private:
            out = out.when(lies(addresses.PRIVATE) & ~lies(addresses.NOT_PRIVATE), "private_range")
        out = out.when(lies(addresses.LINK_LOCAL), "link_local").when(lies(addresses.MULTICAST), "multicast").when(lies(addresses.UNSPECIFIED), "unspecified")
        return out if allowed_hosts is None else out.when(~name.isin(allowed_hosts), "not_allowed")

    known = let(host, lambda h: let(F.struct(h.alias("host"), addresses.address(h).alias("at")), judged))
    return F.when(~scheme.isin("http", "https"), "blocked_scheme").otherwise(known)


def redirect_verdict(original: Column, target: Column, **rules) -> Column:
    """``url_verdict`` of a redirect's target, as redirect_<verdict>."""
    return F.concat(F.lit("redirect_"), url_verdict(target, **rules))


def content_type_allowed(kind: Column) -> Column:
    base = F.lower(text.strip(F.regexp_extract(kind, r"^([^;]*)", 1)))
    return ~base.isin(DANGEROUS_TYPES)


def allowed_origin(origin: Column, port: int) -> Column:
    return origin.rlike(rf"^https?://(localhost|127\.0\.0\.1|\[::1\]):{port}$")


def capability_check(tools: DataFrame) -> DataFrame:
    """tools(tool, declared, allowed, disallowed): denied if it declares
    something disallowed, or something outside a non-empty allowed set."""
    hit = F.array_intersect("declared", "disallowed")
    extra = F.when(F.size("allowed") > 0, F.array_except("declared", "allowed")).otherwise(F.array().cast("array<string>"))
    return tools.select("tool", ((F.size(hit) == 0) & (F.size(extra) == 0)).alias("permitted"), hit.alias("blocked"), extra.alias("missing"))


def hooks_that_fire(events: DataFrame, hooks: DataFrame) -> DataFrame:
    """(event_no, hook, ordinal) of enabled hooks for an event and path, in
    order, up to and including the first that blocks."""
    from pyspark.sql import Window

    from ..functions.globs import glob_regex_column

    j = events.join(hooks.where("enabled"), F.expr("array_contains(on_events, event)")).where(F.col("pattern").isNull() | F.rlike("path", glob_regex_column(F.col("pattern"))))
    w = Window.partitionBy("event_no").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    return j.withColumn("b", F.coalesce(F.max(F.col("blocks").cast("int")).over(w), F.lit(0))).where("b = 0").select("event_no", "hook", "ordinal")


SANITIZE_REJECT = r"(?i)(rm\s+-rf\s+/|:\(\)\s*\{|mkfs\.|dd\s+if=.*of=/dev/)"
SANITIZE_MASK = [r"(?i)ignore (?:all )?previous instructions", r"(?i)system prompt", r"(?i)you are now"]


def sanitize_prompt(prompt: Column) -> Column:
    """struct(prompt, rejected): dangerous payloads are rejected, phrases that
    try to take over are masked."""
    out = prompt
    for p in SANITIZE_MASK:
        out = F.regexp_replace(out, p, "[filtered]")
    bad = prompt.rlike(SANITIZE_REJECT)
    return F.struct(F.when(~bad, out).alias("prompt"), bad.alias("rejected"))


def api_contract(responses: DataFrame) -> DataFrame:
    """responses(id, status, expected_status, body, expected): a body meets its
    contract if the status agrees and every expected field has its value."""
    same = F.forall(F.map_entries(F.from_json("expected", "map<string,string>")), lambda e: F.from_json("body", "map<string,string>").getItem(e["key"]).eqNullSafe(e["value"]))
    return responses.select("id", (F.col("status").eqNullSafe(F.col("expected_status")) & F.coalesce(same, F.lit(True))).alias("passed"))


# ------------------------------------------------------------- dependencies


def manifest_packages(files: DataFrame) -> DataFrame:
    """(path, registry, name) of dependency manifests files(path, text)."""
    from pyspark.sql import Window

    n = paths.name(F.col("path"))
    rows = files.select("path", F.posexplode(text.lines(F.col("text"))).alias("no", "line")).withColumn("line", text.strip(F.col("line"))).withColumn("file", n)
    w = Window.partitionBy("path").orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    req = rows.where(F.col("file").startswith("requirements") & (F.col("line") != "") & ~F.col("line").rlike(r"^[#\-./]") & ~F.contains("line", F.lit("://")))
    req = req.select("path", F.lit("pypi").alias("registry"), text.strip(F.regexp_extract("line", r"^([^<>=!~;\[]*)", 1)).alias("name"))
    cargo = rows.where("file = 'Cargo.toml'").withColumn(
        "sec", F.last(F.when(F.col("line").startswith("["), F.contains("line", F.lit("dependencies")) & ~F.col("line").startswith("[package")), ignorenulls=True).over(w)
    )
    cargo = cargo.where(F.col("sec") & ~F.col("line").startswith("[") & ~F.col("line").startswith("#") & F.contains("line", F.lit("=")))
    cargo = cargo.select("path", F.lit("crates").alias("registry"), text.strip(F.regexp_extract("line", r"^([^=]*)", 1)).alias("name"))
    go = rows.where("file = 'go.mod'").withColumn(
        "req", F.last(F.when(F.col("line") == "require (", True).when(F.col("line") == ")", False), ignorenulls=True).over(w)
    )
    one = F.col("line").startswith("require ") & (F.col("line") != "require (")
    inside = F.coalesce("req", F.lit(False)) & ~F.col("line").isin("require (", ")", "") & ~F.col("line").startswith("//")
    go = go.where(one | inside).select("path", F.lit("go").alias("registry"), F.when(one, F.get(F.split("line", r"\s+"), F.lit(1))).otherwise(F.get(F.split("line", r"\s+"), F.lit(0))).alias("name"))
    keys = ["dependencies", "devDependencies", "peerDependencies", "optionalDependencies"]
    npm = files.where(n == "package.json").select(
        "path", F.flatten(F.array(*[F.coalesce(F.json_object_keys(F.get_json_object("text", f"$.{k}")), F.array().cast("array<string>")) for k in keys])).alias("ns")
    )
    npm = npm.select("path", F.lit("npm").alias("registry"), F.explode("ns").alias("name"))
    return req.unionByName(cargo).unionByName(go).unionByName(npm).where("name <> ''").distinct()


def check_packages(packages: DataFrame, registry: DataFrame, as_of: str) -> DataFrame:
    """Each distinct (registry, name) against registry(registry, name, first_release,
    downloads, known): blocked if known to be absent, warn if younger than 30
    days or (crates) under 100 downloads, unverified if nothing is known."""
    p = packages.select("registry", F.lower("name").alias("name")).distinct()
    r = registry.select("registry", F.lower("name").alias("name"), "first_release", "downloads", "known")
    young = F.datediff(F.lit(as_of).cast("date"), F.col("first_release").cast("date")) < 30
    few = (F.col("registry") == "crates") & (F.col("downloads") < 100)
    return p.join(r, ["registry", "name"], "left").select(
        "registry", "name",
        F.when(F.col("known").isNull(), "unverified").when(~F.col("known"), "blocked").when(F.coalesce(young, F.lit(False)) | F.coalesce(few, F.lit(False)), "warn").otherwise("pass").alias("verdict"),
    )


def install_commands(commands: DataFrame) -> DataFrame:
    """(id, registry, name) of packages that commands(id, command) install."""
    import shlex

    # fixed values: installers, their registry, and flags that take a value
    tools = {("pip", "install"): "pypi", ("pip3", "install"): "pypi", ("npm", "install"): "npm", ("npm", "i"): "npm", ("yarn", "add"): "npm", ("pnpm", "add"): "npm", ("cargo", "add"): "crates", ("cargo", "install"): "crates", ("go", "get"): "go", ("go", "install"): "go"}
    valued = {"-r", "--requirement", "-i", "--index-url", "--extra-index-url", "--registry", "-F", "--features"}

    def one(command):
        try:
            words = shlex.split(command or "")
        except ValueError:
            return []
        for at, (a, b) in enumerate(zip(words, words[1:])):
            if registry := tools.get((a, b)):
                out, skip = [], False
                for w in words[at + 2 :]:
                    if skip or w in valued or w.startswith("-"):
                        skip = not skip and w in valued
                        continue
                    out.append({"registry": registry, "name": w})
                return out
        return []

    @F.pandas_udf("array<struct<registry:string,name:string>>")
    def parse(s: pd.Series) -> pd.Series:
        return s.map(one)


    got = commands.select("id", F.explode(parse("command")).alias("x")).select("id", "x.*")
    return got.where(~text.is_local_or_url(F.col("name"))).select("id", "registry", text.strip_version(F.col("name"), F.col("registry")).alias("name"))
