"""Ordered rule tables and how text is judged by them.

Rules are short lists on the driver; each becomes one expression, so a scan of
any size stays inside the JVM.  Patterns are Unicode-aware.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    pattern: str
    label: str
    reason: str = ""


def hit(text: Column, pattern: str, flags: str = "i") -> Column:
    return text.rlike(f"(?U{flags}){pattern}")


def first_rule(text: Column, rules: list[Rule], default: tuple[str, str], flags: str = "i") -> Column:
    """struct(label, reason, rule) of the first rule that matches; rule is its
    place from 0, null for the default."""
    out = F.struct(F.lit(default[0]).alias("label"), F.lit(default[1]).alias("reason"), F.lit(None).cast("int").alias("rule"))
    for i, r in reversed(list(enumerate(rules))):
        made = F.struct(F.lit(r.label).alias("label"), F.lit(r.reason).alias("reason"), F.lit(i).alias("rule"))
        out = F.when(hit(text, r.pattern, flags), made).otherwise(out)
    return out


def all_labels(text: Column, rules: list[Rule], flags: str = "i") -> Column:
    """Labels of all rules that match, in rule order."""
    each = F.array(*[F.when(hit(text, r.pattern, flags), F.lit(r.label)) for r in rules])
    return F.filter(each, lambda x: x.isNotNull())


def first_containing(text: Column, table: list[tuple[str, list[str]]], default: str) -> Column:
    """Label of the first entry of which some term is in the text."""
    out = F.lit(default)
    for label, terms in reversed(table):
        out = F.when(reduce(lambda a, b: a | b, [text.contains(t) for t in terms]), F.lit(label)).otherwise(out)
    return out


def best_label(scores: dict[str, Column], default: Column) -> Column:
    """Label of the highest positive score; the earlier one on ties."""
    items = F.array(*[F.struct(s.alias("s"), F.lit(-i).alias("o"), F.lit(k).alias("k")) for i, (k, s) in enumerate(scores.items())])
    top = F.array_max(items)
    return F.when(top["s"] > 0, top["k"]).otherwise(default)


# fixed values: shell commands by risk, in the order in which they are tried
COMMAND_RULES = [
    Rule(r"\brm\s+-rf\s+/\s*$", "blocked", "Recursive deletion of root filesystem"),
    Rule(r"\brm\s+-rf\s+/\w+\s*$", "blocked", "Recursive deletion of top-level directory"),
    Rule(r"\b(mkfs|fdisk|dd\s+if=)\b", "blocked", "Disk formatting/overwriting"),
    Rule(r"\b:\(\)\{.*\}\s*;", "blocked", "Fork bomb detected"),
    Rule(r"\b(chmod|chown)\s+.*-R\s+/\s*$", "blocked", "Recursive permission change on root"),
    Rule(r"\bcurl\b.*\|\s*(bash|sh|zsh)", "blocked", "Piping remote script directly to shell"),
    Rule(r"\bwget\b.*\|\s*(bash|sh|zsh)", "blocked", "Piping remote script directly to shell"),
    Rule(r"\brm\s+-rf\b", "dangerous", "Recursive file deletion"),
    Rule(r"\brm\s+-r\b", "dangerous", "Recursive file deletion"),
    Rule(r"\brm\s+.*\*", "dangerous", "Wildcard file deletion"),
    Rule(r"\bgit\s+push\s+.*--force\b", "dangerous", "Force push (may overwrite remote history)"),
    Rule(r"\bgit\s+push\s+.*-f\b", "dangerous", "Force push (may overwrite remote history)"),
    Rule(r"\bgit\s+reset\s+--hard\b", "dangerous", "Hard reset (discards uncommitted changes)"),
    Rule(r"\bgit\s+clean\s+-fd\b", "dangerous", "Git clean (removes untracked files)"),
    Rule(r"\bDROP\s+(TABLE|DATABASE|SCHEMA)\b", "dangerous", "Database DROP operation"),
    Rule(r"\bTRUNCATE\s+TABLE\b", "dangerous", "Database TRUNCATE operation"),
    Rule(r"\bDELETE\s+FROM\b(?!.*WHERE)", "dangerous", "DELETE without WHERE clause"),
    Rule(r"\bdocker\s+(rm|rmi|system\s+prune)\b", "dangerous", "Docker container/image removal"),
    Rule(r"\bdocker\s+compose\s+down\s+-v\b", "dangerous", "Docker compose down with volumes"),
    Rule(r"\bkubectl\s+delete\b", "dangerous", "Kubernetes resource deletion"),
    Rule(r"\bsudo\b", "dangerous", "Running with superuser privileges"),
    Rule(r"\bnpm\s+publish\b", "dangerous", "Publishing to npm registry"),
    Rule(r"\bpip\s+install\s+--user\b.*-e\s+git", "dangerous", "Installing from remote git repo"),
    Rule(r"\bcurl\b.*-o\s*/", "dangerous", "Downloading file to system directory"),
    Rule(r"\bgit\s+push\b", "warn", "Pushing to remote repository"),
    Rule(r"\bgit\s+merge\b", "warn", "Merging branches"),
    Rule(r"\bgit\s+rebase\b", "warn", "Rebasing (rewrites history)"),
    Rule(r"\bnpm\s+install\b", "warn", "Installing npm packages"),
    Rule(r"\bpip\s+install\b", "warn", "Installing Python packages"),
    Rule(r"\bcargo\s+install\b", "warn", "Installing Rust packages"),
    Rule(r"\brm\s+\S+", "warn", "Deleting a file"),
    Rule(r"\bmv\s+\S+", "warn", "Moving/renaming a file"),
    Rule(r"\bchmod\b", "warn", "Changing file permissions"),
    Rule(r"\bchown\b", "warn", "Changing file ownership"),
]
# fixed values: files by the risk of writing them
FILE_RULES = [
    Rule(r"^/(etc|usr|bin|sbin|lib|var|boot|proc|sys|dev)/", "blocked", "Writing to system directory"),
    Rule(r"^/root/", "dangerous", "Writing to root's home directory"),
    Rule(r"^~/.ssh/", "dangerous", "Writing to SSH directory"),
    Rule(r"^~/.gnupg/", "dangerous", "Writing to GPG directory"),
    Rule(r"\.env$", "warn", "Writing to .env file (may contain secrets)"),
    Rule(r"\.gitignore$", "warn", "Modifying .gitignore"),
    Rule(r"package-lock\.json$", "warn", "Modifying package-lock.json (usually auto-generated)"),
    Rule(r"yarn\.lock$", "warn", "Modifying yarn.lock (usually auto-generated)"),
    Rule(r"Cargo\.lock$", "warn", "Modifying Cargo.lock (usually auto-generated)"),
]
# fixed values: shapes of credentials in file contents
SECRET_RULES = [
    Rule(r"(?:api[_-]?key|apikey)\s*[:=]\s*['\"]?[A-Za-z0-9_\-]{20,}", "API key"),
    Rule(r"(?:secret|token|password|passwd|pwd)\s*[:=]\s*['\"]?[A-Za-z0-9_\-]{8,}", "Secret/token/password"),
    Rule(r"(?:aws_access_key_id|aws_secret_access_key)\s*[:=]", "AWS credentials"),
    Rule(r"sk-[A-Za-z0-9]{20,}", "OpenAI API key"),
    Rule(r"ghp_[A-Za-z0-9]{36}", "GitHub personal access token"),
    Rule(r"glpat-[A-Za-z0-9\-]{20}", "GitLab personal access token"),
    Rule(r"nvapi-[A-Za-z0-9\-_]{20,}", "NVIDIA API key"),
    Rule(r"-----BEGIN\s+(RSA|EC|DSA|OPENSSH)\s+PRIVATE\s+KEY-----", "Private key"),
    Rule(r"xoxb-[A-Za-z0-9\-]+", "Slack bot token"),
    Rule(r"xoxp-[A-Za-z0-9\-]+", "Slack user token"),
]
# fixed values: kinds of failure by the terms of their output
FAILURE_KINDS = [
    ("timeout", ["timed out", "timeout", "deadline exceeded"]),
    ("syntax", ["syntaxerror", "parse error", "unexpected token", "syntax error"]),
    ("import", ["modulenotfound", "importerror", "cannot find module", "unresolved import"]),
    ("type", ["typeerror", "type error", "mypy", "ts2322", "incompatible type"]),
    ("test", ["assertionerror", "failed test", "tests failed", "assert "]),
    ("dependency", ["dependency conflict", "no matching distribution", "eresolve"]),
    ("security", ["vulnerability", "secret detected", "security policy"]),
    ("environment", ["command not found", "not installed", "connection refused"]),
    ("runtime", ["traceback", "runtimeerror", "exception", "panic:"]),
]
# fixed values: known errors of tools and what to do about them
ERROR_RULES = [
    Rule(r"File not found|No such file", "RETRY"),
    Rule(r"Text not found in.*Make sure old_text matches", "RETRY"),
    Rule(r"Found \d+ occurrences.*provide more context", "RETRY"),
    Rule(r"Permission denied|EACCES", "ESCALATE"),
    Rule(r"File too large", "RETRY"),
    Rule(r"exit code [1-9]", "RETRY"),
    Rule(r"Command timed out", "RETRY"),
    Rule(r"command not found|not installed|not in PATH", "ESCALATE"),
    Rule(r"not a git repository", "CONTINUE"),
    Rule(r"merge conflict|CONFLICT", "ESCALATE"),
    Rule(r"nothing to commit", "CONTINUE"),
    Rule(r"SyntaxError|IndentationError|TabError", "RETRY"),
    Rule(r"ModuleNotFoundError|ImportError|Cannot find module", "RETRY"),
    Rule(r"TypeError|AttributeError|NameError|ReferenceError", "RETRY"),
    Rule(r"FAILED|FAIL|AssertionError|assert.*failed", "RETRY"),
    Rule(r"ConnectionError|ConnectionRefused|ECONNREFUSED", "RETRY"),
    Rule(r"HTTP [45]\d\d", "RETRY"),
]
# fixed values: intents in their order, with the patterns whose matches count
INTENTS = {
    "build": [
        r"\b(build|create|make|implement|add|develop|write|generate|scaffold|setup|init)\b",
        r"\b(new|feature|component|module|service|endpoint|page|app|application|project)\b",
    ],
    "fix": [
        r"\b(fix|bug|error|crash|broken|issue|problem|debug|solve|repair|patch|resolve)\b",
        r"\b(doesn't work|not working|fails|failing|exception|traceback|stack trace)\b",
    ],
    "refactor": [
        r"\b(refactor|restructure|reorganize|clean|improve|simplify|extract|split|merge|rename)\b",
        r"\b(dead code|duplicate|DRY|SOLID|pattern|anti-pattern|code smell|technical debt)\b",
    ],
    "review": [
        r"\b(review|audit|check|inspect|analyze|evaluate|assess|critique)\b",
        r"\b(PR|pull request|code review|quality|best practice)\b",
    ],
    "explain": [r"\b(explain|understand|how does|what is|what does|why|describe|walk through|clarify)\b"],
    "deploy": [
        r"\b(deploy|ship|release|publish|push to|launch|go live|production|staging)\b",
        r"\b(CI/CD|pipeline|docker|kubernetes|hosting|server|cloud)\b",
    ],
    "test": [
        r"\b(test|spec|coverage|assertion|mock|stub|fixture|jest|pytest|unittest)\b",
        r"\b(unit test|integration test|e2e|end.to.end|TDD|BDD)\b",
    ],
    "docs": [
        r"\b(document|documentation|readme|docstring|comment|jsdoc|swagger|openapi|wiki)\b",
        r"\b(API doc|guide|tutorial|onboarding|contributing)\b",
    ],
    "search": [r"\b(find|search|look for|where|locate|grep|which file|show me)\b"],
    "migrate": [
        r"\b(migrate|convert|port|upgrade|transition|move from|switch from|replace)\b",
        r"\b(JavaScript to TypeScript|React to|Vue to|Express to|legacy)\b",
    ],
    "optimize": [
        r"\b(optimize|performance|speed|fast|slow|memory|CPU|cache|lazy|bundle size)\b",
        r"\b(bottleneck|profil|benchmark|latency|throughput)\b",
    ],
    "security": [
        r"\b(security|vulnerab|XSS|CSRF|injection|auth|permission|secret|credential|CVE)\b",
        r"\b(hardcoded|exposed|unsafe|sanitize|validate|escape|encrypt)\b",
    ],
    "configure": [r"\b(config|setting|environment|env|setup|install|dependency|package|version)\b"],
}
CHAT = r"\b(hi|hello|hey|thanks|thank you|ok|sure|yes|no|please)\b"
# fixed values: signs of a large task
COMPLEXITY = [
    r"\b(entire|whole|all|every|complete|full|comprehensive)\b",
    r"\b(multiple|several|many|across|throughout)\b",
    r"\b(from scratch|production|production.ready|enterprise)\b",
    r"\b(system|architecture|infrastructure|framework|platform)\b",
    r"\b(database|API|authentication|payment|deployment)\b",
    r"\b(frontend|backend|fullstack|full.stack)\b",
]
# fixed values: words that call for a skill
SKILLS = {
    "frontend": ["react", "vue", "angular", "svelte", "next.js", "nextjs", "css", "html", "ui", "component", "jsx", "tsx", "tailwind"],
    "backend": ["api", "server", "endpoint", "route", "middleware", "fastapi", "express", "django", "flask", "nestjs", "rest", "graphql"],
    "database": ["database", "sql", "postgres", "mysql", "mongo", "redis", "prisma", "drizzle", "migration", "schema", "query", "index"],
    "security": ["security", "vulnerability", "xss", "csrf", "injection", "auth", "permission", "encrypt", "hash", "secret", "cve"],
    "devops": ["docker", "kubernetes", "k8s", "ci/cd", "github actions", "deploy", "nginx", "terraform", "helm", "container"],
    "testing": ["test", "jest", "pytest", "mocha", "cypress", "playwright", "coverage", "mock", "stub", "e2e", "unit test"],
    "performance": ["performance", "optimize", "speed", "cache", "lazy", "bundle", "memory", "cpu", "profil", "benchmark"],
    "refactoring": ["refactor", "clean", "extract", "split", "rename", "restructure", "dry", "solid", "pattern"],
    "api_design": ["api design", "rest", "graphql", "openapi", "swagger", "endpoint", "schema", "contract"],
    "debugging": ["debug", "error", "crash", "exception", "stack trace", "breakpoint", "log", "diagnose"],
    "documentation": ["document", "readme", "docstring", "jsdoc", "swagger", "guide", "wiki"],
    "git_workflow": ["git", "branch", "merge", "rebase", "cherry-pick", "bisect", "stash", "tag", "release"],
    "migration": ["migrate", "convert", "port", "upgrade", "typescript", "legacy", "modernize"],
    "ai_engineer": ["llm", "rag", "embedding", "vector", "langchain", "openai", "anthropic", "prompt", "fine-tune", "agent", "chatbot"],
    "mobile": ["react native", "flutter", "swift", "kotlin", "ios", "android", "mobile", "expo"],
}


def command_safety(command: Column, blocked: list[str] = (), allowed: list[str] = ()) -> Column:
    """struct(label, reason, rule): project blocks first, then the built-in
    rules in order, then project allowances, else safe."""
    inner = first_rule(command, COMMAND_RULES, ("safe", "No safety concerns detected"))
    if allowed:
        ok = F.struct(F.lit("safe").alias("label"), F.lit("Allowed by project rules").alias("reason"), F.lit(None).cast("int").alias("rule"))
        may = reduce(lambda a, b: a | b, [hit(command, p) for p in allowed])
        inner = F.when((inner["rule"].isNull()) & may, ok).otherwise(inner)
    for p in reversed(list(blocked)):
        no = F.struct(F.lit("blocked").alias("label"), F.lit(f"Blocked by project rules: matches '{p}'").alias("reason"), F.lit(None).cast("int").alias("rule"))
        inner = F.when(hit(command, p), no).otherwise(inner)
    return inner


def secret_labels(content: Column) -> Column:
    return all_labels(content, SECRET_RULES)


def file_write_safety(path: Column, content: Column | None = None) -> Column:
    """struct(label, reason, rule) of writing a file with this content."""
    out = first_rule(path, FILE_RULES, ("safe", "No safety concerns"))
    if content is None:
        return out
    found = secret_labels(F.coalesce(content, F.lit("")))
    warn = F.struct(F.lit("warn").alias("label"), F.concat(F.lit("Content may contain "), F.get(found, F.lit(0))).alias("reason"), F.lit(None).cast("int").alias("rule"))
    return F.when(out["rule"].isNull() & (F.size(found) > 0), warn).otherwise(out)


def failure_kind(output: Column) -> Column:
    return first_containing(F.regexp_replace(F.lower(output), r"(?U)\s+", " "), FAILURE_KINDS, "unknown")


def intent(request: Column) -> Column:
    low = F.lower(request)
    count = lambda p: F.regexp_count(low, F.lit(f"(?Ui){p}"))
    scores = {k: reduce(lambda a, b: a + b, [count(p) for p in ps]) for k, ps in INTENTS.items()}
    return best_label(scores, F.when(hit(low, CHAT, ""), F.lit("chat")).otherwise(F.lit("unknown")))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\S+"))


def complexity(request: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.regexp_count(F.lower(request), F.lit(f"(?Ui){p}")) for p in COMPLEXITY])


def difficulty(request: Column, intent_: Column) -> Column:
    words, score = word_count(request), complexity(request)
    return (
        F.when(intent_.isin("chat", "explain", "search"), F.when(words < 15, "trivial").otherwise("simple"))
        .when((score >= 5) | (words > 100), "massive")
        .when((score >= 3) | (words > 50), "complex")
        .when((score >= 1) | (words > 20), "moderate")
        .when(words > 8, "simple")
        .otherwise("trivial")
    )


def plan_type(difficulty_: Column, intent_: Column) -> Column:
    return (
        F.when(intent_.isin("chat", "explain", "search"), "direct")
        .when(difficulty_.isin("complex", "massive"), "planned")
        .when((intent_ == "unknown") & (difficulty_ == "moderate"), "research")
        .otherwise("direct")
    )


def _quote(word: str) -> str:
    return "".join("\\" + c if c in r"\.^$|()[]{}*+?" else c for c in word)


def skills(request: Column) -> Column:
    """Skills of which some word stands in the request, in table order."""
    rules = [Rule(rf"\b(?:{'|'.join(map(_quote, ws))})\b", k) for k, ws in SKILLS.items()]
    return all_labels(F.lower(request), rules, "")


def classify_requests(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The input with intent, difficulty, plan_type and skills of a request."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (
        df.withColumn("intent", intent(text))
        .withColumn("difficulty", difficulty(text, F.col("intent")))
        .withColumn("plan_type", plan_type(F.col("difficulty"), F.col("intent")))
        .withColumn("skills", skills(text))
    )


def decide(requests: DataFrame, rules: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """requests(id, capability, target) with the decision of rules(decision,
    capability, pattern): deny before ask before allow among the rules whose
    pattern matches, else the capability's default, else ask."""
    from .globs import glob_regex_column

    key = F.replace(F.lower("capability"), F.lit("-"), F.lit("_"))
    order = F.create_map(F.lit("deny"), F.lit(0), F.lit("ask"), F.lit(1), F.lit("allow"), F.lit(2))
    table = rules.select(
        F.col("capability").alias("rc"), F.try_element_at(order, F.lower("decision")).alias("rank"), glob_regex_column(F.col("pattern")).alias("re")
    )
    base = F.coalesce(*[F.when(F.col("key") == k, F.lit(v)) for k, v in (defaults or {}).items()], F.lit("ask"))
    got = requests.withColumn("key", key).withColumn("target", F.coalesce("target", F.lit("")))
    best = (
        got.select("id", "key", "target").distinct()
        .join(table, (F.col("key") == F.col("rc")) & F.rlike("target", F.col("re")))
        .groupBy("id", "key", "target").agg(F.min("rank").alias("rank"))
    )
    return got.join(best, ["id", "key", "target"], "left").select(
        "id", "capability", "target", F.when(F.col("rank").isNull(), base).otherwise(F.get(F.array(F.lit("deny"), F.lit("ask"), F.lit("allow")), F.col("rank"))).alias("decision")
    )
