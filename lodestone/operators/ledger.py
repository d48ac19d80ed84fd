"""Run ledger: runs, events, evidence, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

RESUMABLE = ["RUNNING", "FAILED", "BLOCKED", "PARTIALLY_VERIFIED"]
# fixed values: words of commands that check something, by what a criterion asks
CHECK_FAMILIES = [
    ("lint", ["lint", "type"], ["lint", "ruff", "mypy", "pyright", "tsc", "clippy", "vet"]),
    ("security", ["security", "vulnerab"], ["audit", "bandit", "semgrep", "security", "safety"]),
    ("build", ["build", "compile"], ["build", "compile", "cargo check", "go test", "tsc"]),
    ("test", ["test", "regression", "coverage"], ["test", "pytest", "jest", "vitest", "rspec", "phpunit"]),
]
TEST_WORDS = ["test", "pytest", "jest", "vitest"]


def has_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def numbered(rows: DataFrame, prefix: str, key: str, order: list[str], width: int = 6, name: str = "seq_id") -> DataFrame:
    """Sequence ids ``prefix-000001`` in order within a key."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn(name, F.format_string(f"{prefix}-%0{width}d", n))


def last_rows(rows: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The last n rows of each key."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return rows.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= max(1, n)).drop("__r")


def replay(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Run events in file order; lines that are not JSON objects are skipped."""
    v = F.try_parse_json(text_col)
    return lines.where(text.strip(F.col(text_col)) != "").withColumn("event", v).where(F.col("event").isNotNull() & F.schema_of_variant("event").startswith("OBJECT"))


def evidence_trail(lines: DataFrame, key: str = "session_id", text_col: str = "value") -> DataFrame:
    """Evidence records; one broken line empties its session's whole trail."""
    got = lines.where(text.strip(F.col(text_col)) != "").withColumn("record", F.try_parse_json(text_col))
    broken = got.groupBy(key).agg(F.bool_or(F.col("record").isNull()).alias("bad")).where("bad")
    return got.join(broken.select(key), key, "left_anti")


def run_listing(sessions: DataFrame, requests: DataFrame, states: DataFrame, working_dir: str | None = None, limit: int = 50) -> DataFrame:
    """Runs, latest first: turns with their request and state; where a row of
    those is missing, the session's own values stand in."""
    s = sessions.where(F.col("working_dir") == working_dir) if working_dir else sessions
    t = s.select("session_id", "working_dir", F.col("updated_at").alias("su"), F.explode("turns").alias("t")).select(
        "session_id", "working_dir", "su", F.col("t.turn_id").alias("turn_id"), F.col("t.status").alias("ts"), F.col("t.request").alias("tr")
    )
    r = requests.select("session_id", "turn_id", F.struct(F.coalesce("request", F.lit("")).alias("v")).alias("r"))
    st = states.select("session_id", "turn_id", F.struct("status", "updated_at").alias("st"))
    keys = ["session_id", "turn_id"]
    out = t.join(r, keys, "left").join(st, keys, "left").select(
        *keys, "working_dir",
        F.when(F.col("st").isNotNull(), F.col("st.status")).otherwise(F.col("ts")).alias("status"),
        F.when(F.col("r").isNotNull(), F.col("r.v")).otherwise(F.col("tr")).alias("request"),
        F.when(F.col("st").isNotNull(), F.col("st.updated_at")).otherwise(F.col("su")).alias("updated_at"),
    )
    return out.orderBy(F.col("updated_at").desc(), "session_id", "turn_id").limit(max(1, limit))


def resolve_run(runs: DataFrame, run_id: str) -> DataFrame:
    """The run an id means: empty the latest, ``session/turn``, a session its
    last turn, a turn if only one session has it.  No row if unknown, ambiguous
    or invalid."""
    import re

    raw = run_id.strip()
    none = runs.limit(0)
    ok = lambda x: bool(re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]{0,127}", x)) and x not in (".", "..")
    if not raw:
        return runs.orderBy(F.col("updated_at").desc(), "session_id", "turn_id").limit(1)
    if "/" in raw:
        parts = raw.split("/")
        if len(parts) != 2 or not all(map(ok, parts)):
            return none
        return runs.where((F.col("session_id") == parts[0]) & (F.col("turn_id") == parts[1]))
    if not ok(raw):
        return none
    own = runs.where(F.col("session_id") == raw).orderBy(F.col("turn_id").desc()).limit(1)
    single = runs.where(F.col("turn_id") == raw).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("turn_id"))).where("__n = 1").drop("__n")
    return own.unionByName(single.join(own.select(F.lit(1).alias("x")), F.lit(True), "left_anti"))


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """(session_id, turn_id, label): the checkpoint with the last name."""
    return checkpoints.groupBy("session_id", "turn_id").agg(F.max_by("label", "name").alias("label"))


def resume_summary(runs: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Runs with their last checkpoint and whether they can be resumed."""
    out = runs.join(latest_checkpoint(checkpoints), ["session_id", "turn_id"], "left")
    return out.withColumn("resumable", F.col("status").isin(RESUMABLE))


def latest_by_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Upsert view of an append table: the last row of each key."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("x")).select(*keys, "x.*")


def rollback_allowed(turns: DataFrame) -> DataFrame:
    """Only a session's latest turn may be rolled back."""
    return turns.withColumn("allowed", F.col("turn_id") == F.max("turn_id").over(Window.partitionBy("session_id")))


def turn_window(changes: DataFrame, turns: DataFrame) -> DataFrame:
    """Changes of a turn: those at or after its first and before its last
    sequence number (turns(session_id, turn_id, first_seq, end_seq))."""
    j = changes.join(turns, "session_id")
    return j.where((F.col("seq") >= F.col("first_seq")) & (F.col("seq") < F.col("end_seq"))).drop("first_seq", "end_seq")


def open_failures(evidence: DataFrame) -> DataFrame:
    """Failed evidence that still stands: not routing or review, no command that
    passed at some time, no behaviour check whose tool's latest is verified.
    evidence(session_id, seq, id, kind, status, tool, command, exit_code)."""
    failed = evidence.where((F.col("status") == "failed") & ~F.col("kind").isin("routing", "independent_review"))
    passed = evidence.where((F.col("kind") == "command") & (F.col("status") == "verified") & (F.col("exit_code") == 0) & (F.coalesce("command", F.lit("")) != ""))
    passed = passed.select("session_id", "command", F.lit("command").alias("kind")).distinct()
    last = evidence.where(F.col("kind") == "behavioral_verification").groupBy("session_id", "tool").agg(F.max_by("status", "seq").alias("last"))
    good = last.where(F.col("last") == "verified").select("session_id", "tool", F.lit("behavioral_verification").alias("kind"))
    return failed.join(passed, ["session_id", "command", "kind"], "left_anti").join(good, ["session_id", "tool", "kind"], "left_anti")


def latest_status(evidence: DataFrame, key: str = "tool") -> DataFrame:
    return evidence.groupBy("session_id", key).agg(F.max_by("status", "seq").alias("status"))


def matching_checks(criteria: DataFrame, evidence: DataFrame) -> DataFrame:
    """(session_id, criterion, id) of passing commands that a criterion asks
    for, by the first family of which it has a word."""
    low = F.lower("criterion")
    family = F.lit(None).cast("string")
    for name, words, _ in reversed(CHECK_FAMILIES):
        family = F.when(has_any(low, words), name).otherwise(family)
    passing = evidence.where((F.col("kind") == "command") & (F.col("status") == "verified") & (F.col("exit_code") == 0))
    command = F.lower(F.coalesce("command", F.lit("")))
    does = passing.select(
        "session_id", "id", F.explode(F.filter(F.array(*[F.when(has_any(command, marks), F.lit(name)) for name, _, marks in CHECK_FAMILIES]), lambda x: x.isNotNull())).alias("family")
    )
    return criteria.withColumn("family", family).join(does, ["session_id", "family"]).select("session_id", "criterion", "id")


def evaluate_criteria(criteria: DataFrame, evidence: DataFrame) -> DataFrame:
    """(session_id, criterion, status) of criteria(session_id, criterion,
    outside) from evidence; ``outside``: number of changes out of scope."""
    kind, status = F.col("kind"), F.col("status")
    command = F.lower(F.coalesce("command", F.lit("")))
    passing = (kind == "command") & (status == "verified") & (F.col("exit_code") == 0)
    some = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    facts = evidence.groupBy("session_id").agg(
        some((kind == "file_mutation") & (status == "verified")).alias("mutated"),
        some(kind == "file_mutation").alias("mutation"),
        F.coalesce(F.bool_and(F.when(kind == "file_mutation", status == "verified")), F.lit(True)).alias("all_mutations"),
        some(passing & has_any(command, TEST_WORDS)).alias("checked"),
        some((kind == "behavioral_verification") & (status == "verified")).alias("behaved"),
        some((kind == "behavioral_verification") & (status == "verified") & (F.col("tool") == "security_scan")).alias("scanned"),
        some((kind == "independent_review") & (status == "verified")).alias("reviewed"),
    )
    failed = open_failures(evidence).select("session_id").distinct().withColumn("failed", F.lit(True))
    checks = matching_checks(criteria, evidence).select("session_id", "criterion").distinct().withColumn("matched", F.lit(True))
    got = criteria.join(facts, "session_id", "left").join(failed, "session_id", "left").join(checks, ["session_id", "criterion"], "left")
    got = got.na.fill(False)
    low = F.lower("criterion")
    yes = lambda c: F.when(c, "SATISFIED").otherwise("UNVERIFIED")
    out = (
        F.when(low.contains("unrelated files"), F.when(F.coalesce("outside", F.lit(0)) > 0, "UNSATISFIED").otherwise("SATISFIED"))
        .when(low.contains("fingerprinted"), yes(F.col("mutation") & F.col("all_mutations")))
        .when(low.contains("requested objective is implemented"), yes(F.col("mutated") & (F.col("checked") | F.col("behaved")) & F.col("reviewed")))
        .when(has_any(low, ["security", "vulnerab"]), yes(F.col("scanned") | F.col("matched")))
        .when(low.contains("verification completed") | has_any(low, ["test", "build", "lint", "smoke check"]), yes(F.col("matched")))
        .when(F.col("failed"), "UNSATISFIED")
        .otherwise("UNVERIFIED")
    )
    return got.select("session_id", "criterion", out.alias("status"))


def run_status(facts: DataFrame) -> DataFrame:
    """Status of runs from facts(session_id, content, pending, failures,
    event_failures, mutations, checks, criteria, satisfied)."""
    some = (F.col("mutations") > 0) | (F.col("checks") > 0)
    out = (
        F.when(F.upper(text.strip(F.coalesce("content", F.lit("")))).startswith("BLOCKED:"), "BLOCKED")
        .when(F.col("pending") > 0, "AWAITING_APPROVAL")
        .when((F.col("failures") > 0) | (F.col("event_failures") > 0), F.when(some, "PARTIALLY_VERIFIED").otherwise("FAILED"))
        .when((F.col("criteria") > 0) & (F.col("satisfied") == F.col("criteria")), "VERIFIED")
        .when(some, "PARTIALLY_VERIFIED")
        .otherwise("UNVERIFIED")
    )
    return facts.select("session_id", out.alias("status"))


def unsupported_claims(answers: DataFrame, evidence: DataFrame) -> DataFrame:
    """Answers that say tests or builds pass in sessions without such a
    passing command."""
    from ..functions.text import claims_success

    command = F.lower(F.coalesce("command", F.lit("")))
    real = evidence.where(
        (F.col("kind") == "command") & (F.col("status") == "verified") & (F.col("exit_code") == 0) & has_any(command, ["test", "pytest", "jest", "build", "check"])
    )
    return answers.where(claims_success(F.col("content"))).join(real.select("session_id").distinct(), "session_id", "left_anti")


def response_exit_code(text: Column, failed_tools: Column) -> Column:
    """2 if a tool call failed or the text says so, else 0."""
    return F.when(failed_tools | F.coalesce(text, F.lit("")).rlike(r"(?m)^(❌|BLOCKED:)"), 2).otherwise(0)


def report_sections(reports: DataFrame) -> DataFrame:
    """Markdown of final reports(status, objective, criteria, files, checks)."""
    item = lambda xs, f: F.array_join(F.transform(xs, f), "\n")
    body = F.concat_ws(
        "\n",
        F.concat(F.lit("# Run report: "), F.col("status")),
        F.lit("## Objective"), F.col("objective"),
        F.lit("## Criteria"), item(F.col("criteria"), lambda c: F.concat(F.when(c["status"] == "SATISFIED", "- [x] ").otherwise("- [ ] "), c["criterion"])),
        F.lit("## Files"), item(F.col("files"), lambda f: F.concat(F.lit("- "), f)),
        F.lit("## Checks"), item(F.col("checks"), lambda c: F.concat(F.lit("- "), c)),
    )
    return reports.withColumn("markdown", body)
