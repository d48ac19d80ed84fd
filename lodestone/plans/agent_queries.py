"""Registered queries of the operators on agents' work, prompts, paths and checks.

Inputs are the whole synthetic tables; their SQL evaluates the same rules on the
same columns, with the rules' values spelled out.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import paths, text
from ..operators import agents, ledger, security, snapshots
from . import tables as t
from .queries import query

# ------------------------------------------------------------ paths and names


@query(
    "h4_module_names",
    f"WITH b AS (SELECT path, regexp_replace(path, '\\.[^./]+$', '') AS bare FROM {t.DOC_FILES}) "
    "SELECT path, unnest(list_distinct([bare, replace(bare, '/', '.'), regexp_extract(bare, '[^/]+$')])) AS module FROM b",
)
def module_names(spark, d):
    return t.doc_files(spark, d).select("path", F.explode(paths.module_names(F.col("path"))).alias("module"))


_NAME = "[A-Za-z0-9][A-Za-z0-9_.-]{0,127}"


@query("k33_identifiers", f"SELECT p_partkey, regexp_full_match(p_name, '{_NAME}') AS name_ok, regexp_full_match(p_type, '{_NAME}') AS type_ok, regexp_full_match(p_brand, '{_NAME}') AS brand_ok FROM part")
def identifiers(spark, d):
    ok = lambda c: paths.is_identifier(F.col(f"p_{c}")).alias(f"{c}_ok")
    return t.table(spark, d, "part").select("p_partkey", ok("name"), ok("type"), ok("brand"))


_PLACES = ["app/.env", ".env.local", "home/.SSH/config", "keys/id_rsa", "a/Credentials.json", "docs/env.md", "repo/.git/HEAD", "src/main.py"]


@query(
    "b17_sensitive_paths",
    f"WITH p AS (SELECT event_id, event_type || '/' || {_PLACES!r}[event_id % {len(_PLACES)} + 1] AS path FROM events) "
    "SELECT event_id, path, regexp_matches(lower(path), '(^|/)(\\.env|\\.env\\.[^/]*|\\.netrc|\\.npmrc|\\.pypirc|credentials\\.json|id_dsa|id_ecdsa|id_ed25519|id_rsa)$') "
    "OR regexp_matches(lower(path), '(^|/)(\\.aws|\\.git|\\.ssh)(/|$)') AS sensitive FROM p",
)
def sensitive_paths(spark, d):
    place = F.get(F.array(*[F.lit(x) for x in _PLACES]), (F.col("event_id") % len(_PLACES)).cast("int"))
    rows = t.table(spark, d, "events").select("event_id", F.concat_ws("/", "event_type", place).alias("path"))
    return rows.select("event_id", "path", paths.is_sensitive(F.col("path")).alias("sensitive"))


@query("h27_labels", "SELECT doc_id, substr(regexp_replace(regexp_replace(text, '[^A-Za-z0-9_.-]+', '-', 'g'), '^[-.]+|[-.]+$', '', 'g'), 1, 160) AS label FROM documents")
def labels(spark, d):
    return t.table(spark, d, "documents").select("doc_id", text.label_name(F.col("text")).alias("label"))


@query("h13_file_summaries", f"""SELECT doc_id, concat_ws(' | ', len(string_split(text, chr(10))) + 2 || ' lines',
 CASE WHEN path LIKE '%.py' THEN 'python' WHEN path LIKE '%.ts' THEN 'typescript' WHEN path LIKE '%.sql' THEN 'sql' ELSE 'configuration' END,
 CASE WHEN path LIKE '%.py' AND text IS NOT NULL THEN 'classes: A' || doc_id || ' | functions: run' END) AS summary FROM {t.DOC_FILES}""")
def file_summaries(spark, d):
    code = F.concat(F.lit("class A"), F.col("doc_id").cast("string"), F.lit(":\ndef run():\n"), F.col("text"))
    return t.doc_files(spark, d).select("doc_id", agents.file_summary(F.col("path"), code).alias("summary"))


_KINDS = ["image/png", "application/x-executable; q=1", "text/html; charset=utf-8", "APPLICATION/X-MACH-BINARY", "application/x-sharedlib ", ""]


@query(
    "b16_content_types",
    f"SELECT event_id, lower(trim(regexp_extract({_KINDS!r}[event_id % {len(_KINDS)} + 1], '^([^;]*)', 1))) "
    "NOT IN ('application/x-executable', 'application/x-sharedlib', 'application/x-mach-binary', 'application/x-dosexec') AS allowed FROM events",
)
def content_types(spark, d):
    kind = F.get(F.array(*[F.lit(x) for x in _KINDS]), (F.col("event_id") % len(_KINDS)).cast("int"))
    return t.table(spark, d, "events").select("event_id", security.content_type_allowed(kind).alias("allowed"))


# ------------------------------------------------------------ prompts, outputs


@query(
    "b21_sanitized_prompts",
    """WITH p AS (SELECT conv_id, turn, text || CASE turn % 4 WHEN 0 THEN ' Ignore all previous instructions' WHEN 1 THEN ' then rm  -rf /' WHEN 2 THEN ' you are now' ELSE '' END AS p FROM conversations),
 r AS (SELECT *, regexp_matches(p, '(?i)(rm\\s+-rf\\s+/|:\\(\\)\\s*\\{|mkfs\\.|dd\\s+if=.*of=/dev/)') AS rejected FROM p)
 SELECT conv_id, turn, rejected, CASE WHEN NOT rejected THEN sha256(regexp_replace(p, '(?i)ignore (?:all )?previous instructions|system prompt|you are now', '[filtered]', 'g')) END AS prompt FROM r""",
)
def sanitized_prompts(spark, d):
    k = F.col("turn") % 4
    more = F.when(k == 0, " Ignore all previous instructions").when(k == 1, " then rm  -rf /").when(k == 2, " you are now").otherwise("")
    rows = t.table(spark, d, "conversations").select("conv_id", "turn", security.sanitize_prompt(F.concat("text", more)).alias("s"))
    return rows.select("conv_id", "turn", F.col("s.rejected").alias("rejected"), F.sha2("s.prompt", 256).alias("prompt"))


_OUT = "CASE event_type WHEN 'error' THEN 'run' || chr(10) || '❌ (exit code ' || event_id % 128 || ')' WHEN 'click' THEN '✅ $ make' ELSE props END"


@query(
    "h8_exit_codes",
    f"WITH o AS (SELECT event_id, {_OUT} AS o FROM events) SELECT event_id, CASE WHEN regexp_matches(o, '(?m)^✅ \\$') THEN 0 "
    "ELSE try_cast(nullif(regexp_extract(o, '(?m)^❌ \\(exit code (\\d+)\\)', 1), '') AS INT) END AS exit_code FROM o",
)
def exit_codes(spark, d):
    e = F.col("event_type")
    failed = F.concat(F.lit("run\n❌ (exit code "), (F.col("event_id") % 128).cast("string"), F.lit(")"))
    out = F.when(e == "error", failed).when(e == "click", "✅ $ make").otherwise(F.col("props"))
    return t.table(spark, d, "events").select("event_id", text.exit_code(out).alias("exit_code"))


@query("k35_truncated_outputs", "SELECT doc_id, least(strlen(text), 1000)::INT AS kept, strlen(text) > 1000 AS truncated FROM documents")
def truncated_outputs(spark, d):
    cut = text.truncate_bytes(F.col("text").cast("binary"), 1000)
    return t.table(spark, d, "documents").select("doc_id", F.octet_length(cut["bytes"]).alias("kept"), cut["truncated"].alias("truncated"))


@query(
    "h10_step_risks",
    "SELECT doc_id, CASE WHEN regexp_matches(lower(concat_ws(' ', source, text)), 'deploy|migration|authentication|security|dependency|commit|database') THEN 'high' "
    "WHEN doc_id % 2 <> 0 THEN 'low' ELSE 'medium' END AS risk FROM documents",
)
def step_risks(spark, d):
    return t.table(spark, d, "documents").select("doc_id", text.step_risk(F.col("source"), F.col("text"), F.col("lang"), F.col("doc_id") % 2 == 0).alias("risk"))


@query(
    "k4_response_usage",
    """WITH r AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN '{"usage":{"prompt_tokens":' || event_id || ',"completion_tokens":7}}' WHEN 1 THEN '{"usage":{"prompt_tokens":"x"}}' ELSE props END AS r FROM events)
 SELECT event_id, coalesce(try_cast(nullif(regexp_extract(r, '"prompt_tokens":(\\d+)', 1), '') AS BIGINT), 0) AS prompt_tokens,
 coalesce(try_cast(nullif(regexp_extract(r, '"completion_tokens":(\\d+)', 1), '') AS BIGINT), 0) AS completion_tokens FROM r""",
)
def response_usage(spark, d):
    k = F.col("event_id") % 3
    whole = F.concat(F.lit('{"usage":{"prompt_tokens":'), F.col("event_id").cast("string"), F.lit(',"completion_tokens":7}}'))
    body = F.when(k == 0, whole).when(k == 1, '{"usage":{"prompt_tokens":"x"}}').otherwise(F.col("props"))
    return t.table(spark, d, "events").select("event_id", agents.usage_of(body).alias("u")).select("event_id", "u.*")


_SCRUB = "regexp_replace(html, '(?m)//.*$|(?s:/\\*.*?\\*/)|(?s:''(?:\\\\.|[^''\\\\])*'')|(?s:\"(?:\\\\.|[^\"\\\\])*\")|(?s:`(?:\\\\.|[^`\\\\])*`)', '', 'g')"


@query(
    "b30_truncated_code",
    f"WITH b AS (SELECT page_id, html, {_SCRUB} AS s FROM pages), n AS (SELECT page_id, html, "
    + ", ".join(f"length(s) - length(replace(s, '{c}', '')) AS n{i}" for i, c in enumerate("{}()[]"))
    + " FROM b) SELECT page_id, CASE WHEN regexp_full_match(html, '\\s*') THEN 'candidate is empty' "
    "WHEN regexp_matches(html, '(\\.\\.\\.|…)\\s*\\z') THEN 'candidate ends with an ellipsis and appears truncated' "
    "WHEN n0 <> n1 THEN 'unbalanced {} delimiters; output appears truncated' WHEN n2 <> n3 THEN 'unbalanced () delimiters; output appears truncated' "
    "WHEN n4 <> n5 THEN 'unbalanced [] delimiters; output appears truncated' END AS reason FROM n",
)
def truncated_code(spark, d):
    return t.table(spark, d, "pages").select("page_id", agents.truncation_reason(F.lit("page.js"), F.col("html")).alias("reason"))


@query(
    "h21_mutations",
    "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN substr(text, 1, 200) IS NOT DISTINCT FROM text ELSE coalesce(contains(text, substr(text, 1, 200)), false) END AS verified FROM documents",
)
def mutations(spark, d):
    part = F.substring("text", 1, 200)
    return t.table(spark, d, "documents").select("doc_id", snapshots.mutation_verified(part, F.col("text"), F.col("doc_id") % 2 == 0).alias("verified"))


# ------------------------------------------------------------ routing, reports

_HARD = [
    "concurren", "thread", "async", "broadcast", "tcp", "database", "migration", "security", "authentication", "authorization",
    "architecture", "distributed", "merge conflict", "rebase", "package.json", "cargo.toml", "go.mod",
]


@query(
    "b22_task_routes",
    f"""WITH h AS (SELECT *, list_filter({_HARD!r}, lambda w: contains(lower(text), w))[1:3] AS hard FROM documents),
 r AS (SELECT doc_id, CASE WHEN lang = 'es' THEN 'underspecified' WHEN doc_id % 3 > 1 AND contains(lower(text), 'json') THEN 'multi-file json'
 WHEN len(hard) > 0 THEN 'high-risk: ' || array_to_string(hard, ', ') WHEN length(text) > 700 THEN 'too long' END AS reason FROM h)
 SELECT doc_id AS id, CASE WHEN reason IS NULL THEN 'local' ELSE 'hosted' END AS route, coalesce(reason, 'atomic') AS reason FROM r""",
)
def task_routes(spark, d):
    rows = t.table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("description"), F.when(F.col("lang") == "es", "vague").otherwise("atomic").alias("scope_level"), (F.col("doc_id") % 3).alias("expected_files")
    )
    return agents.route_tasks(rows).select("id", "route", "reason")


def _executions(spark, d):
    p = F.col("o_orderpriority")
    return t.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "local").otherwise("hosted").alias("node"),
        F.when(p == "1-URGENT", "VALIDATED").when(p == "2-HIGH", "CEILING_PASS").otherwise(p).alias("verdict"),
        (p == "1-URGENT").alias("escalated"), (F.col("o_orderkey") % 3).alias("retries"),
    )


_EXECUTIONS = """(SELECT CASE WHEN o_orderstatus = 'F' THEN 'local' ELSE 'hosted' END AS node, o_orderpriority = '1-URGENT' AS escalated, o_orderkey % 3 AS retries,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'VALIDATED' WHEN '2-HIGH' THEN 'CEILING_PASS' ELSE o_orderpriority END AS verdict FROM orders)"""


@query("k15_node_breakdown", f"SELECT node, count(*) AS tasks, count(*) FILTER (verdict IN ('VALIDATED', 'CEILING_PASS')) AS passed, string_agg(DISTINCT verdict, ', ' ORDER BY verdict) AS verdicts FROM {_EXECUTIONS} GROUP BY 1")
def node_breakdown(spark, d):
    return agents.node_breakdown(_executions(spark, d))


@query("d12_routing_report", f"SELECT count(*) FILTER (node = 'local') AS local_tasks, count(*) FILTER (node = 'hosted') AS hosted_tasks, sum(retries)::BIGINT AS retries, count(*) FILTER (escalated) AS escalations FROM {_EXECUTIONS}")
def routing_report(spark, d):
    return agents.routing_report(_executions(spark, d))


_WORD = "[\\p{L}\\p{M}\\p{N}_]"
_APART = "[^\\p{L}\\p{M}\\p{N}_]"


@query(
    "b23_guardrails",
    f"""WITH m AS (SELECT *, list_filter([source, 'the', 'de'], lambda w: NOT regexp_matches(text, '(^|{_APART})' || w || '({_APART}|$)')) AS missing FROM documents)
 SELECT doc_id AS id, CASE WHEN lang NOT IN ('en', 'fr') OR doc_id % 3 < 1 OR (lang = 'en' AND doc_id % 3 <> 1) THEN 'REJECT_SCOPE'
 WHEN doc_id % 7 <> 0 AND doc_id % 2 <> doc_id % 3 THEN 'REJECT_FILE_COUNT' WHEN len(missing) > 0 THEN 'REJECT_FUNC_NAME' ELSE 'PASS' END AS verdict,
 array_to_string(missing, ',') AS missing FROM m""",
)
def guardrails(spark, d):
    lang, i = F.col("lang"), F.col("doc_id")
    rows = t.table(spark, d, "documents").select(
        i.alias("id"), F.when(lang == "en", "atomic").when(lang == "fr", "multi_file").otherwise("vague").alias("scope_level"), (i % 3).alias("expected_files"),
        (i % 2).alias("actual_files"), (i % 7 == 0).alias("answered"), F.array("source", F.lit("the"), F.lit("de")).alias("expected_names"), F.col("text").alias("output"),
    )
    return agents.guardrail(rows).select("id", "verdict", F.array_join("missing", ",").alias("missing"))


@query("k14_outcomes", "SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, 'A'))) > 0 AND lang IN ('en', 'fr') AS success FROM documents")
def outcomes(spark, d):
    found = F.filter(F.split("text", "\n", -1), lambda x: x.startswith("A"))
    verdict = F.when(F.col("lang") == "en", "VALIDATED").when(F.col("lang") == "fr", "CEILING_PASS").otherwise("REJECTED")
    return t.table(spark, d, "documents").select("doc_id", agents.outcome(found, verdict).alias("success"))


@query("d18_grouped_names", "SELECT p_type, count(*) AS n, string_agg(p_name, ', ' ORDER BY p_name) AS names FROM part GROUP BY 1")
def grouped_names(spark, d):
    return agents.grouped_names(t.table(spark, d, "part"), "p_type", "p_name")


_ROOT = ["README.md", "setup.py", "Cargo.toml", "package.json", "tsconfig.json", "go.mod", "docs/setup.py"]


@query(
    "b29_project_types",
    f"WITH f AS (SELECT o_custkey AS project, {_ROOT!r}[o_orderkey % {len(_ROOT)} + 1] AS path FROM orders) SELECT project, "
    "coalesce(['python', 'typescript', 'javascript', 'rust', 'go'][min(list_position(['setup.py', 'tsconfig.json', 'package.json', 'Cargo.toml', 'go.mod'], path))], 'unknown') AS type FROM f GROUP BY 1",
)
def project_types(spark, d):
    path = F.get(F.array(*[F.lit(x) for x in _ROOT]), (F.col("o_orderkey") % len(_ROOT)).cast("int"))
    return agents.project_types(t.table(spark, d, "orders").select(F.col("o_custkey").alias("project"), path.alias("path")))


@query(
    "k12_contexts",
    f"SELECT source, sha256(string_agg('# ' || path || chr(10) || substr(text, 1, 1200), chr(10) || chr(10) ORDER BY doc_id)) AS context FROM (SELECT f.*, source FROM {t.DOC_FILES} f JOIN documents USING (doc_id)) GROUP BY 1",
)
def contexts(spark, d):
    files = t.doc_files(spark, d).select("doc_id", "path", F.col("text").alias("content"), F.substring_index("path", "/", 1).alias("source"))
    return agents.context_text(files, "source", "doc_id").select("source", F.sha2("context", 256).alias("context"))


@query("d24_content_hashes", "SELECT source, sha256(string_agg(text, '' ORDER BY doc_id)) AS sha256 FROM documents GROUP BY 1")
def content_hashes(spark, d):
    files = t.table(spark, d, "documents").select("source", F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"))
    return agents.content_hash(files, "source")


@query(
    "k16_agent_results",
    "SELECT user_id, count(*) AS calls, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS files, coalesce(string_agg(CASE WHEN event_id % 4 = 0 THEN props END, '|' ORDER BY event_id), '') AS errors FROM events GROUP BY 1",
)
def agent_results(spark, d):
    rows = t.table(spark, d, "events").select("user_id", F.col("event_id").alias("seq"), F.col("event_type").alias("path"), (F.col("event_id") % 4 != 0).alias("success"), F.col("props").alias("result"))
    return agents.agent_result(rows, "user_id").select("user_id", "calls", F.array_join("files", ",").alias("files"), F.array_join("errors", "|").alias("errors"))


@query(
    "d10_team_reports",
    """WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r, row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY event_id) AS b FROM events)
 SELECT user_id, count(*) AS agents, count(*) FILTER (event_type <> 'error') AS passed, string_agg(event_type, ',' ORDER BY event_id) FILTER (r <= 20) AS findings,
 coalesce(string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (event_type = 'error' AND b <= 10), '') AS errors, count(DISTINCT event_type)::INT AS files, sum(event_id % 5)::BIGINT AS calls FROM e GROUP BY 1""",
)
def team_reports(spark, d):
    bad = F.col("event_type") == "error"
    rows = t.table(spark, d, "events").select(
        "user_id", F.col("event_id").alias("seq"), (~bad).alias("succeeded"), F.array("event_type").alias("findings"),
        F.when(bad, F.array(F.col("event_id").cast("string"))).otherwise(F.array().cast("array<string>")).alias("errors"), F.array("event_type").alias("files"), (F.col("event_id") % 5).alias("calls"),
    )
    got = agents.team_report(rows, "user_id")
    return got.withColumn("findings", F.array_join("findings", ",")).withColumn("errors", F.array_join("errors", ","))


# ------------------------------------------------------------ checks, evidence


@query(
    "b26_unsupported_claims",
    f"""WITH a AS (SELECT 2 * conv_id AS session_id, turn, text || CASE WHEN turn % 2 = 0 THEN ' All tests have passed.' ELSE '' END AS content FROM conversations)
 SELECT session_id, turn FROM a WHERE regexp_matches(content, '(?i)\\b(tests?|checks?|build)\\b.{{0,30}}\\b(pass(?:ed|ing)?|green|success)') AND session_id NOT IN
 (SELECT session_id FROM {t.EVIDENCE} WHERE kind = 'command' AND status = 'verified' AND exit_code = 0 AND regexp_matches(lower(command), 'test|jest|build|check'))""",
)
def unsupported_claims(spark, d):
    content = F.concat("text", F.when(F.col("turn") % 2 == 0, " All tests have passed.").otherwise(""))
    answers = t.table(spark, d, "conversations").select((2 * F.col("conv_id")).alias("session_id"), "turn", content.alias("content"))
    return ledger.unsupported_claims(answers, t.evidence(spark, d)).select("session_id", "turn")


@query(
    "k18_mirrored_checks",
    "SELECT user_id AS session_id, event_id AS seq, printf('ev-%06d', event_id) AS id, 'command' AS kind, 'project verification: ' || event_type AS claim, CASE WHEN value > 50 THEN 'verified' ELSE 'failed' END AS status, "
    "'verification' AS tool, 'run ' || event_type AS command, CASE WHEN value > 50 THEN 0 ELSE 1 END AS exit_code, props AS raw_output FROM events",
)
def mirrored_checks(spark, d):
    rows = t.table(spark, d, "events").select(
        F.col("user_id").alias("session_id"), F.col("event_id").alias("seq"), F.col("event_type").alias("type"), F.concat(F.lit("run "), "event_type").alias("command"),
        (F.col("value") > 50).alias("passed"), F.col("props").alias("output"),
    )
    return agents.mirror_checks(rows)


@query("d14_scan_verdict", "SELECT CASE WHEN count(*) FILTER (event_type IN ('error', 'purchase')) > 0 THEN 'FAILED' ELSE 'PASSED' END AS verdict, count(*) FILTER (event_type IN ('error', 'purchase')) AS blocking, count(*) AS findings FROM events")
def scan_verdict(spark, d):
    e = F.col("event_type")
    return security.scan_verdict(t.table(spark, d, "events").select(F.when(e == "error", "critical").when(e == "purchase", "high").otherwise("low").alias("severity")))


@query(
    "k26_secret_lines",
    f"""SELECT path, i::INT AS line FROM (SELECT path, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT path, string_split_regex(regexp_replace(text || CASE WHEN doc_id % 10 = 1 THEN chr(10) || 'db_Password = 1' ELSE '' END, '(\\r\\n|\\r|\\n)\\z', ''), '\\r\\n|\\r|\\n') AS ls
 FROM {t.DOC_FILES} WHERE path LIKE '%.py' OR path LIKE '%.ts')) WHERE regexp_matches(ls[i], '(?i)password|secret|api_key|private_key')""",
)
def secret_lines(spark, d):
    more = F.when(F.col("doc_id") % 10 == 1, "\ndb_Password = 1").otherwise("")
    return security.naive_secret_lines(t.doc_files(spark, d).withColumn("text", F.concat("text", more)))


@query("b24_contracts", "SELECT event_id AS id, event_type <> 'error' AND regexp_extract(props, '\"k\": *(\\d+)', 1) = '69' AS passed FROM events")
def contracts(spark, d):
    rows = t.table(spark, d, "events").select(
        F.col("event_id").alias("id"), F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"), F.lit(200).alias("expected_status"), F.col("props").alias("body"), F.lit('{"k": 69}').alias("expected")
    )
    return security.api_contract(rows)


@query(
    "c18_package_verdicts",
    """WITH r AS (SELECT lower(p_name) AS name, min(p_partkey) AS k, sum(p_size) AS downloads FROM part GROUP BY 1),
 p AS (SELECT DISTINCT CASE p_partkey % 2 WHEN 0 THEN 'crates' ELSE 'npm' END AS registry, lower(p_name) AS name FROM part)
 SELECT registry, p.name, CASE WHEN registry = 'npm' THEN 'unverified' WHEN k % 5 = 0 THEN 'blocked' WHEN 31 - k % 60 < 30 OR downloads < 100 THEN 'warn' ELSE 'pass' END AS verdict FROM p JOIN r USING (name)""",
)
def package_verdicts(spark, d):
    part = t.table(spark, d, "part")
    names = part.select(F.when(F.col("p_partkey") % 2 == 0, "crates").otherwise("npm").alias("registry"), F.col("p_name").alias("name"))
    known = part.groupBy(F.lower("p_name").alias("name")).agg(F.min("p_partkey").alias("k"), F.sum("p_size").alias("downloads"))
    known = known.select(F.lit("crates").alias("registry"), "name", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("k") % 60).cast("int")).alias("first_release"), "downloads", (F.col("k") % 5 != 0).alias("known"))
    return security.check_packages(names, known, "2024-02-01")


@query("c13_not_changed", "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN '' ELSE event_type END AS missing FROM events")
def not_changed(spark, d):
    missing = snapshots.not_changed(F.array(F.lit("view"), F.col("event_type")), F.array(F.lit("click"), F.lit("view")))
    return t.table(spark, d, "events").select("event_id", F.array_join(missing, ",").alias("missing"))


@query("h26_arguments", "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN event_type END AS path FROM events")
def arguments(spark, d):
    name = F.get(F.array(*map(F.lit, ["path", "filename", "target_file", "other"])), (F.col("event_id") % 4).cast("int"))
    return t.table(spark, d, "events").select("event_id", agents.argument(F.create_map(name, F.col("event_type")), "path").alias("path"))


@query("f11_sorted_positions", "SELECT o_orderkey, CASE WHEN o_orderkey % 100 % 7 = 0 THEN (o_orderkey % 100 // 7)::INT ELSE -1 END AS at FROM orders")
def sorted_positions(spark, d):
    values = F.sequence(F.lit(0).cast("long"), F.lit(100).cast("long"), F.lit(7).cast("long"))
    return t.table(spark, d, "orders").select("o_orderkey", agents.sorted_position(values, F.col("o_orderkey") % 100).alias("at"))


@query("k36_environment", "SELECT event_id, CASE WHEN event_type = 'click' THEN 'APP_click,click' ELSE 'APP_' || event_type END AS names FROM events")
def environment(spark, d):
    env = F.create_map(F.concat(F.lit("APP_"), "event_type"), F.lit("x"), F.col("event_type"), F.lit("y"))
    return t.table(spark, d, "events").select("event_id", F.array_join(F.array_sort(F.map_keys(agents.safe_environment(env, ["click"], "APP_"))), ",").alias("names"))
