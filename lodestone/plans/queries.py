"""Registered queries of the engine's operators, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import globs, paths, rules, text
from ..operators import conversations, documents, graph, ledger, parsing, reflection, results, security, snapshots, tasks
from ..sources import readers
from ..streaming import stateful
from . import tables as t

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ------------------------------------------------------------ relevance, search

RELEVANT = "fix the token and password under the Apache License"
_TERMS = ["token", "password", "under", "apache", "license"]


@query(
    "f4_relevant_documents",
    "WITH s AS (SELECT doc_id, "
    + " + ".join(f"CASE WHEN contains(lower(text), '{w}') THEN 6 ELSE 0 END + CASE WHEN contains(lower(source), '{w}') THEN 8 ELSE 0 END" for w in _TERMS)
    + " AS score FROM documents), r AS (SELECT doc_id, score::INT AS score, row_number() OVER (ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0) SELECT * FROM r WHERE rank <= 40",
)
def relevant_documents(spark, d):
    docs = t.table(spark, d, "documents").select("doc_id", "text", "source")
    return graph.relevance(docs, RELEVANT, {"text": (F.lower("text"), 6), "source": (F.lower("source"), 8)}, key="doc_id")


@query("a6_lines", "SELECT doc_id, i::INT AS line, ls[i] AS text FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '\\n\\z', ''), chr(10)) AS ls FROM documents)) WHERE i BETWEEN 2 AND 4")
def lines(spark, d):
    return documents.read_lines(t.table(spark, d, "documents").select("doc_id", "text"), "doc_id", 2, 4, 1 << 31)


@query("a12_fingerprints", "SELECT doc_id, sha256(text) AS sha256, strlen(text)::BIGINT AS size FROM documents")
def fingerprints(spark, d):
    return t.table(spark, d, "documents").select("doc_id", snapshots.fingerprint(F.col("text").cast("binary")).alias("f")).select("doc_id", "f.*")


@query(
    "b4_search",
    f"WITH l AS (SELECT path, ls[i] AS text, i::INT AS line FROM (SELECT path, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT path, string_split(text, chr(10)) AS ls FROM {t.DOC_FILES}))) "
    "SELECT path, line, text FROM l WHERE regexp_matches(text, 'password|apache', 'i') ORDER BY path, line LIMIT 50",
)
def search(spark, d):
    return documents.search(t.doc_files(spark, d), "password|apache", "*", 50)


@query("a8_find_files", f"SELECT path FROM {t.DOC_FILES} WHERE path LIKE '%/tests/%.py' ORDER BY path LIMIT 100")
def find_files(spark, d):
    return documents.find_files(t.doc_files(spark, d), "*/tests/*.py")


@query(
    "b6_path_facts",
    f"SELECT path, CASE regexp_extract(path, '\\.([a-z]+)$', 1) WHEN 'py' THEN 'python' WHEN 'ts' THEN 'typescript' WHEN 'sql' THEN 'sql' ELSE 'configuration' END AS language, "
    f"contains(path, '/tests/') AS is_test, path LIKE '%.yaml' AS configuration FROM {t.DOC_FILES}",
)
def path_facts(spark, d):
    p = F.col("path")
    return t.doc_files(spark, d).select("path", paths.language(p).alias("language"), paths.is_test(p).alias("is_test"), paths.is_configuration(p).alias("configuration"))


@query("d1_language_histogram", f"SELECT CASE regexp_extract(path, '\\.([a-z]+)$', 1) WHEN 'py' THEN 'python' WHEN 'ts' THEN 'typescript' WHEN 'sql' THEN 'sql' ELSE 'configuration' END AS language, count(*) AS files FROM {t.DOC_FILES} GROUP BY 1")
def language_histogram(spark, d):
    return graph.language_histogram(t.doc_files(spark, d).select(paths.language(F.col("path")).alias("language")))


@query("b20_glob_filter", f"SELECT path FROM {t.DOC_FILES} WHERE regexp_matches(path, '^src[0-9]/.*\\.(py|ts)$')")
def glob_filter(spark, d):
    return t.doc_files(spark, d).where(globs.matches_any(F.col("path"), ["src[0-9]/*.py", "src[0-9]/*.ts"])).select("path")


@query(
    "b1_symbols",
    "WITH p AS (SELECT p_name AS name, p_brand AS path, p_partkey::INT AS line FROM part), r AS (SELECT *, CASE WHEN lower(name) = 'ring' THEN 0 WHEN starts_with(lower(name), 'ring') THEN 1 WHEN contains(lower(name), 'ring') THEN 2 END AS rank FROM p) "
    "SELECT name, path, line, rank::INT AS rank FROM r WHERE rank IS NOT NULL ORDER BY rank, path, line LIMIT 50",
)
def symbols(spark, d):
    s = F.struct(F.col("p_name").alias("name"), F.lit("class").alias("kind"), F.col("p_brand").alias("path"), F.col("p_partkey").cast("int").alias("line"), F.col("p_name").alias("qualified_name"))
    files = t.table(spark, d, "part").select(F.col("p_brand").alias("path"), F.array(s).alias("symbols"))
    return graph.find_symbols(files, "ring").select("name", "path", "line", "rank")


@query("b2_routes", "SELECT p_brand AS path, 'GET /' || p_type AS route, 'x' AS language FROM part WHERE contains(lower('GET /' || p_type), 'a')")
def routes(spark, d):
    files = t.table(spark, d, "part").select(F.col("p_brand").alias("path"), F.array(F.concat(F.lit("GET /"), F.col("p_type"))).alias("routes"), F.lit("x").alias("language"))
    return graph.routes(files, "A")


@query(
    "c2_callers",
    "WITH f AS (SELECT 's' || l_suppkey AS path, bool_or(l_partkey = 7) AS hit, any_value(l_suppkey % 5 = 0) AS is_test FROM lineitem GROUP BY 1) SELECT path, 'x' AS language, is_test FROM f WHERE hit ORDER BY is_test DESC, path LIMIT 100",
)
def callers(spark, d):
    files = t.table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.collect_set(F.col("l_partkey").cast("string")).alias("references"))
    files = files.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("path"), "references", F.lit("x").alias("language"), (F.col("l_suppkey") % 5 == 0).alias("is_test"))
    return graph.find_callers(files, "7")


def _graph(spark, d):
    n = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    li = t.table(spark, d, "lineitem")
    edges = li.where("l_linenumber % 2 = 1").select(n("s", "l_suppkey").alias("importer"), n("p", "l_partkey").alias("target"))
    edges = edges.unionByName(li.where("l_linenumber % 2 = 0").select(n("p", "l_partkey").alias("importer"), n("s", "l_suppkey").alias("target"))).distinct()
    files = t.table(spark, d, "supplier").select(n("s", "s_suppkey").alias("path"), (F.col("s_suppkey") % 4 == 0).alias("is_test"))
    return files.unionByName(t.table(spark, d, "part").select(n("p", "p_partkey").alias("path"), (F.col("p_partkey") % 3 == 0).alias("is_test"))), edges


_GRAPH = """WITH e AS (SELECT DISTINCT 's' || l_suppkey AS importer, 'p' || l_partkey AS target FROM lineitem WHERE l_linenumber % 2 = 1
 UNION SELECT DISTINCT 'p' || l_partkey, 's' || l_suppkey FROM lineitem WHERE l_linenumber % 2 = 0),
f AS (SELECT 's' || s_suppkey AS path, s_suppkey % 4 = 0 AS is_test FROM supplier UNION ALL SELECT 'p' || p_partkey, p_partkey % 3 = 0 FROM part),
v0 AS (SELECT * FROM f WHERE path IN ('p1', 'p3', 's8')), x0 AS (SELECT path, false AS is_test FROM v0)"""
for _k in range(1, 5):
    _GRAPH += f""", x{_k} AS (SELECT DISTINCT f.path, f.is_test FROM e JOIN x{_k - 1} x ON e.target = x.path AND NOT x.is_test JOIN f ON f.path = e.importer
 WHERE f.path NOT IN ({' UNION ALL '.join(f'SELECT path FROM x{j}' for j in range(_k))}))"""


@query("c3_impacted_tests", _GRAPH + " SELECT path FROM v0 WHERE is_test " + " ".join(f"UNION SELECT path FROM x{k} WHERE is_test" for k in range(1, 5)))
def impacted_tests(spark, d):
    files, edges = _graph(spark, d)
    return graph.impacted_tests(files, files.where(F.col("path").isin("p1", "p3", "s8")).select("path"), edges)


@query("c17_neighbours", _GRAPH.split("\nv0")[0].rstrip(",\n ") + " SELECT target AS path FROM e WHERE importer = 's1' UNION SELECT importer FROM e WHERE target = 's1'")
def neighbours(spark, d):
    return graph.neighbours(_graph(spark, d)[1], "s1")


@query("c1_import_edges")
def import_edges(spark, d):
    n = t.table(spark, d, "nation").count()
    files = t.table(spark, d, "nation").select(
        F.concat(F.lit("pkg/n"), F.col("n_nationkey").cast("string"), F.lit(".py")).alias("path"),
        F.array(F.concat(F.lit("pkg.n"), ((F.col("n_nationkey") + 1) % n).cast("string")), F.concat(F.lit("./lib/n"), (F.col("n_nationkey") * 2).cast("string"))).alias("imports"),
    )
    return graph.import_edges(files)


@query(
    "a37_owners",
    f"SELECT path, CASE WHEN path LIKE '%.sql' THEN '@data' WHEN regexp_matches(path, '(^|/)src1.*/.*$') THEN '@one' WHEN path LIKE 'src%' THEN '@all' ELSE '' END AS owners FROM {t.DOC_FILES}",
)
def owners(spark, d):
    rule = spark.createDataFrame([(0, "src*", ["@all"]), (1, "src1*/", ["@one"]), (2, "*.sql", ["@data"])], "rule_no int, pattern string, owners array<string>")
    return graph.owners(t.doc_files(spark, d), rule).select("path", F.array_join("owners", " ").alias("owners"))


# ------------------------------------------------------------------ rules


def _case(col: str, table, flags: str = "i") -> str:
    out = ""
    for r in table:
        p = r.pattern
        cond = f"regexp_matches({col}, {_q(p)}, '{flags}')"
        if "(?!.*WHERE)" in p:
            cond = f"(regexp_matches({col}, {_q(p.replace('(?!.*WHERE)', ''))}, '{flags}') AND NOT regexp_matches({col}, 'WHERE', '{flags}'))"
        out += f" WHEN {cond} THEN {_q(r.label)}"
    return out


@query("b10_command_safety", f"SELECT id, CASE{_case('command', rules.COMMAND_RULES)} ELSE 'safe' END AS level FROM {t.SHELL_SQL}")
def command_safety(spark, d):
    return t.shell(spark, d).select("id", rules.command_safety(F.col("command"))["label"].alias("level"))


@query("b11_file_write_safety", f"SELECT path, CASE{_case('path', rules.FILE_RULES)} ELSE 'safe' END AS level FROM {t.DOC_FILES}")
def file_write_safety(spark, d):
    return t.doc_files(spark, d).select("path", rules.file_write_safety(F.col("path"))["label"].alias("level"))


@query("b12_secret_labels", "SELECT doc_id, label FROM (" + " UNION ALL ".join(f"SELECT doc_id, {_q(r.label)} AS label FROM documents WHERE regexp_matches(text, {_q(r.pattern)}, 'i')" for r in rules.SECRET_RULES) + ")")
def secret_labels(spark, d):
    return t.table(spark, d, "documents").select("doc_id", F.explode(rules.secret_labels(F.col("text"))).alias("label"))


_COUNT = lambda p: f"len(regexp_extract_all(lower(text), {_q('(?i)' + p)}))"
_SCORES = {k: " + ".join(_COUNT(p) for p in ps) for k, ps in rules.INTENTS.items()}
_INTENT = (
    f"(SELECT id, text, CASE WHEN m.s > 0 THEN m.k WHEN regexp_matches(lower(text), {_q(rules.CHAT)}) THEN 'chat' ELSE 'unknown' END AS intent FROM (SELECT id, text, list_max(["
    + ", ".join(f"{{'s': {s}, 'o': {-i}, 'k': '{k}'}}" for i, (k, s) in enumerate(_SCORES.items()))
    + f"]) AS m FROM {t.REQUESTS_SQL}))"
)
_SCORE = " + ".join(_COUNT(p) for p in rules.COMPLEXITY)
_DIFF = f"""(SELECT *, CASE WHEN intent IN ('chat','explain','search') THEN CASE WHEN words < 15 THEN 'trivial' ELSE 'simple' END
 WHEN score >= 5 OR words > 100 THEN 'massive' WHEN score >= 3 OR words > 50 THEN 'complex' WHEN score >= 1 OR words > 20 THEN 'moderate' WHEN words > 8 THEN 'simple' ELSE 'trivial' END AS difficulty
 FROM (SELECT *, len(regexp_extract_all(text, '\\S+')) AS words, {_SCORE} AS score FROM {_INTENT}))"""


@query(
    "d7_classify_requests",
    f"SELECT id, intent, difficulty, CASE WHEN intent IN ('chat','explain','search') THEN 'direct' WHEN difficulty IN ('complex','massive') THEN 'planned' WHEN intent = 'unknown' AND difficulty = 'moderate' THEN 'research' ELSE 'direct' END AS plan_type FROM {_DIFF}",
)
def classify_requests(spark, d):
    return rules.classify_requests(t.requests(spark, d)).select("id", "intent", "difficulty", "plan_type")


@query("c15_skills", "SELECT id, skill FROM (" + " UNION ALL ".join(f"SELECT id, '{k}' AS skill FROM {t.REQUESTS_SQL} WHERE regexp_matches(lower(text), {_q(chr(92) + 'b(?:' + '|'.join(rules._quote(w) for w in ws) + ')' + chr(92) + 'b')})" for k, ws in rules.SKILLS.items()) + ")")
def skills(spark, d):
    return t.requests(spark, d).select("id", F.explode(rules.skills(F.col("text"))).alias("skill"))


_FAIL = ["the job timed out", "SyntaxError: x", "ModuleNotFoundError  y", "mypy: bad", "1 failed test", "npm ERESOLVE", "secret   detected", "command not found", "Traceback (most", "fine"]


@query(
    "h7_failure_kinds",
    f"SELECT id, CASE {' '.join('WHEN ' + ' OR '.join(f'contains(o, {_q(x)})' for x in ws) + f' THEN {_q(k)}' for k, ws in rules.FAILURE_KINDS)} ELSE 'unknown' END AS kind FROM (SELECT event_id AS id, regexp_replace(lower({_FAIL!r}[event_id % 10 + 1]), '\\s+', ' ', 'g') AS o FROM events)",
)
def failure_kinds(spark, d):
    o = F.get(F.array(*[F.lit(x) for x in _FAIL]), (F.col("event_id") % 10).cast("int"))
    return t.table(spark, d, "events").select(F.col("event_id").alias("id"), rules.failure_kind(o).alias("kind"))


@query(
    "b9_policy_decisions",
    f"SELECT doc_id AS id, 'write' AS capability, path AS target, CASE WHEN path LIKE 'src1%' THEN 'deny' WHEN path LIKE '%/tests/%' THEN 'ask' WHEN path LIKE 'src%' THEN 'allow' ELSE 'ask' END AS decision FROM {t.DOC_FILES}",
)
def policy_decisions(spark, d):
    req = t.doc_files(spark, d).select(F.col("doc_id").alias("id"), F.lit("write").alias("capability"), F.col("path").alias("target"))
    rule = spark.createDataFrame([("allow", "write", "src*"), ("ask", "write", "*/tests/*"), ("deny", "write", "src1*")], "decision string, capability string, pattern string")
    return rules.decide(req, rule, {"read": "allow"})


@query("b15_url_verdicts", "SELECT page_id, NULL::VARCHAR AS verdict FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT page_id, CASE page_id % 3 WHEN 1 THEN 'loopback' ELSE 'private_range' END FROM pages WHERE page_id % 3 <> 0")
def url_verdicts(spark, d):
    i = F.col("page_id") % 3
    url = F.when(i == 0, F.col("url")).when(i == 1, F.regexp_replace("url", "//[^/]+", "//127.0.0.1:80")).otherwise(F.regexp_replace("url", "//[^/]+", "//10.1.2.3"))
    return t.table(spark, d, "pages").select("page_id", security.url_verdict(url).alias("verdict"))


_SQLS = ["ALTER TABLE u DROP COLUMN email;", "DELETE FROM t; SELECT 1", "DELETE FROM t WHERE id = 1", "TRUNCATE TABLE x", "SELECT 2", "ALTER TABLE a RENAME TO b"]


@query("b14_migration_risks", f"SELECT event_id AS id, ['drop', 'unbounded-delete', NULL, 'truncate', NULL, 'rename'][event_id % 6 + 1] AS kind FROM events WHERE event_id % 6 IN (0, 1, 3, 5)")
def migration_risks(spark, d):
    s = t.table(spark, d, "events").select(F.col("event_id").alias("id"), F.get(F.array(*[F.lit(x) for x in _SQLS]), (F.col("event_id") % 6).cast("int")).alias("sql"))
    return security.migration_risks(s).select("id", "kind")


@query("b13_security_scan")
def security_scan(spark, d):
    return security.scan(security.scannable(t.doc_files(spark, d)))


@query("b27_redaction", "SELECT doc_id, sha256(regexp_replace(regexp_replace(text, '\\b(api[_-]?key|token|password|passwd|secret)\\s*=\\s*[^\\s]+', '\\1=[REDACTED]', 'gi'), '\\b(?:sk|gsk|nvapi|ghp)_[A-Za-z0-9_-]{8,}\\b|\\b(?:sk|gsk|nvapi)-[A-Za-z0-9_-]{8,}\\b', '[REDACTED_CREDENTIAL]', 'g')) AS sha FROM documents")
def redaction(spark, d):
    return t.table(spark, d, "documents").select("doc_id", F.sha2(text.redact_credentials(F.col("text")), 256).alias("sha"))


@query("b18_capabilities", "SELECT user_id::VARCHAR AS tool, NOT bool_or(event_type = 'error') AS permitted FROM events GROUP BY 1")
def capabilities(spark, d):
    e = t.table(spark, d, "events").groupBy(F.col("user_id").cast("string").alias("tool")).agg(F.collect_set("event_type").alias("declared"))
    e = e.withColumn("allowed", F.array().cast("array<string>")).withColumn("disallowed", F.array(F.lit("error")))
    return security.capability_check(e).select("tool", "permitted")


# ------------------------------------------------------------------- text


@query("h1_query_terms", f"SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[A-Za-z_][A-Za-z0-9_-]{{2,}}')) AS term FROM benchmark) WHERE term NOT IN ({', '.join(map(_q, text.STOP_WORDS))})")
def query_terms(spark, d):
    return t.table(spark, d, "benchmark").select("item_id", F.explode(text.query_terms(F.col("text"))).alias("term"))


@query("h2_strip_tags", "SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages")
def strip_tags(spark, d):
    return t.table(spark, d, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query("h2_html_to_text")
def html_to_text(spark, d):
    return t.table(spark, d, "pages").select("page_id", text.html_to_text(F.col("html")).alias("text"))


@query("a30_page_links")
def page_links(spark, d):
    return readers.search_results(t.table(spark, d, "pages"))


@query(
    "h3_human_sizes",
    "SELECT doc_id, CASE WHEN n < 1024 THEN n || 'B' WHEN n < 1048576 THEN round_even((n / 1024.0::DOUBLE)::DECIMAL(38,18), 1)::DECIMAL(38,1) || 'KB' WHEN n < 1073741824 THEN round_even((n / 1048576.0::DOUBLE)::DECIMAL(38,18), 1)::DECIMAL(38,1) || 'MB' ELSE round_even((n / 1073741824.0::DOUBLE)::DECIMAL(38,18), 1)::DECIMAL(38,1) || 'GB' END AS size FROM (SELECT doc_id, n_chars * 777 AS n FROM documents)",
)
def human_sizes(spark, d):
    return t.table(spark, d, "documents").select("doc_id", text.human_size(F.col("n_chars") * 777).alias("size"))


@query("h9_token_estimates", "SELECT doc_id, (length(text) // 4)::BIGINT AS by_four, (length(text) // 3)::BIGINT AS by_three, strlen(text)::BIGINT AS upper_bound FROM documents")
def token_estimates(spark, d):
    c = F.col("text")
    return t.table(spark, d, "documents").select("doc_id", text.tokens_by_chars(c, 4).alias("by_four"), text.tokens_by_chars(c, 3).alias("by_three"), F.octet_length(c).cast("bigint").alias("upper_bound"))


@query("d13_output_counts", "SELECT doc_id, (length(lower(text)) - length(replace(lower(text), 'the', ''))) // 3 AS n FROM documents WHERE false UNION ALL SELECT event_id, CASE event_type WHEN 'error' THEN 2 ELSE 0 END FROM events")
def output_counts(spark, d):
    e = t.table(spark, d, "events")
    n = text.F.lit(0) + results.output_counts(F.concat("event_type", F.lit(" "), "event_type"))["errors"]
    return e.select(F.col("event_id").alias("doc_id"), n.cast("bigint").alias("n"))


@query("h20_exact_edits", "SELECT item_id AS id, CASE WHEN n = 1 THEN replace(text, 'the', '[x]') ELSE text END AS after, n::INT AS found FROM (SELECT item_id, text, (length(text) - length(replace(text, 'the', ''))) // 3 AS n FROM benchmark)")
def exact_edits(spark, d):
    b = t.table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text", F.lit("the").alias("old"), F.lit("[x]").alias("new"))
    return documents.exact_edits(b)


@query("h19_diffs")
def diffs(spark, d):
    b = t.table(spark, d, "benchmark").select(F.col("item_id").cast("string").alias("path"), F.col("text").alias("before"), F.replace("text", F.lit("the"), F.lit("a")).alias("after"))
    return documents.unified_diffs(b)


@query("h22_versions", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'pkg' WHEN 1 THEN '@a/b' ELSE 'mod/x' END AS name FROM part")
def versions(spark, d):
    i = F.col("p_partkey") % 3
    n = F.when(i == 0, "pkg>=1.2").when(i == 1, "@a/b@2.0").otherwise("mod/x@v1")
    return t.table(spark, d, "part").select("p_partkey", text.strip_version(n, F.when(i == 0, "pypi").when(i == 1, "npm").otherwise("go")).alias("name"))


# --------------------------------------------------------------- snapshots

_OLD = "(SELECT o_orderkey::VARCHAR AS path, o_custkey AS mtime_ns, o_orderkey % 100 AS size FROM orders WHERE o_orderkey % 10 <> 0)"
_NEW = "(SELECT o_orderkey::VARCHAR AS path, o_custkey + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS mtime_ns, o_orderkey % 100 AS size FROM orders WHERE o_orderkey % 7 <> 0)"


def _states(spark, d):
    o = t.table(spark, d, "orders")
    k = F.col("o_orderkey")
    row = lambda m: [k.cast("string").alias("path"), m.alias("mtime_ns"), (k % 100).alias("size"), F.sha2(m.cast("string"), 256).alias("sha256")]
    return o.where(k % 10 != 0).select(*row(F.col("o_custkey"))), o.where(k % 7 != 0).select(*row(F.col("o_custkey") + F.when(k % 13 == 0, 1).otherwise(0)))


_PLAN = f"(SELECT coalesce(o.path, n.path) AS path, CASE WHEN n.path IS NULL THEN 'removed' WHEN o.path IS NOT NULL AND o.mtime_ns = n.mtime_ns AND o.size = n.size THEN 'reused' ELSE 'indexed' END AS action FROM {_OLD} o FULL JOIN {_NEW} n ON o.path = n.path)"


@query("c5_refresh_plan", f"SELECT * FROM {_PLAN}")
def refresh_plan(spark, d):
    return snapshots.refresh_plan(*_states(spark, d))


@query("d20_refresh_stats", f"SELECT count(*) FILTER (action <> 'removed') AS scanned, count(*) FILTER (action = 'indexed') AS indexed, count(*) FILTER (action = 'reused') AS reused, count(*) FILTER (action = 'removed') AS removed FROM {_PLAN}")
def refresh_stats(spark, d):
    return snapshots.refresh_stats(snapshots.refresh_plan(*_states(spark, d)))


@query("c6_changed_paths", f"SELECT coalesce(o.path, n.path) AS path FROM {_OLD} o FULL JOIN {_NEW} n ON o.path = n.path WHERE o.mtime_ns IS DISTINCT FROM n.mtime_ns")
def changed_paths(spark, d):
    return snapshots.changed_paths(*_states(spark, d))


@query("g1_removed_paths", f"SELECT path FROM {_OLD} EXCEPT SELECT path FROM {_NEW}")
def removed_paths(spark, d):
    old, new = _states(spark, d)
    return old.select("path").subtract(new.select("path"))


@query(
    "c4_evidence_drift",
    f"""WITH e AS (SELECT o_orderkey::VARCHAR AS id, 'claim' AS claim, o_orderkey % 3 AS k, o_orderkey::VARCHAR AS path, o_custkey AS want FROM orders)
SELECT e.id, e.claim, CASE WHEN k = 0 AND n.mtime_ns IS NOT DISTINCT FROM want THEN 'MATCH' WHEN k = 0 THEN 'FAIL' WHEN k = 1 THEN 'RERUN_REQUIRED' ELSE 'RECORDED' END AS verdict FROM e LEFT JOIN {_NEW} n USING (path)""",
)
def evidence_drift(spark, d):
    k = F.col("o_orderkey")
    art = F.struct(k.cast("string").alias("path"), F.lit(True).alias("exists"), F.sha2(F.col("o_custkey").cast("string"), 256).alias("sha256"), F.lit(1).cast("bigint").alias("size"))
    none = F.array().cast("array<struct<path:string,exists:boolean,sha256:string,size:bigint>>")
    e = t.table(spark, d, "orders").select(
        k.cast("string").alias("id"), F.when(k % 3 == 1, "command").otherwise("file_mutation").alias("kind"), F.lit("claim").alias("claim"),
        F.when(k % 3 == 0, F.array(art)).otherwise(none).alias("artifacts"),
    )
    return snapshots.drift(e, _states(spark, d)[1])


@query("c19_foreign_keys", "SELECT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)")
def foreign_keys(spark, d):
    return snapshots.orphans(t.table(spark, d, "lineitem").select("l_orderkey"), "l_orderkey", t.table(spark, d, "orders").where("o_orderkey % 3 <> 0"), "o_orderkey")


@query("a38_trust", f"SELECT n.path, CASE WHEN o.path IS NULL THEN 'PENDING' WHEN o.mtime_ns <> n.mtime_ns THEN 'CHANGED' WHEN o.size % 2 = 0 THEN 'APPROVED' ELSE 'PENDING' END AS state FROM {_NEW} n LEFT JOIN {_OLD} o USING (path)")
def trust(spark, d):
    old, new = _states(spark, d)
    return snapshots.trust(new, old.withColumn("approved", F.col("size") % 2 == 0))


# ------------------------------------------------------------------- tasks


@query("c7_ready_tasks", f"SELECT s.plan_id, s.id FROM {t.ORDER_STEPS} s LEFT JOIN (SELECT o_orderkey AS k, o_orderstatus AS st FROM orders) p ON s.dep = p.k WHERE s.status = 'PENDING' AND (s.dep IS NULL OR p.st = 'F')")
def ready_tasks(spark, d):
    return tasks.ready(t.order_steps(spark, d)).select("plan_id", "id")


@query("c8_blocked_tasks", f"SELECT s.plan_id, s.id, CASE WHEN s.status = 'PENDING' AND p.st = 'P' THEN 'BLOCKED' ELSE s.status END AS status FROM {t.ORDER_STEPS} s LEFT JOIN (SELECT o_orderkey AS k, o_orderstatus AS st FROM orders) p ON s.dep = p.k")
def blocked_tasks(spark, d):
    return tasks.block_orphans(t.order_steps(spark, d)).select("plan_id", "id", "status")


@query("d6_plan_progress", f"SELECT plan_id, count(*) AS steps, count(*) FILTER (status = 'COMPLETED') AS completed, 100.0::DOUBLE * count(*) FILTER (status = 'COMPLETED') / count(*) AS progress, bool_and(status = 'COMPLETED') AS is_complete, bool_or(status = 'FAILED') AS has_failures FROM {t.ORDER_STEPS} GROUP BY 1")
def plan_progress(spark, d):
    return tasks.progress(t.order_steps(spark, d))


@query("a23_recent_plans", f"WITH p AS (SELECT plan_id, count(*) AS steps, count(*) FILTER (status = 'COMPLETED') AS completed FROM {t.ORDER_STEPS} GROUP BY 1) SELECT * FROM p ORDER BY plan_id DESC LIMIT 10")
def recent_plans(spark, d):
    s = t.order_steps(spark, d)
    return tasks.recent_plans(s.select("plan_id").distinct(), s)


@query("g5_task_graph_problems", f"SELECT plan_id, id, 'unknown_dependency' AS problem FROM {t.ORDER_STEPS} WHERE id % 50 = 0 UNION ALL SELECT plan_id, id, 'self_dependency' FROM {t.ORDER_STEPS} WHERE id % 51 = 0 UNION ALL SELECT plan_id, id, 'cycle' FROM {t.ORDER_STEPS} WHERE id % 51 = 0")
def task_graph_problems(spark, d):
    k = F.col("id")
    s = t.order_steps(spark, d).withColumn("depends_on", F.when(k % 50 == 0, F.array(F.lit(-1).cast("bigint"))).otherwise(F.array().cast("array<bigint>")))
    return tasks.problems(s.withColumn("depends_on", F.when(k % 51 == 0, F.concat("depends_on", F.array(k))).otherwise(F.col("depends_on"))))


# ------------------------------------------------------------------ results

_SUM = """count(*) AS tasks, count(*) FILTER (status = 'PASSED') AS passed, count(*) FILTER (status <> 'PASSED') AS failed,
 round_even(count(*) FILTER (status = 'PASSED') / count(*), 4) AS success_rate, sum(duration_ms)::BIGINT AS total_duration_ms, sum(model_calls)::BIGINT AS total_model_calls,
 sum(prompt_tokens)::BIGINT AS total_prompt_tokens, sum(completion_tokens)::BIGINT AS total_completion_tokens, round_even(sum(coalesce(estimated_cost_usd, 0)), 8) AS total_cost_usd"""


@query("d3_benchmark_summary", f"SELECT category, {_SUM} FROM {t.RESULTS} GROUP BY 1")
def benchmark_summary(spark, d):
    return results.summary(t.results(spark, d), ["category"])


@query("d4_dashboard", f"WITH s AS (SELECT {_SUM} FROM {t.RESULTS}) SELECT tasks, round_even(success_rate * 100, 1) AS success_percent, round_even(total_duration_ms / 1000, 1) AS seconds, total_cost_usd AS cost_usd, (total_prompt_tokens + total_completion_tokens) / tasks AS tokens_per_task FROM s")
def dashboard(spark, d):
    return results.dashboard(t.results(spark, d))


@query("d5_verification", f"SELECT category, count(*) FILTER (passed) AS passed, count(*) AS total, bool_and(passed) AS all_passed FROM {t.RESULTS} GROUP BY 1")
def verification(spark, d):
    return results.verification_report(t.results(spark, d), "category")


@query("d9_step_verdicts", f"WITH s AS (SELECT category, count(*) AS n, count(*) FILTER (NOT passed) AS bad FROM {t.RESULTS} GROUP BY 1) SELECT category, n, bad, CASE WHEN bad = 0 THEN 'SUCCESS' WHEN bad = n OR bad / n > 0.5 THEN 'RETRY' ELSE 'CONTINUE' END AS verdict, CASE WHEN bad = 0 THEN 0.95 WHEN bad = n THEN 0.9 WHEN bad / n > 0.5 THEN 0.7 ELSE 0.6 END::DOUBLE AS confidence FROM s")
def step_verdicts(spark, d):
    return reflection.step_verdicts(t.results(spark, d).withColumnRenamed("passed", "success"), "category")


@query("a59_dashboard_rows", f"SELECT task_id, '<tr><td>' || task_id || '</td><td>' || category || '</td><td>' || status || '</td><td>' || duration_ms || '</td><td>done</td></tr>' AS html FROM {t.RESULTS}")
def dashboard_rows(spark, d):
    return results.html_rows(t.results(spark, d))


@query(
    "d25_judged_tasks",
    """SELECT o_orderkey AS task_id, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 AND o_orderstatus <> 'P' THEN 'PASSED' ELSE 'FAILED' END AS status,
 concat_ws('; ', CASE WHEN o_orderkey % 2 <> 0 THEN 'exit code 1' END, CASE WHEN o_orderkey % 3 = 0 THEN 'unexpected files: [''b.txt'']' END, CASE WHEN o_orderstatus = 'P' THEN 'run status: FAILED' END) AS detail FROM orders""",
)
def judged_tasks(spark, d):
    k = F.col("o_orderkey")
    arr = lambda *x: F.array(*[F.lit(v) for v in x])
    runs = t.table(spark, d, "orders").select(
        k.alias("task_id"), (k % 2).cast("int").alias("exit_code"), F.array(F.lit(True)).alias("checks"), F.when(k % 3 == 0, arr("src/a.py", "b.txt")).otherwise(arr("src/a.py")).alias("changed"),
        arr("src/*").alias("allowed"), arr("src/a.py").alias("expected"), F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("VERIFIED").alias("run_status"),
    )
    return results.judge_task(runs).select("task_id", "status", "detail")


@query("d11_usage", "SELECT l_suppkey, count(*) AS calls, sum(l_quantity::BIGINT)::BIGINT AS prompt_tokens, sum(l_linenumber)::BIGINT AS completion_tokens, (sum(l_quantity::BIGINT) * 2.0::DOUBLE + sum(l_linenumber) * 4.0::DOUBLE) / 1000000 AS cost_usd FROM lineitem GROUP BY 1")
def usage(spark, d):
    calls = t.table(spark, d, "lineitem").select("l_suppkey", F.col("l_quantity").cast("bigint").alias("prompt_tokens"), F.col("l_linenumber").alias("completion_tokens"))
    return results.usage(calls, "l_suppkey", 2.0, 4.0)


_CALLS = "(SELECT o_custkey AS session, o_orderkey AS seq, (o_orderkey * 37 % 500)::BIGINT AS prompt_tokens FROM orders)"


def _calls(spark, d):
    return t.table(spark, d, "orders").select(F.col("o_custkey").alias("session"), F.col("o_orderkey").alias("seq"), (F.col("o_orderkey") * 37 % 500).alias("prompt_tokens"), F.lit(0).alias("completion_tokens"))


@query("k3_running_usage", f"SELECT session, seq, sum(prompt_tokens) OVER w::BIGINT AS used_prompt, sum(prompt_tokens) OVER w > 1000 AS over FROM {_CALLS} WINDOW w AS (PARTITION BY session ORDER BY seq)")
def running_usage(spark, d):
    return results.running_usage(_calls(spark, d), "session", ["seq"], {"used_prompt": 1000, "used_completion": None}).select("session", "seq", "used_prompt", "over")


@query(
    "e8_budget_gate",
    f"""WITH RECURSIVE c AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY seq) AS r FROM {_CALLS}),
g AS (SELECT session, seq, r, (prompt_tokens <= 1200) AS accepted, CASE WHEN prompt_tokens <= 1200 THEN 1 ELSE 0 END AS n, CASE WHEN prompt_tokens <= 1200 THEN prompt_tokens ELSE 0 END AS used FROM c WHERE r = 1
 UNION ALL SELECT c.session, c.seq, c.r, (g.n < 4 AND g.used + c.prompt_tokens <= 1200), g.n + CASE WHEN g.n < 4 AND g.used + c.prompt_tokens <= 1200 THEN 1 ELSE 0 END,
 g.used + CASE WHEN g.n < 4 AND g.used + c.prompt_tokens <= 1200 THEN c.prompt_tokens ELSE 0 END FROM g JOIN c ON c.session = g.session AND c.r = g.r + 1)
SELECT session, seq, accepted FROM g""",
)
def budget_gate(spark, d):
    return results.budget_gate(_calls(spark, d), "session", "seq", 4, 1200)


# ------------------------------------------------------------ conversations


_PREVIEW = "CASE WHEN length(x) > 80 THEN x[:80] || '...' ELSE x END"


@query("e7_previews", f"SELECT conv_id, coalesce({_PREVIEW}, '(empty conversation)') AS preview FROM (SELECT conv_id, regexp_replace(min_by(text, turn) FILTER (role = 'user' AND text <> ''), '^\\s+|\\s+$', '', 'g') AS x FROM conversations GROUP BY 1)")
def previews(spark, d):
    return conversations.previews(t.table(spark, d, "conversations"))


@query("a22_conversation_list", f"SELECT conv_id, messages, coalesce({_PREVIEW}, '(empty conversation)') AS preview FROM (SELECT conv_id, count(*) AS messages, regexp_replace(min_by(text, turn) FILTER (role = 'user' AND text <> ''), '^\\s+|\\s+$', '', 'g') AS x FROM conversations GROUP BY 1) ORDER BY conv_id DESC LIMIT 20")
def conversation_list(spark, d):
    return conversations.listing(t.table(spark, d, "conversations"))


@query(
    "e6_compaction",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS a, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
o AS (SELECT conv_id, a, CASE WHEN role = 'user' AND text <> '' THEN 'User asked: ' || text[:200] WHEN role = 'assistant' AND text <> '' THEN 'Assistant: ' || text[:200] WHEN role = 'tool' THEN 'Tool result for : ' || text[:100] END AS p FROM r WHERE n > 4 AND a <= n - 2),
h AS (SELECT c.conv_id, {_q(conversations.HEAD)} || coalesce(x.s, '') || {_q(conversations.TAIL)} AS text FROM (SELECT DISTINCT conv_id FROM o) c LEFT JOIN
 (SELECT conv_id, string_agg(p, chr(10) ORDER BY a) AS s FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY a DESC) AS z FROM o WHERE p IS NOT NULL) WHERE z <= 20 GROUP BY 1) x USING (conv_id))
SELECT conv_id, (a - 1)::BIGINT AS turn, role, text FROM r WHERE n <= 4 UNION ALL SELECT conv_id, 0, 'user', text FROM h UNION ALL SELECT conv_id, 1, 'assistant', {_q(conversations.REPLY)} FROM h
UNION ALL SELECT conv_id, a - n + 3, role, text FROM r WHERE n > 4 AND a > n - 2""".replace("chr(10)", "chr(10)"),
)
def compaction(spark, d):
    out = conversations.compact(t.table(spark, d, "conversations"), keep=2)
    return out.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")


@query("i2_reassembly", "SELECT conv_id AS request, string_agg(coalesce(text, ''), '' ORDER BY turn) AS text FROM conversations GROUP BY 1")
def reassembly(spark, d):
    c = t.table(spark, d, "conversations").select(F.col("conv_id").alias("request"), F.col("turn").alias("seq"), F.col("text").alias("content"), F.lit(None).cast("int").alias("tool_index"), F.lit(None).cast("string").alias("tool_id"), F.lit(None).cast("string").alias("fragment"))
    return conversations.reassemble(c).select("request", "text")


# -------------------------------------------------------------------- ledger


@query("e1_sequence_ids", "SELECT event_id, printf('event-%06d', row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS seq_id FROM events")
def sequence_ids(spark, d):
    return ledger.numbered(t.table(spark, d, "events"), "event", "user_id", ["ts", "event_id"]).select("event_id", "seq_id")


@query("e5_last_rows", "SELECT event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r <= 3")
def last_rows(spark, d):
    return ledger.last_rows(t.table(spark, d, "events"), "user_id", ["event_id"], 3).select("event_id")


@query("a14_replay", "SELECT event_id FROM events WHERE event_id % 7 <> 0")
def replay(spark, d):
    v = F.when(F.col("event_id") % 7 == 0, F.substring("props", 2, 100)).otherwise(F.col("props"))
    return ledger.replay(t.table(spark, d, "events").select("event_id", v.alias("value"))).select("event_id")


@query("a15_evidence_trail", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 97 = 0)")
def evidence_trail(spark, d):
    v = F.when(F.col("event_id") % 97 == 0, F.lit("{broken")).otherwise(F.col("props"))
    return ledger.evidence_trail(t.table(spark, d, "events").select("event_id", "user_id", v.alias("value")), "user_id").select("event_id")


@query("d15_latest_status", f"SELECT session_id, tool, max_by(status, seq) AS status FROM {t.EVIDENCE} GROUP BY 1, 2")
def latest_status(spark, d):
    return ledger.latest_status(t.evidence(spark, d))


_FAILED = f"""(SELECT e.session_id, e.seq, e.id FROM {t.EVIDENCE} e WHERE e.status = 'failed' AND e.kind NOT IN ('routing', 'independent_review')
 AND NOT (e.kind = 'command' AND EXISTS (SELECT 1 FROM {t.EVIDENCE} p WHERE p.session_id = e.session_id AND p.kind = 'command' AND p.status = 'verified' AND p.exit_code = 0 AND p.command = e.command))
 AND NOT (e.kind = 'behavioral_verification' AND EXISTS (SELECT 1 FROM (SELECT session_id, tool, max_by(status, seq) AS s FROM {t.EVIDENCE} WHERE kind = 'behavioral_verification' GROUP BY 1, 2) b WHERE b.session_id = e.session_id AND b.tool = e.tool AND b.s = 'verified')))"""


@query("c10_open_failures", f"SELECT id FROM {_FAILED}")
def open_failures(spark, d):
    return ledger.open_failures(t.evidence(spark, d)).select("id")


_CRITERIA = ["Lint and type checks pass", "No security problem", "The build succeeds", "Regression test coverage", "It is nice"]


def _criteria(spark, d):
    return t.table(spark, d, "events").select(F.col("user_id").alias("session_id")).distinct().select("session_id", F.explode(F.array(*[F.lit(c) for c in _CRITERIA])).alias("criterion"), F.lit(0).alias("outside"))


_FAMILY = "CASE c WHEN 'Lint and type checks pass' THEN 'ruff check .' WHEN 'No security problem' THEN 'bandit -r src' WHEN 'The build succeeds' THEN 'cargo build' WHEN 'Regression test coverage' THEN '%test%' END"


@query("c11_matching_checks", f"SELECT e.session_id, c AS criterion, id FROM {t.EVIDENCE} e, (SELECT unnest({_CRITERIA!r}) AS c) WHERE kind = 'command' AND status = 'verified' AND exit_code = 0 AND command LIKE {_FAMILY}")
def matching_checks(spark, d):
    return ledger.matching_checks(_criteria(spark, d), t.evidence(spark, d))


@query(
    "d17_criteria",
    f"""WITH s AS (SELECT DISTINCT session_id FROM {t.EVIDENCE}), c AS (SELECT session_id, unnest({_CRITERIA!r}) AS c FROM s),
m AS (SELECT DISTINCT e.session_id, c FROM {t.EVIDENCE} e, (SELECT unnest({_CRITERIA!r}) AS c) WHERE kind = 'command' AND status = 'verified' AND exit_code = 0 AND command LIKE {_FAMILY}),
b AS (SELECT DISTINCT session_id FROM {t.EVIDENCE} WHERE kind = 'behavioral_verification' AND status = 'verified' AND tool = 'security_scan')
SELECT c.session_id, c.c AS criterion, CASE WHEN c.c = 'No security problem' THEN CASE WHEN m.c IS NOT NULL OR b.session_id IS NOT NULL THEN 'SATISFIED' ELSE 'UNVERIFIED' END
 WHEN c.c IN ('The build succeeds', 'Regression test coverage', 'Lint and type checks pass') THEN CASE WHEN m.c IS NOT NULL THEN 'SATISFIED' ELSE 'UNVERIFIED' END
 WHEN c.session_id IN (SELECT session_id FROM {_FAILED}) THEN 'UNSATISFIED' ELSE 'UNVERIFIED' END AS status
FROM c LEFT JOIN m ON m.session_id = c.session_id AND m.c = c.c LEFT JOIN b ON b.session_id = c.session_id""",
)
def criteria(spark, d):
    return ledger.evaluate_criteria(_criteria(spark, d), t.evidence(spark, d))


@query("d16_run_status", "SELECT user_id AS session_id, CASE WHEN count(*) FILTER (event_type = 'error') > 5 THEN CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN 'PARTIALLY_VERIFIED' ELSE 'FAILED' END WHEN count(*) FILTER (event_type = 'click') > 3 THEN 'VERIFIED' WHEN count(*) FILTER (event_type = 'view') > 0 THEN 'PARTIALLY_VERIFIED' ELSE 'UNVERIFIED' END AS status FROM events GROUP BY 1")
def run_status(spark, d):
    n = lambda x: F.count_if(F.col("event_type") == x)
    facts = t.table(spark, d, "events").groupBy(F.col("user_id").alias("session_id")).agg(
        F.lit("done").alias("content"), F.lit(0).alias("pending"), F.when(n("error") > 5, 1).otherwise(0).alias("failures"), F.lit(0).alias("event_failures"),
        n("view").alias("mutations"), F.lit(0).alias("checks"), F.lit(1).alias("criteria"), F.when(n("click") > 3, 1).otherwise(0).alias("satisfied"),
    )
    return ledger.run_status(facts)


@query("a19_latest_checkpoints", "SELECT user_id AS session_id, event_type AS turn_id, max_by(event_id::VARCHAR, printf('%08d', event_id)) AS label FROM events GROUP BY 1, 2")
def latest_checkpoints(spark, d):
    return ledger.latest_checkpoint(t.table(spark, d, "events").select(F.col("user_id").alias("session_id"), F.col("event_type").alias("turn_id"), F.col("event_id").cast("string").alias("label"), F.format_string("%08d", "event_id").alias("name")))


@query("a16_run_listing", "SELECT user_id AS session_id, event_type AS turn_id, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'open' END AS status, printf('%08d', max(event_id)) AS updated_at FROM events GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 50")
def run_listing(spark, d):
    e = t.table(spark, d, "events")
    turns = e.groupBy("user_id", "event_type").agg(F.max("event_id").alias("m"))
    sessions = turns.select(F.col("user_id").alias("session_id"), F.lit("/w").alias("working_dir"), F.format_string("%08d", "m").alias("updated_at"), F.array(F.struct(F.col("event_type").alias("turn_id"), F.lit("open").alias("status"), F.lit("r").alias("request"))).alias("turns"))
    states = turns.where("event_type = 'error'").select(F.col("user_id").alias("session_id"), F.col("event_type").alias("turn_id"), F.lit("FAILED").alias("status"), F.format_string("%08d", "m").alias("updated_at"))
    requests = turns.where("event_type = 'view'").select(F.col("user_id").alias("session_id"), F.col("event_type").alias("turn_id"), F.lit("q").alias("request"))
    return ledger.run_listing(sessions, requests, states, "/w").select("session_id", "turn_id", "status", "updated_at")


@query("e11_rollback_guard", "SELECT o_custkey AS session_id, o_orderkey AS turn_id, o_orderkey = max(o_orderkey) OVER (PARTITION BY o_custkey) AS allowed FROM orders")
def rollback_guard(spark, d):
    return ledger.rollback_allowed(t.table(spark, d, "orders").select(F.col("o_custkey").alias("session_id"), F.col("o_orderkey").alias("turn_id")))


@query("a57_latest_by_key", "SELECT user_id, max_by(event_type, event_id) AS event_type, max_by(value, event_id) AS value FROM events GROUP BY 1")
def latest_by_key(spark, d):
    return ledger.latest_by_key(t.table(spark, d, "events").select("user_id", "event_id", "event_type", "value"), ["user_id"], "event_id").select("user_id", "event_type", "value")


# ---------------------------------------------------------------- reflection


@query(
    "h12_reflection",
    f"""WITH a AS (SELECT *, output LIKE '❌%' AS failed, output LIKE '❌%' OR output LIKE '⚠️%' AS marked, contains(output, 'File not found') AS known FROM {t.ACTIONS})
SELECT session, seq, tool, CASE WHEN NOT marked THEN 'SUCCESS' WHEN known THEN 'RETRY' WHEN len(list_filter(win, lambda x: x.t = tool AND x.f)) >= 3 THEN 'ESCALATE' WHEN failed THEN 'RETRY' ELSE 'CONTINUE' END AS verdict
FROM (SELECT *, list(struct_pack(t := tool, f := failed)) OVER (PARTITION BY session ORDER BY seq ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS win FROM a)""",
)
def reflect(spark, d):
    return reflection.verdicts(t.actions(spark, d)).select("session", "seq", "tool", "verdict")


@query("e4_retry_counts", f"SELECT session, seq, CASE WHEN contains(output, 'File not found') THEN count(*) OVER (PARTITION BY session, tool, contains(output, 'File not found') ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) ELSE 0 END AS retry_count FROM {t.ACTIONS}")
def retry_counts(spark, d):
    return reflection.verdicts(t.actions(spark, d)).select("session", "seq", "retry_count")


@query("k1_failure_context", f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY seq DESC) AS r, output LIKE '❌%' AS f FROM {t.ACTIONS}) SELECT session, tool, count(*) AS failures FROM r WHERE r <= 10 AND f AND session IN (SELECT session FROM r WHERE r <= 5 AND f) GROUP BY 1, 2 HAVING count(*) >= 2")
def failure_context(spark, d):
    return reflection.failure_context(t.actions(spark, d))


# ----------------------------------------------------------------- streaming

_TO = "CASE event_type WHEN 'signup' THEN 'planning' WHEN 'view' THEN 'executing' WHEN 'click' THEN 'waiting_for_user' WHEN 'purchase' THEN 'completed' ELSE CASE WHEN event_id % 2 = 0 THEN 'failed' ELSE 'idle' END END"
_LEGAL = " OR ".join(f"(s.state = '{a}' AND x.to_state IN ({', '.join(map(_q, bs))}))" for a, bs in stateful.TRANSITIONS.items())


def _transitions(spark, d):
    return t.table(spark, d, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("seq"), F.expr(_TO).alias("to_state"))


@query(
    "i3_run_states",
    f"""WITH RECURSIVE x AS (SELECT user_id AS run, event_id AS seq, {_TO} AS to_state, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events),
s AS (SELECT DISTINCT run, 0::BIGINT AS seq, '' AS to_state, false AS legal, 'idle' AS state, 0::BIGINT AS r FROM x
 UNION ALL SELECT x.run, x.seq, x.to_state, ({_LEGAL}), CASE WHEN {_LEGAL} THEN x.to_state ELSE s.state END, x.r FROM s JOIN x ON x.run = s.run AND x.r = s.r + 1)
SELECT run, seq, to_state, legal, state, state IN ('completed', 'failed') AS terminal FROM s WHERE r > 0""",
)
def run_states(spark, d):
    return stateful.run_states(_transitions(spark, d))


@query("i1_event_windows", "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    return t.table(spark, d, "events").groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "event_type").agg(F.count(F.lit(1)).alias("events"))


@query("d21_file_access", "SELECT event_type AS path, count(*) AS accesses, max(ts) AS last_ts, bool_or(event_id % 5 = 0) AS edited, least(10.0::DOUBLE, count(*) + CASE WHEN bool_or(event_id % 5 = 0) THEN 3 ELSE 0 END) AS relevance FROM events GROUP BY 1")
def file_access(spark, d):
    return documents.file_accesses(t.table(spark, d, "events").select(F.col("event_type").alias("path"), "ts", (F.col("event_id") % 5 == 0).alias("edit")))


@query("d19_change_summary", "SELECT event_type AS path, CASE WHEN max_by(event_id % 2 = 0, event_id) THEN 'created' ELSE 'modified' END AS action, max(event_id) AS seq FROM events GROUP BY 1")
def change_summary(spark, d):
    return documents.change_summary(t.table(spark, d, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("path"), (F.col("event_id") % 2 == 0).alias("is_new")))


@query("e10_undo", "SELECT event_id AS seq, event_type AS path FROM events ORDER BY event_id DESC LIMIT 5")
def undo(spark, d):
    return documents.undo_set(t.table(spark, d, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("path")), 5)


@query("k29_bounded_unique", "WITH l AS (SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2) SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM l) WHERE r <= 3")
def bounded_unique(spark, d):
    return conversations.bounded_unique(t.table(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id", "event_type", 3)


@query("a2_parse_sources")
def parse_sources(spark, d):
    f = t.doc_files(spark, d).select("path", F.lit(0).cast("bigint").alias("mtime_ns"), F.octet_length("text").cast("bigint").alias("size"), F.col("text").cast("binary").alias("content"))
    return parsing.parse_files(f)


@query("f7_active_files", "SELECT doc_id::VARCHAR AS path FROM (SELECT *, coalesce(sum(length(text) // 3) OVER (ORDER BY score DESC, doc_id::VARCHAR ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM (SELECT doc_id, text, (doc_id % 10) * CASE WHEN contains(text, 'the') THEN 2 ELSE 1 END AS score FROM documents ORDER BY score DESC, doc_id::VARCHAR LIMIT 20)) WHERE used < 4000")
def active_files(spark, d):
    f = t.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), (F.col("doc_id") % 10).alias("relevance"), F.col("text").alias("content"))
    return graph.active_files(f, F.contains("content", F.lit("the")), 8000).select("path")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: documents ranked by relevance."""
    return relevant_documents(spark, sf_dir)


