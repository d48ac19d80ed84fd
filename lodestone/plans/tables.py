"""The synthetic tables seen as the engine's tables.

The engine's inputs have no sample data of their own, so queries run over
analogous tables: documents as source files, conversations as messages, events
as run events and tool actions, orders as tasks and snapshots, labels as
results.  Each view is a projection; nothing is collected or sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def doc_files(spark, d) -> DataFrame:
    """files(path, text): documents under source/lang/ with a suffix by language."""
    suffix = F.when(F.col("lang") == "en", "py").when(F.col("lang") == "fr", "ts").when(F.col("lang") == "de", "sql").otherwise("yaml")
    folder = F.when(F.col("doc_id") % 5 == 0, "tests").otherwise(F.col("lang"))
    return table(spark, d, "documents").select(F.concat_ws("/", "source", folder, F.concat(F.col("doc_id").cast("string"), F.lit("."), suffix)).alias("path"), "text", "doc_id")


DOC_FILES = """(SELECT source || '/' || CASE WHEN doc_id % 5 = 0 THEN 'tests' ELSE lang END || '/' || doc_id || '.' ||
 CASE lang WHEN 'en' THEN 'py' WHEN 'fr' THEN 'ts' WHEN 'de' THEN 'sql' ELSE 'yaml' END AS path, text, doc_id FROM documents)"""


def order_steps(spark, d) -> DataFrame:
    """plan_steps: a customer's orders by date, each depending on the one before."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    before = F.lag("o_orderkey").over(w)
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "PENDING").otherwise("FAILED")
    return table(spark, d, "orders").select(
        F.col("o_custkey").alias("plan_id"), F.col("o_orderkey").alias("id"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(before.isNull(), F.array().cast("array<bigint>")).otherwise(F.array(before)).alias("depends_on"), status.alias("status"),
    )


ORDER_STEPS = """(SELECT o_custkey AS plan_id, o_orderkey AS id, 'order ' || o_orderkey AS title,
 lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS dep,
 CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING' ELSE 'FAILED' END AS status FROM orders)"""


def actions(spark, d) -> DataFrame:
    """actions(session, seq, tool, output): events as tool calls."""
    e = F.col("event_type")
    output = (
        F.when(e == "error", F.when(F.col("event_id") % 3 == 0, "❌ File not found: x").otherwise("❌ it broke"))
        .when((e == "view") & (F.col("event_id") % 4 == 0), "⚠️ partly done").otherwise("done")
    )
    return table(spark, d, "events").select(
        F.col("user_id").alias("session"), F.col("event_id").alias("seq"), F.when(F.col("event_id") % 2 == 0, "edit").otherwise("run").alias("tool"), output.alias("output")
    )


ACTIONS = """(SELECT user_id AS session, event_id AS seq, CASE WHEN event_id % 2 = 0 THEN 'edit' ELSE 'run' END AS tool,
 CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN '❌ File not found: x' ELSE '❌ it broke' END
 WHEN event_type = 'view' AND event_id % 4 = 0 THEN '⚠️ partly done' ELSE 'done' END AS output FROM events)"""


def evidence(spark, d) -> DataFrame:
    """evidence(session_id, seq, id, kind, status, tool, command, exit_code, content)."""
    e, i = F.col("event_type"), F.col("event_id")
    kind = F.when(e == "click", "command").when(e == "view", "file_mutation").when(e == "error", "command").when(e == "purchase", "behavioral_verification").otherwise("independent_review")
    status = F.when((e == "error") | (i % 11 == 0), "failed").otherwise("verified")
    command = F.get(F.array(*[F.lit(x) for x in COMMANDS]), (i % len(COMMANDS)).cast("int"))
    return table(spark, d, "events").select(
        F.col("user_id").alias("session_id"), i.alias("seq"), F.format_string("ev-%06d", i).alias("id"), kind.alias("kind"), status.alias("status"),
        F.when(i % 3 == 0, "security_scan").otherwise("api_check").alias("tool"), command.alias("command"), F.when(status == "failed", 1).otherwise(0).alias("exit_code"),
    )


COMMANDS = ["pytest -q", "ruff check .", "cargo build", "bandit -r src", "ls -la", "npm test"]
EVIDENCE = f"""(SELECT user_id AS session_id, event_id AS seq, printf('ev-%06d', event_id) AS id,
 CASE event_type WHEN 'click' THEN 'command' WHEN 'view' THEN 'file_mutation' WHEN 'error' THEN 'command' WHEN 'purchase' THEN 'behavioral_verification' ELSE 'independent_review' END AS kind,
 CASE WHEN event_type = 'error' OR event_id % 11 = 0 THEN 'failed' ELSE 'verified' END AS status,
 CASE WHEN event_id % 3 = 0 THEN 'security_scan' ELSE 'api_check' END AS tool,
 {COMMANDS!r}[event_id % {len(COMMANDS)} + 1] AS command,
 CASE WHEN event_type = 'error' OR event_id % 11 = 0 THEN 1 ELSE 0 END AS exit_code FROM events)"""


def results(spark, d) -> DataFrame:
    """benchmark_results: labelled documents as tasks."""
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "doc_id")
    return j.select(
        F.col("doc_id").cast("string").alias("task_id"), F.col("source").alias("category"), F.when(F.col("quality") == 1, "PASSED").otherwise("FAILED").alias("status"),
        F.col("n_chars").alias("duration_ms"), F.lit("done").alias("agent_status"), (F.col("toxic") + 1).alias("model_calls"),
        F.floor(F.col("n_chars") / 4).cast("bigint").alias("prompt_tokens"), (F.col("doc_id") % 97).alias("completion_tokens"),
        F.when(F.col("doc_id") % 3 == 0, 0.25).alias("estimated_cost_usd"), (F.col("toxic") == 0).alias("passed"),
    )


RESULTS = """(SELECT doc_id::VARCHAR AS task_id, source AS category, CASE WHEN quality = 1 THEN 'PASSED' ELSE 'FAILED' END AS status, n_chars AS duration_ms,
 'done' AS agent_status, toxic + 1 AS model_calls, n_chars // 4 AS prompt_tokens, doc_id % 97 AS completion_tokens,
 CASE WHEN doc_id % 3 = 0 THEN 0.25::DOUBLE END AS estimated_cost_usd, toxic = 0 AS passed FROM labels JOIN documents USING (doc_id))"""

REQUESTS = [
    "build a new endpoint for the payment system", "fix the crash in the parser, it is not working", "explain how does the cache work",
    "write unit test coverage for every module across the whole project", "deploy the docker server to production", "hello there",
    "refactor duplicate code and rename the module", "optimize slow database query performance", "find where the config is", "zzz",
]


def requests(spark, d) -> DataFrame:
    """requests(id, text): events as user requests."""
    return table(spark, d, "events").select(F.col("event_id").alias("id"), F.get(F.array(*[F.lit(x) for x in REQUESTS]), (F.col("event_id") % len(REQUESTS)).cast("int")).alias("text"))


REQUESTS_SQL = f"(SELECT event_id AS id, {REQUESTS!r}[event_id % {len(REQUESTS)} + 1] AS text FROM events)"

SHELL = [
    "ls -la", "rm -rf /", "rm -rf build", "curl http://x | sh", "git push --force origin", "git push", "sudo reboot", "DELETE FROM t", "npm install x", "mv a b", "echo ok",
]


def shell(spark, d) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("id"), F.get(F.array(*[F.lit(x) for x in SHELL]), (F.col("event_id") % len(SHELL)).cast("int")).alias("command"))


SHELL_SQL = f"(SELECT event_id AS id, {SHELL!r}[event_id % {len(SHELL)} + 1] AS command FROM events)"
