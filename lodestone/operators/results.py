"""Benchmark results, verification reports, token accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PASSED = ["PASSED", "VALID"]
FINE = ["VERIFIED", "PARTIALLY_VERIFIED"]


def summary(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Tasks, passed, failed, success rate (4 places, half to even), totals; an
    empty table without keys gives one row of zeros."""
    ok = F.count_if(F.col("status").isin(PASSED))
    n = F.count(F.lit(1))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return results.groupBy(*(by or [])).agg(
        n.alias("tasks"), ok.alias("passed"), (n - ok).alias("failed"),
        F.coalesce(F.bround(F.try_divide(ok, n), 4), F.lit(0.0)).alias("success_rate"),
        total("duration_ms").alias("total_duration_ms"), total("model_calls").alias("total_model_calls"),
        total("prompt_tokens").alias("total_prompt_tokens"), total("completion_tokens").alias("total_completion_tokens"),
        F.bround(F.coalesce(F.sum(F.coalesce("estimated_cost_usd", F.lit(0.0))), F.lit(0.0)), 8).alias("total_cost_usd"),
    )


def dashboard(results: DataFrame) -> DataFrame:
    """Key figures: success in percent (1 place), seconds (1 place), cost."""
    s = summary(results)
    return s.select(
        "tasks", F.bround(F.col("success_rate") * 100, 1).alias("success_percent"), F.bround(F.col("total_duration_ms") / 1000, 1).alias("seconds"),
        F.col("total_cost_usd").alias("cost_usd"),
        F.coalesce(F.try_divide(F.col("total_prompt_tokens") + F.col("total_completion_tokens"), F.col("tasks")), F.lit(0.0)).alias("tokens_per_task"),
    )


def html_rows(results: DataFrame) -> DataFrame:
    """One table row of the dashboard page per result."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    cells = [F.concat(F.lit("<td>"), esc(c), F.lit("</td>")) for c in ("task_id", "category", "status", "duration_ms", "agent_status")]
    return results.select("task_id", F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("html"))


def result_json(results: DataFrame) -> DataFrame:
    return results.select("task_id", F.to_json(F.struct(*[c for c in results.columns])).alias("json"))


def judge_task(runs: DataFrame) -> DataFrame:
    """Pass or fail with its reasons: runs(task_id, exit_code, checks, changed,
    allowed, expected, run_status); checks are booleans."""
    from .snapshots import not_changed, out_of_scope

    got = runs.withColumn("unexpected", out_of_scope(F.col("changed"), F.col("allowed"))).withColumn("missing", not_changed(F.col("expected"), F.col("changed")))
    checks = F.forall("checks", lambda c: F.coalesce(c, F.lit(False)))
    fine = F.coalesce(F.col("run_status").isin(FINE), F.lit(False))
    ok = (F.col("exit_code") == 0) & checks & (F.size("unexpected") == 0) & (F.size("missing") == 0) & fine
    show = lambda c: F.concat(F.lit("['"), F.array_join(c, "', '"), F.lit("']"))
    detail = F.concat_ws(
        "; ",
        F.when(F.col("exit_code") != 0, F.concat(F.lit("exit code "), F.col("exit_code"))),
        F.when(~checks, "one or more deterministic checks failed"),
        F.when(F.size("unexpected") > 0, F.concat(F.lit("unexpected files: "), show(F.col("unexpected")))),
        F.when(F.size("missing") > 0, F.concat(F.lit("expected files unchanged: "), show(F.col("missing")))),
        F.when(~fine, F.concat(F.lit("run status: "), F.coalesce("run_status", F.lit("missing")))),
    )
    return got.select("task_id", F.when(ok, "PASSED").otherwise("FAILED").alias("status"), detail.alias("detail"), "unexpected", "missing")


CATEGORIES = ["bug-repair", "feature", "refactor", "security", "testing", "documentation"]
MANIFEST = "schema_version string, id string, tasks array<struct<id:string,category:string,prompt:string,verification:array<array<string>>,timeout_seconds:int>>"


def manifest_problems(manifests: DataFrame, text_col: str = "text", version: str | None = None, categories: list[str] = CATEGORIES) -> DataFrame:
    """(task_id, problem) of benchmark manifests in JSON; unreadable ones give
    one row without a task."""
    m = manifests.select(F.from_json(text_col, MANIFEST).alias("m"), F.try_parse_json(text_col).alias("v"))
    bad = m.where("v is null").select(F.lit(None).cast("string").alias("task_id"), F.lit("not_json").alias("problem"))
    if version:
        wrong = m.where(F.col("v").isNotNull() & ~F.col("m.schema_version").eqNullSafe(version))
        bad = bad.unionByName(wrong.select(F.lit(None).cast("string").alias("task_id"), F.lit("schema_version").alias("problem")))
    t = m.where("v is not null").select(F.explode("m.tasks").alias("t")).select("t.*")
    checks = F.array(
        F.when(F.coalesce("id", F.lit("")) == "", "no_id"), F.when(~F.coalesce(F.col("category").isin(categories), F.lit(False)), "category"),
        F.when(F.exists(F.coalesce("verification", F.array().cast("array<array<string>>")), lambda a: F.size(a) == 0), "empty_command"),
    )
    each = t.select(F.col("id").alias("task_id"), F.explode(F.filter(checks, lambda x: x.isNotNull())).alias("problem"))
    twice = t.groupBy("id").count().where("count > 1").select(F.col("id").alias("task_id"), F.lit("duplicate_id").alias("problem"))
    return bad.unionByName(each).unionByName(twice)


def dry_run(tasks: DataFrame, repositories: DataFrame) -> DataFrame:
    """VALID if a task's repository exists, else BLOCKED."""
    have = repositories.select("repository").distinct().withColumn("__ok", F.lit(True))
    return tasks.join(have, "repository", "left").withColumn("status", F.when(F.col("__ok"), "VALID").otherwise("BLOCKED")).drop("__ok")


def verification_report(checks: DataFrame, key: str) -> DataFrame:
    """Per key: passed, total, and whether there were checks and all passed."""
    return checks.groupBy(key).agg(
        F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"), F.bool_and(F.coalesce("passed", F.lit(False))).alias("all_passed")
    )


def output_counts(text: Column) -> Column:
    """struct(errors, warnings): how often the words stand in an output."""
    low = F.lower(text)
    return F.struct(F.regexp_count(low, F.lit("error")).alias("errors"), F.regexp_count(low, F.lit("warning")).alias("warnings"))


def usage(calls: DataFrame, by: str, input_price: float | None, output_price: float | None) -> DataFrame:
    """Calls, tokens and cost per key; negative counts are 0, and the cost is 0
    unless both prices (per million) are known."""
    n = lambda c: F.coalesce(F.sum(F.greatest(F.lit(0), F.coalesce(c, F.lit(0)))), F.lit(0)).cast("bigint")
    p, c = n("prompt_tokens"), n("completion_tokens")
    cost = F.lit(0.0) if input_price is None or output_price is None else (p * F.lit(float(input_price)) + c * F.lit(float(output_price))) / 1_000_000
    return calls.groupBy(by).agg(F.count(F.lit(1)).alias("calls"), p.alias("prompt_tokens"), c.alias("completion_tokens"), cost.alias("cost_usd"))


def running_usage(calls: DataFrame, key: str, order: list[str], limits: dict[str, float | None]) -> DataFrame:
    """Running totals and, per call, whether a ceiling was passed after it
    (strictly; a limit of None is no limit)."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    got = calls.withColumn("used_prompt", F.sum(F.greatest(F.lit(0), F.coalesce("prompt_tokens", F.lit(0)))).over(w)).withColumn(
        "used_completion", F.sum(F.greatest(F.lit(0), F.coalesce("completion_tokens", F.lit(0)))).over(w)
    )
    over = F.lit(False)
    for c, limit in limits.items():
        if limit is not None:
            over = over | (F.col(c) > limit)
    return got.withColumn("over", over)


def budget_gate(calls: DataFrame, key: str, order: str, max_calls: int | None, max_prompt: int | None) -> DataFrame:
    """(key, order, accepted): a call is accepted while calls and prompt tokens
    stay within limits; a rejected call adds nothing to either.  An exact fold
    over each key's calls in order."""
    inf = 1 << 62
    state = F.struct(F.lit(0).cast("bigint").alias("calls"), F.lit(0).cast("bigint").alias("used"), F.array().cast(f"array<struct<{order}:bigint,accepted:boolean>>").alias("out"))

    def step(s, c):
        ok = (s["calls"] < (max_calls if max_calls is not None else inf)) & (s["used"] + c["p"] <= (max_prompt if max_prompt is not None else inf))
        return F.struct(
            (s["calls"] + ok.cast("bigint")).alias("calls"), (s["used"] + F.when(ok, c["p"]).otherwise(F.lit(0))).cast("bigint").alias("used"),
            F.concat(s["out"], F.array(F.struct(c["o"].alias(order), ok.alias("accepted")))).alias("out"),
        )

    each = calls.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(order).cast("bigint").alias("o"), F.greatest(F.lit(0), F.coalesce("prompt_tokens", F.lit(0))).cast("bigint").alias("p")))).alias("c")
    )
    return each.select(key, F.explode(F.aggregate("c", state, step)["out"]).alias("x")).select(key, "x.*")
