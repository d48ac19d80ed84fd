"""Judging a log of tool actions(session, seq, tool, output)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import ERROR_RULES, first_rule


def verdicts(actions: DataFrame) -> DataFrame:
    """verdict, retry_count and confidence of every action: success without a
    mark, else the first known error, else an escalation after three failures
    of the tool within five actions, else by the mark."""
    o = F.coalesce("output", F.lit(""))
    failed = o.startswith("❌")
    got = actions.withColumn("failed", failed).withColumn("marked", failed | o.startswith("⚠️"))
    known = first_rule(o, ERROR_RULES, ("", ""))
    got = got.withColumn("rule", F.when(F.col("marked"), known["rule"])).withColumn("known", F.when(F.col("marked"), known["label"]))
    recent = Window.partitionBy("session").orderBy("seq").rowsBetween(-4, 0)
    got = got.withColumn("window", F.collect_list(F.struct("tool", "failed")).over(recent))
    again = F.size(F.filter("window", lambda x: (x["tool"] == F.col("tool")) & x["failed"])) >= 3
    # earlier retries of the same tool and rule
    before = Window.partitionBy("session", "tool", "rule").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    retries = F.when(F.col("rule").isNotNull() & (F.col("known") == "RETRY"), F.count(F.lit(1)).over(before)).otherwise(0)
    verdict = (
        F.when(~F.col("marked"), "SUCCESS").when(F.col("rule").isNotNull(), F.col("known")).when(again, "ESCALATE").when(F.col("failed"), "RETRY").otherwise("CONTINUE")
    )
    sure = F.when(~F.col("marked"), 0.95).when(F.col("rule").isNotNull(), 0.8).when(again, 0.9).when(F.col("failed"), 0.6).otherwise(0.7)
    return got.select("session", "seq", "tool", verdict.alias("verdict"), retries.cast("bigint").alias("retry_count"), sure.alias("confidence"))


def step_verdicts(results: DataFrame, key: str) -> DataFrame:
    """Verdict of a step from its results' ``success`` (null counts as true)."""
    bad = F.count_if(~F.coalesce("success", F.lit(True)))
    n = F.count(F.lit(1))
    s = results.groupBy(key).agg(n.alias("n"), bad.alias("bad"))
    return s.select(
        key, "n", "bad",
        F.when(F.col("bad") == 0, "SUCCESS").when(F.col("bad") == F.col("n"), "RETRY").when(F.col("bad") / F.col("n") > 0.5, "RETRY").otherwise("CONTINUE").alias("verdict"),
        F.when(F.col("bad") == 0, 0.95).when(F.col("bad") == F.col("n"), 0.9).when(F.col("bad") / F.col("n") > 0.5, 0.7).otherwise(0.6).alias("confidence"),
    )


def failure_context(actions: DataFrame) -> DataFrame:
    """(session, tool, failures) of tools that failed twice or more within a
    session's last ten actions, if one of the last five failed."""
    w = Window.partitionBy("session").orderBy(F.col("seq").desc())
    got = actions.withColumn("r", F.row_number().over(w)).where("r <= 10").withColumn("failed", F.coalesce("output", F.lit("")).startswith("❌"))
    live = got.where("r <= 5 and failed").select("session").distinct()
    return got.where("failed").groupBy("session", "tool").agg(F.count(F.lit(1)).alias("failures")).where("failures >= 2").join(live, "session", "left_semi")
