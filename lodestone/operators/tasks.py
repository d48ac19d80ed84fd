"""Plans: progress, readiness, blocking and validity of task graphs.

plan_steps(plan_id, id, depends_on, status, ...); see ``schemas``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .reach import leads_to

DONE = ["COMPLETED", "SKIPPED"]
STUCK = ["FAILED", "BLOCKED"]


def _edges(steps: DataFrame) -> DataFrame:
    return steps.select("plan_id", "id", F.explode("depends_on").alias("dep"))


def _status(steps: DataFrame) -> DataFrame:
    return steps.select("plan_id", F.col("id").alias("dep"), F.col("status").alias("dep_status"))


def ready(steps: DataFrame) -> DataFrame:
    """Pending steps all of whose dependencies are done (unknown ones are not)."""
    unmet = _edges(steps).join(_status(steps), ["plan_id", "dep"], "left").where(~F.coalesce(F.col("dep_status").isin(DONE), F.lit(False)))
    return steps.where(F.col("status") == "PENDING").join(unmet.select("plan_id", "id").distinct(), ["plan_id", "id"], "left_anti")


def next_step(steps: DataFrame) -> DataFrame:
    """(plan_id, id) of each plan's first ready step."""
    return ready(steps).groupBy("plan_id").agg(F.min("id").alias("id"))


def block_orphans(steps: DataFrame, transitive: bool = False) -> DataFrame:
    """Pending steps behind failed or blocked ones become BLOCKED: one pass over
    the statuses as they are, or through any number of pending steps."""
    pending = F.col("status") == "PENDING"
    if transitive:
        node = F.struct("plan_id", "id").alias("node")
        edges = steps.where(pending).select(node, F.explode("depends_on").alias("dep"), "plan_id").select("node", F.struct("plan_id", F.col("dep").alias("id")).alias("to"))
        behind = leads_to(edges, steps.where(F.col("status").isin(STUCK)).select(node)).select("node.*")
    else:
        behind = _edges(steps).join(_status(steps).where(F.col("dep_status").isin(STUCK)), ["plan_id", "dep"]).select("plan_id", "id").distinct()
    got = steps.join(behind.withColumn("__bad", F.lit(True)), ["plan_id", "id"], "left")
    return got.withColumn("status", F.when(pending & F.col("__bad"), "BLOCKED").otherwise(F.col("status"))).select(steps.columns)


def progress(steps: DataFrame) -> DataFrame:
    """Per plan: steps, completed, percentage, whether complete or with failures."""
    done = F.count_if(F.col("status") == "COMPLETED")
    return steps.groupBy("plan_id").agg(
        F.count(F.lit(1)).alias("steps"), done.alias("completed"), (100.0 * done / F.count(F.lit(1))).alias("progress"),
        F.bool_and(F.col("status").isin(DONE)).alias("is_complete"), F.bool_or(F.col("status") == "FAILED").alias("has_failures"),
    )


def recent_plans(plans: DataFrame, steps: DataFrame, limit: int = 10) -> DataFrame:
    """The latest plans by id with their completed and total steps."""
    top = plans.orderBy(F.col("plan_id").desc()).limit(max(1, limit))
    return top.join(progress(steps).select("plan_id", "steps", "completed"), "plan_id", "left").na.fill(0, ["steps", "completed"])


def problems(steps: DataFrame) -> DataFrame:
    """(plan_id, id, problem): duplicate ids, unknown dependencies, steps that
    depend on themselves, steps on or behind a dependency cycle."""
    twice = steps.groupBy("plan_id", "id").count().where("count > 1").select("plan_id", "id", F.lit("duplicate").alias("problem"))
    e = _edges(steps).distinct()
    known = steps.select("plan_id", F.col("id").alias("dep")).distinct()
    unknown = e.join(known, ["plan_id", "dep"], "left_anti").select("plan_id", "id", F.lit("unknown_dependency").alias("problem")).distinct()
    itself = e.where("id = dep").select("plan_id", "id", F.lit("self_dependency").alias("problem"))
    node = lambda c: F.struct("plan_id", F.col(c).alias("id"))
    edges = e.join(known, ["plan_id", "dep"], "left_semi").select(node("id").alias("node"), node("dep").alias("to"))
    cycle = leads_to(edges, edges.select("node").limit(0), cycles=True).select("node.*", F.lit("cycle").alias("problem"))
    return twice.unionByName(unknown).unionByName(itself).unionByName(cycle)


def advance(steps: DataFrame, updates: DataFrame) -> DataFrame:
    """Steps after status updates(plan_id, id, seq, status, result): the last
    status wins, each IN_PROGRESS is an attempt, a FAILED result is the error."""
    u = updates.groupBy("plan_id", "id").agg(
        F.max_by("status", "seq").alias("__s"), F.count_if(F.col("status") == "IN_PROGRESS").alias("__a"),
        F.max_by("result", "seq").alias("__r"),
    )
    got = steps.join(u, ["plan_id", "id"], "left")
    failed = F.col("__s") == "FAILED"
    return (
        got.withColumn("status", F.coalesce("__s", "status"))
        .withColumn("attempts", (F.coalesce("attempts", F.lit(0)) + F.coalesce("__a", F.lit(0))).cast("int"))
        .withColumn("error", F.when(failed, F.col("__r")).otherwise(F.col("error")))
        .withColumn("result", F.when(F.col("__r").isNotNull() & ~failed, F.col("__r")).otherwise(F.col("result")))
        .select(steps.columns)
    )


def context(steps: DataFrame) -> DataFrame:
    """Per plan: progress, the next step's title and the pending titles."""
    pend = steps.where(F.col("status") == "PENDING").groupBy("plan_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", "title"))), lambda x: x["title"]), ", ").alias("pending")
    )
    nxt = next_step(steps).join(steps.select("plan_id", "id", "title"), ["plan_id", "id"]).select("plan_id", F.col("title").alias("next"))
    return progress(steps).select("plan_id", "progress").join(nxt, "plan_id", "left").join(pend, "plan_id", "left")


def reset_for_resume(steps: DataFrame) -> DataFrame:
    """Interrupted steps are pending again; finished ones stay."""
    return steps.withColumn("status", F.when(F.col("status").isin("IN_PROGRESS", "BLOCKED"), "PENDING").otherwise(F.col("status")))


def schedule_stats(events: DataFrame) -> DataFrame:
    """Attempts, repairs and seconds per task from a scheduler's event log
    (plan_id, id, ts, kind)."""
    w = Window.partitionBy("plan_id", "id")
    start = F.min(F.when(F.col("kind") == "started", F.col("ts"))).over(w)
    return events.withColumn("s", start).groupBy("plan_id", "id").agg(
        F.count_if(F.col("kind") == "started").alias("attempts"), F.count_if(F.col("kind") == "repair").alias("repairs"),
        (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("s").cast("timestamp"))).alias("micros"),
    )
