"""Conversations(conv_id, turn, role, text): listing, preview, compaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text

HEAD = "[CONVERSATION SUMMARY — Earlier messages have been compacted]\n\n"
TAIL = "\n\n[END SUMMARY — Recent messages follow]"
REPLY = "Understood. I have the context from our earlier conversation. Let's continue."


def previews(messages: DataFrame, most: int = 80) -> DataFrame:
    """(conv_id, preview): the first user message that has text, cut short."""
    ok = (F.col("role") == "user") & (F.coalesce("text", F.lit("")) != "")
    first = messages.groupBy("conv_id").agg(F.min_by("text", F.when(ok, F.col("turn"))).alias("t"), F.bool_or(ok).alias("any"))
    t = text.strip(F.col("t"))
    cut = F.when(F.length(t) > most, F.concat(F.substring(t, 1, most), F.lit("..."))).otherwise(t)
    return first.select("conv_id", F.when(F.col("any"), cut).otherwise("(empty conversation)").alias("preview"))


def listing(messages: DataFrame, limit: int = 20) -> DataFrame:
    """The latest conversations by id with their size and preview."""
    n = messages.groupBy("conv_id").agg(F.count(F.lit(1)).alias("messages")).orderBy(F.col("conv_id").desc()).limit(max(1, limit))
    return n.join(previews(messages.join(n.select("conv_id"), "conv_id", "left_semi")), "conv_id").orderBy(F.col("conv_id").desc())


def find(messages: DataFrame, conv_id: str) -> DataFrame:
    """Messages of a conversation by exact id, else by a part that only one id
    has; none if several do."""
    ids = messages.select(F.col("conv_id").cast("string").alias("c")).distinct()
    exact = ids.where(F.col("c") == conv_id)
    part = ids.where(F.contains("c", F.lit(conv_id))).agg(F.collect_set("c").alias("s")).where(F.size("s") == 1).select(F.get("s", F.lit(0)).alias("c"))
    pick = exact.unionByName(part.join(exact.select(F.lit(1).alias("x")), F.lit(True), "left_anti"))
    return messages.join(pick, messages["conv_id"].cast("string") == pick["c"], "left_semi")


def saveable(messages: DataFrame, least: int = 2) -> DataFrame:
    """Messages of conversations long enough to keep."""
    n = messages.groupBy("conv_id").count().where(F.col("count") >= least)
    return messages.join(n.select("conv_id"), "conv_id", "left_semi")


def compact(messages: DataFrame, keep: int = 10, parts: int = 20) -> DataFrame:
    """(conv_id, turn, role, text): conversations of more than keep + 2 messages
    become a summary, a reply, and their last ``keep`` messages; turns are
    numbered anew from 0.  Others stay as they are."""
    w = Window.partitionBy("conv_id")
    at = F.row_number().over(w.orderBy("turn"))
    rows = messages.withColumn("at", at).withColumn("n", F.count(F.lit(1)).over(w))
    short = rows.where(F.col("n") <= keep + 2).select("conv_id", (F.col("at") - 1).alias("turn"), "role", "text")
    long = rows.where(F.col("n") > keep + 2)
    t = F.coalesce("text", F.lit(""))
    part = (
        F.when((F.col("role") == "user") & (t != ""), F.concat(F.lit("User asked: "), F.substring(t, 1, 200)))
        .when((F.col("role") == "assistant") & (t != ""), F.concat(F.lit("Assistant: "), F.substring(t, 1, 200)))
        .when(F.col("role") == "tool", F.concat(F.lit("Tool result for : "), F.substring(t, 1, 100)))
    )
    old = long.where(F.col("at") <= F.col("n") - keep).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(part.isNotNull(), F.struct("at", part.alias("p"))))).alias("ps")
    )
    size = F.size("ps")
    kept = F.transform(F.slice("ps", F.greatest(size - parts + 1, F.lit(1)), F.lit(parts)), lambda x: x["p"])
    head = old.select("conv_id", F.lit(0).alias("turn"), F.lit("user").alias("role"), F.concat(F.lit(HEAD), F.array_join(kept, "\n"), F.lit(TAIL)).alias("text"))
    reply = old.select("conv_id", F.lit(1).alias("turn"), F.lit("assistant").alias("role"), F.lit(REPLY).alias("text"))
    recent = long.where(F.col("at") > F.col("n") - keep).select("conv_id", (F.col("at") - F.col("n") + keep + 1).alias("turn"), "role", "text")
    return short.unionByName(head).unionByName(reply).unionByName(recent)


def reassemble(chunks: DataFrame) -> DataFrame:
    """(request, text, calls) from stream chunks(request, seq, content,
    tool_index, tool_id, fragment): texts in order, tool fragments by index;
    calls without an id get one from their index."""
    text = chunks.groupBy("request").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", F.coalesce("content", F.lit("")).alias("c")))), lambda x: x["c"]), "").alias("text")
    )
    calls = chunks.where(F.col("tool_index").isNotNull()).groupBy("request", "tool_index").agg(
        F.coalesce(F.min_by("tool_id", F.when(F.col("tool_id").isNotNull(), F.col("seq"))), F.concat(F.lit("call_"), F.col("tool_index").cast("string"))).alias("id"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", F.coalesce("fragment", F.lit("")).alias("f")))), lambda x: x["f"]), "").alias("arguments"),
    )
    calls = calls.groupBy("request").agg(F.sort_array(F.collect_list(F.struct("tool_index", "id", "arguments"))).alias("calls"))
    return text.join(calls, "request", "left")


def bounded_unique(items: DataFrame, key: str, order: str, value: str, n: int) -> DataFrame:
    """The last n items of a key, each value once at its last place."""
    last = items.groupBy(key, value).agg(F.max(order).alias(order))
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return last.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).drop("r")
