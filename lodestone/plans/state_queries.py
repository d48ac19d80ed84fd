"""Queries of the operators that keep state: stores, reach, streams.

Streams run over what there is (``availableNow``) and return what they wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import conversations, tasks
from ..session import scratch
from ..sources.store import Store
from ..streaming import processors, stateful, tail
from . import tables as t
from .queries import query

# ------------------------------------------------------------------- stores


@query(
    "a51_appended_ids",
    "SELECT user_id, event_id, 'ev-' || lpad(row_number() OVER (PARTITION BY user_id ORDER BY event_id % 3 = 0, event_id)::VARCHAR, 6, '0') AS id FROM events",
)
def appended_ids(spark, d):
    """Two appends, the second twice as after a failure: ids go on, without gaps."""
    rows, store = t.table(spark, d, "events").select("user_id", "event_id"), Store(spark, scratch(spark, "ledger"), "json")
    parts = rows.where("event_id % 3 <> 0"), rows.where("event_id % 3 = 0")
    for number, part in ((0, parts[0]), (1, parts[1]), (1, parts[1])):
        store.append_numbered(part, "ev", "user_id", ["event_id"], ("events", number))
    return store.read()


@query(
    "a58_keyed_snapshot",
    "WITH o AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 5 = 0 DESC, o_orderkey DESC) AS r FROM orders) SELECT o_custkey, o_orderkey, o_orderstatus FROM o WHERE r = 1",
)
def keyed_snapshot(spark, d):
    """The state of each customer after two rounds of changes."""
    rows, store = t.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), Store(spark, scratch(spark, "snapshot"))
    for number, part in enumerate((rows.where("o_orderkey % 5 <> 0"), rows.where("o_orderkey % 5 = 0"))):
        store.upsert(part, ["o_custkey"], order="o_orderkey", batch=("orders", number))
    return store.read()


@query("a50_replaced_table", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def replaced_table(spark, d):
    """A table made anew from itself."""
    store = Store(spark, scratch(spark, "table"))
    store.replace(t.table(spark, d, "orders").select("o_orderkey", "o_orderstatus"))
    store.replace(store.read().where("o_orderstatus <> 'F'"))
    return store.read()


# -------------------------------------------------------------------- plans

_RINGS = """(SELECT o_orderkey AS id, o_orderkey // 1000 % 4 AS k, o_orderkey % 1000 AS r,
 CASE o_orderkey // 1000 % 4 WHEN 0 THEN o_orderkey - o_orderkey % 1000 + (o_orderkey % 1000 + 1) % 1000
 WHEN 1 THEN CASE WHEN o_orderkey % 1000 < 999 THEN o_orderkey - o_orderkey % 1000 % 3 + (o_orderkey % 1000 % 3 + 1) % 3 END
 WHEN 2 THEN o_orderkey + 1 - 2 * (o_orderkey % 2) ELSE CASE WHEN o_orderkey % 1000 > 0 THEN o_orderkey - 1 END END AS a,
 CASE WHEN o_orderkey // 1000 % 4 = 3 AND o_orderkey % 1000 = 500 THEN o_orderkey - 1000 END AS b FROM orders)"""


def _rings(spark, d):
    """Orders as steps of one plan: blocks of 1,000 are by turns a ring, rings of
    three, rings of two, and a chain that has a second dependency half way."""
    k = F.col("o_orderkey")
    block, r = F.expr("o_orderkey div 1000 % 4"), k % 1000
    a = (
        F.when(block == 0, k - r + (r + 1) % 1000).when((block == 1) & (r < 999), k - r % 3 + (r % 3 + 1) % 3)
        .when(block == 2, k + 1 - 2 * (k % 2)).when((block == 3) & (r > 0), k - 1)
    )
    b = F.when((block == 3) & (r == 500), k - 1000)
    return t.table(spark, d, "orders").select(F.lit(0).alias("plan_id"), k.alias("id"), F.array_compact(F.array(a, b)).alias("depends_on"), F.lit("PENDING").alias("status"))


_HOPS = "".join(f", p{i + 1} AS (SELECT x.id, y.a FROM p{i} x JOIN p{i} y ON x.a = y.id)" for i in range(12))


@query(
    "g5_cycles",
    f"""WITH RECURSIVE s AS (SELECT id, a, b FROM {_RINGS}), p0 AS (SELECT s.id, s.a FROM s JOIN s u ON u.id = s.a){_HOPS},
e AS (SELECT id, a AS dep FROM s WHERE a IN (SELECT id FROM s) UNION SELECT id, b FROM s WHERE b IN (SELECT id FROM s)),
c AS (SELECT id FROM p12 UNION SELECT e.id FROM e JOIN c ON e.dep = c.id)
SELECT id, 'cycle' AS problem FROM c UNION ALL SELECT id, 'unknown_dependency' FROM s WHERE a NOT IN (SELECT id FROM s) OR b NOT IN (SELECT id FROM s)""",
)
def cycles(spark, d):
    return tasks.problems(_rings(spark, d)).select("id", "problem")


@query(
    "c8_blocked_transitively",
    f"""WITH RECURSIVE s AS (SELECT *, id % 7 = 0 AS bad FROM {t.ORDER_STEPS}), e AS (SELECT s.id, s.dep FROM s WHERE NOT bad AND status <> 'COMPLETED' AND dep IS NOT NULL),
x AS (SELECT id FROM s WHERE bad UNION SELECT e.id FROM e JOIN x ON e.dep = x.id)
SELECT plan_id, id, CASE WHEN bad THEN 'FAILED' WHEN status = 'COMPLETED' THEN status WHEN id IN (SELECT id FROM x) THEN 'BLOCKED' ELSE 'PENDING' END AS status FROM s""",
)
def blocked_transitively(spark, d):
    s = t.order_steps(spark, d)
    status = F.when(F.col("id") % 7 == 0, "FAILED").when(F.col("status") == "COMPLETED", "COMPLETED").otherwise("PENDING")
    return tasks.block_orphans(s.withColumn("status", status), transitive=True).select("plan_id", "id", "status")


# ------------------------------------------------------------------ streams

_ROTATION = """WITH RECURSIVE x AS (SELECT user_id AS pool, event_id AS seq, floor(epoch(ts)) AS ts, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events),
g AS (SELECT DISTINCT pool, 0::BIGINT AS seq, -1 AS k, 0 AS at, [0.0::DOUBLE, 0, 0] AS u, 0::BIGINT AS r FROM x
 UNION ALL SELECT pool, seq, k, (k + 1) % 3, [CASE WHEN bad AND k = i THEN ts + 60 ELSE u[i + 1] END for i in [0, 1, 2]], r FROM (
  SELECT x.*, g.u, CASE WHEN x.ts >= g.u[g.at + 1] THEN g.at WHEN x.ts >= g.u[(g.at + 1) % 3 + 1] THEN (g.at + 1) % 3 WHEN x.ts >= g.u[(g.at + 2) % 3 + 1] THEN (g.at + 2) % 3
  ELSE list_position(g.u, list_min(g.u)) - 1 END AS k FROM g JOIN x ON x.pool = g.pool AND x.r = g.r + 1))
SELECT pool, seq, ['a', 'b', 'c'][k + 1] AS key FROM g WHERE r > 0"""


@query("e12_key_rotation", _ROTATION)
def key_rotation(spark, d):
    r = t.table(spark, d, "events").select(F.col("user_id").alias("pool"), F.col("event_id").alias("seq"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("ts"), (F.col("event_type") == "error").alias("limited"))
    return stateful.rotate_keys(r, ["a", "b", "c"])


def _streamed(spark, d, name, build):
    """What a stream over a table's rows yields, from a Parquet folder.  The rows
    are written once, as a stream's source is a folder."""
    processors.use_state_store(spark)
    table, folder = t.table(spark, d, name), scratch(spark, f"stream-{name}")
    table.write.parquet(f"{folder}/in")
    rows = build(spark.readStream.schema(table.schema).parquet(f"{folder}/in"))
    q = rows.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


@query("i7_cooldown_stream", _ROTATION)
def cooldown_stream(spark, d):
    def build(events):
        r = events.select(F.col("user_id").alias("pool"), F.col("event_id").alias("seq"), F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"), (F.col("event_type") == "error").alias("limited"))
        return processors.rotate_keys(r, ["a", "b", "c"])

    return _streamed(spark, d, "events", build).where("event = 'used'").select("pool", "seq", "key")


_CHUNK = "conv_id AS request, turn AS seq, text AS content, CASE WHEN role = 'assistant' THEN turn % 3 END AS tool_index, CASE WHEN role = 'assistant' AND turn % 2 = 1 THEN 't' || turn END AS tool_id, upper(text) AS fragment"


def _chunks(c):
    """Turns as chunks of a reply; those of the assistant bring tool fragments."""
    said = F.col("role") == "assistant"
    return c.select(
        F.col("conv_id").alias("request"), F.col("turn").alias("seq"), F.col("text").alias("content"), F.when(said, F.col("turn") % 3).cast("int").alias("tool_index"),
        F.when(said & (F.col("turn") % 2 == 1), F.concat(F.lit("t"), F.col("turn").cast("string"))).alias("tool_id"), F.sha2("text", 256).alias("fragment"),
    )


_REPLIES = f"""WITH c AS (SELECT * REPLACE (sha256(content) AS fragment) FROM (SELECT {_CHUNK} FROM conversations)),
x AS (SELECT request, tool_index, coalesce(min_by(tool_id, seq) FILTER (tool_id IS NOT NULL), 'call_' || tool_index) AS id, string_agg(coalesce(fragment, ''), '' ORDER BY seq) AS arguments FROM c WHERE tool_index IS NOT NULL GROUP BY 1, 2)
SELECT request, tool_index::INT AS tool_index, id, arguments FROM x"""


@query("i2_tool_calls", _REPLIES)
def tool_calls(spark, d):
    got = conversations.reassemble(_chunks(t.table(spark, d, "conversations")))
    return got.select("request", F.inline("calls"))


@query("i2_reassembly_stream", _REPLIES)
def reassembly_stream(spark, d):
    """Turns dealt by hash come out of order; the last turn is marked."""
    last = t.table(spark, d, "conversations").groupBy(F.col("conv_id").alias("request")).agg(F.max("turn").alias("end"))

    def build(c):
        chunks = _chunks(c).join(last, "request").withColumn("last", F.col("seq") == F.col("end")).drop("end")
        return processors.reassemble(chunks.repartition(5, "fragment"))

    return _streamed(spark, d, "conversations", build).select("request", F.inline("calls"))


@query("i5_resumed_stream", "SELECT event_id, user_id, event_type FROM events")
def resumed_stream(spark, d):
    """Events as ledger lines that grow between two starts of one stream."""
    folder = scratch(spark, "ledgers")
    store = Store(spark, f"{folder}/table")
    lines = t.table(spark, d, "events").select("event_id", F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"))
    for part in (0, 1):
        lines.where(F.col("event_id") % 2 == part).select("value").write.mode("append").text(f"{folder}/runs")
        tail.store_stream(tail.tail(spark, f"{folder}/runs", suffix=".txt"), store, f"{folder}/checkpoint", "events", once=True).awaitTermination()
    return store.read().select(F.from_json("value", "event_id bigint, user_id bigint, event_type string").alias("x")).select("x.*")
