"""Stateful streams against the folds over whole tables; resuming."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lodestone.operators import conversations
from lodestone.sources.store import Store
from lodestone.streaming import processors, stateful, tail
from tests.conftest import SF


@pytest.fixture(scope="module", autouse=True)
def rocks(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    processors.use_state_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def drain(df, sink, checkpoint, mode="append"):
    """All that is there now, and no more; results in a Parquet folder."""
    q = df.writeStream.format("parquet").option("path", str(sink)).option("checkpointLocation", str(checkpoint)).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None


def put(spark, rows, kind, folder, name):
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("overwrite").json(str(folder / name))


REQ = "pool string, seq bigint, ts timestamp, limited boolean"


def test_rotation_equals_the_fold(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").selectExpr("concat('p', user_id % 3) pool", "event_id seq", "cast(ts as timestamp) ts", "event_type = 'error' limited")
    events.repartitionByRange(4, "seq").sortWithinPartitions("seq").write.json(str(tmp_path / "in"))
    for k, p in enumerate(sorted((tmp_path / "in").glob("part-*"))):  # files are taken oldest first
        os.utime(p, (1000 + k, 1000 + k))
    stream = spark.readStream.schema(REQ).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    drain(processors.rotate_keys(stream, ["a", "b", "c"], 3600.0), tmp_path / "out", tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out"))
    used = sorted((r.pool, r.seq, r.key) for r in got.where("event = 'used'").collect())
    whole = stateful.rotate_keys(events.withColumn("ts", F.unix_micros("ts") / 1e6), ["a", "b", "c"], 3600.0)
    assert used == sorted((r.pool, r.seq, r.key) for r in whole.collect()) and len(used) > 500
    assert got.where("event = 'free'").count() > 0


def test_cooldown_ends_without_input_for_the_pool(spark, tmp_path):
    stamp = lambda s: f"2024-01-01 00:{s // 60:02d}:{s % 60:02d}"
    rows = lambda xs: spark.createDataFrame([(p, q, stamp(s), x) for p, q, s, x in xs], "pool string, seq bigint, ts string, limited boolean").withColumn("ts", F.to_timestamp("ts"))
    read = lambda: spark.readStream.schema(REQ).option("recursiveFileLookup", True).json(str(tmp_path / "in"))

    def feed(name, xs):
        rows(xs).coalesce(1).write.json(str(tmp_path / "in" / name))
        drain(processors.rotate_keys(read(), ["a"], 60.0), tmp_path / "out", tmp_path / "cp")

    feed("1", [("quiet", 1, 0, True)])
    feed("2", [("busy", 1, 30, False)])
    free = lambda: [(r.pool, r.key) for r in spark.read.parquet(str(tmp_path / "out")).where("event = 'free'").collect()]
    assert free() == []
    feed("3", [("busy", 2, 90, False)])  # passes the end of quiet's cooldown
    assert free() == [("quiet", "a")]


CHUNK = "request string, seq bigint, content string, tool_index int, tool_id string, fragment string, last boolean"
CHUNKS = [
    ("r1", 0, "Hel", None, None, None, False), ("r1", 1, "lo", None, None, None, True),
    ("r2", 0, None, 0, "t0", '{"a"', False), ("r2", 1, None, 1, None, "{", False), ("r2", 2, None, 0, None, ": 1}", False), ("r2", 3, "ok", 1, None, "}", True),
    ("r3", 0, "never done", None, None, None, False),
]


def test_replies_out_of_order(spark, tmp_path):
    order = [CHUNKS[5], CHUNKS[1], CHUNKS[4], CHUNKS[6], CHUNKS[3], CHUNKS[0], CHUNKS[0], CHUNKS[2]]
    batch = conversations.reassemble(spark.createDataFrame(CHUNKS, CHUNK))
    want = {r.request: (r.text, r.calls) for r in batch.collect()}
    sizes = []
    for k in range(0, len(order), 2):
        put(spark, order[k : k + 2], CHUNK, tmp_path / "in", str(k))
        stream = spark.readStream.schema(CHUNK).option("recursiveFileLookup", True).json(str(tmp_path / "in"))
        drain(processors.reassemble(stream), tmp_path / "out", tmp_path / "cp")  # a new start each time
        sizes.append(spark.read.schema(f"request string, text string, calls {processors.CALLS}").parquet(str(tmp_path / "out")).count())
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sizes == [0, 0, 1, 2] and len(got) == 2
    assert {r.request: (r.text, r.calls) for r in got} == {k: v for k, v in want.items() if k != "r3"}
    assert [c.id for c in want["r2"][1]] == ["t0", "call_1"] and [c.arguments for c in want["r2"][1]] == ['{"a": 1}', "{}"]


def test_ledgers_that_grow(spark, tmp_path):
    folder, store = tmp_path / "runs", Store(spark, str(tmp_path / "table"))
    (folder / "s1").mkdir(parents=True)

    def add(name, text):
        with open(folder / name, "a", encoding="utf-8") as f:
            f.write(text)

    def run():
        q = tail.store_stream(tail.tail(spark, str(folder), splitBytes=40), store, str(tmp_path / "cp"), "ledger", once=True)
        q.awaitTermination(120)
        assert q.exception() is None
        return sorted((r.file.split("/runs/")[1], r.value) for r in store.read().collect()) if store.versions() else []

    line = lambda i: json.dumps({"id": f"event-{i:06d}", "text": "é" * (i % 40)}, ensure_ascii=False)
    want = []
    for step in range(3):
        for i in range(5):
            add("s1/events.jsonl", line(10 * step + i) + "\n")
            want.append(("s1/events.jsonl", line(10 * step + i)))
        add(f"other{step}.jsonl", line(step) + "\r\n" + ("half a li" if step == 1 else ""))
        want.append((f"other{step}.jsonl", line(step)))
        assert run() == sorted(want)
    add("other1.jsonl", "ne\n")  # the rest of a line that was not whole
    assert run() == sorted([*want, ("other1.jsonl", "half a line")])
    assert run() == sorted([*want, ("other1.jsonl", "half a line")])
    # the batch again, as after a failure between storing and checkpointing
    version, number = store.versions()[-1], tail.last_published(store, "ledger")
    assert store.append(store.read().limit(3), ("ledger", number)) == version
    log = tail.offsets(spark, str(tmp_path / "cp"))
    assert {r.file.split("/")[-1] for r in log.collect()} == {"events.jsonl", "other0.jsonl", "other1.jsonl", "other2.jsonl"}


def test_rotation_writes_its_state_once_a_batch():
    from types import SimpleNamespace

    calls, kept = [], {}
    state = SimpleNamespace(
        exists=lambda: calls.append("exists") or bool(kept), get=lambda: calls.append("get"), update=lambda v: calls.append("update"),
        iterator=lambda: iter(()), updateValue=lambda k, v: calls.append("put") or kept.update({k: v}),
    )
    p = processors.KeyRotation(["a", "b", "c"], 60.0)
    p.handle, p.turn, p.until = SimpleNamespace(registerTimer=lambda ms: calls.append("timer")), state, state
    rows = [SimpleNamespace(seq=i, at=100.0 * i, limited=True) for i in range(999)]
    assert len(list(p.handleInputRows(("p",), iter(rows), None))) == 999
    assert kept == {("a",): (99660.0,), ("b",): (99760.0,), ("c",): (99860.0,)} and len(calls) <= 10
