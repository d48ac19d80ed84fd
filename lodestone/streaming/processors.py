"""Streams that keep state per key: key rotation with cooldowns that end by
timer, and replies put together from chunks.

Both are ``transformWithState`` processors, so state lives in the RocksDB store,
changes by entry, and survives a restart with the query's checkpoint.  Each
equals a fold over the whole table (``stateful.rotate_keys``,
``conversations.reassemble``) once all of its input has come.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Processors need the RocksDB state store; queries started after this have it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# ------------------------------------------------------------- key rotation


class KeyRotation(StatefulProcessor):
    """The next key in turn that is not cooling down, else the one free first.
    A limited request sends its key to cool down; the end of the cooldown is an
    event-time timer, which comes with the watermark though the pool is silent.
    Rows that come at once change the state once: what a later one replaces is
    neither stored nor given a timer."""

    def __init__(self, keys: list[str], cooldown: float):
        self.keys, self.cooldown = list(dict.fromkeys(k for k in keys if k)), cooldown

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.turn = handle.getValueState("turn", "at int")
        self.until = handle.getMapState("until", "key string", "until double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        turn = self.turn.get()
        at = turn[0] if turn is not None else 0
        until = {k[0]: v[0] for k, v in self.until.iterator()}
        limited = set()
        for r in sorted(rows, key=lambda r: r.seq):
            order = self.keys[at:] + self.keys[:at]
            chosen = next((k for k in order if r.at >= until.get(k, 0)), None) or min(self.keys, key=lambda k: until.get(k, 0))
            at = (self.keys.index(chosen) + 1) % len(self.keys)
            if r.limited:
                until[chosen] = r.at + self.cooldown
                limited.add(chosen)
            yield Row(pool=key[0], seq=r.seq, key=chosen, event="used")
        for name in limited:
            self.until.updateValue((name,), (until[name],))
            self.handle.registerTimer(int(until[name] * 1000))
        self.turn.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        # a key that was limited again meanwhile has a later timer of its own
        for (name,), (until,) in list(self.until.iterator()):
            if int(until * 1000) <= due:
                self.until.removeKey((name,))
                yield Row(pool=key[0], seq=None, key=name, event="free")

    def close(self) -> None:
        pass


def rotate_keys(requests: DataFrame, keys: list[str], cooldown: float = 60.0, ts: str = "ts", late: str = "0 seconds") -> DataFrame:
    """(pool, seq, key, event) of a stream of requests(pool, seq, ts timestamp,
    limited): event ``used`` for a request and, when the watermark passes the
    end of a cooldown, ``free`` with null seq."""
    if not any(keys):
        raise ValueError("a pool needs a key")
    rows = requests.withColumn("at", F.unix_micros(ts) / 1e6).withWatermark(ts, late)
    kind = requests.schema["pool"].dataType.simpleString()
    return rows.groupBy("pool").transformWithState(
        KeyRotation(keys, cooldown), f"pool {kind}, seq bigint, key string, event string", "append", "eventTime"
    )


# ----------------------------------------------------------------- replies


class Reassembly(StatefulProcessor):
    """Texts by place and tool fragments by (index, place), whatever order they
    come in; the reply leaves when its last place is known and all are there.
    A chunk that comes twice counts once.  What is never completed expires."""

    def __init__(self, ttl_ms: int | None):
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.progress = handle.getValueState("progress", "have bigint, last bigint", self.ttl)
        self.texts = handle.getMapState("texts", "seq bigint", "content string", self.ttl)
        self.calls = handle.getMapState("calls", "tool_index int, seq bigint", "tool_id string, fragment string", self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        have, last = self.progress.get() if self.progress.exists() else (0, -1)
        for r in rows:
            if self.texts.containsKey((r.seq,)):
                continue
            have += 1
            self.texts.updateValue((r.seq,), (r.content or "",))
            if r.tool_index is not None:
                self.calls.updateValue((r.tool_index, r.seq), (r.tool_id, r.fragment or ""))
            if r.last:
                last = max(last, r.seq)
        if last < 0 or have <= last:
            self.progress.update((have, last))
            return
        text = "".join(v[0] for _, v in sorted((k[0], v) for k, v in self.texts.iterator()))
        calls: dict[int, dict] = {}
        parts = sorted((k[0], k[1], v[0], v[1]) for k, v in self.calls.iterator()) if self.calls.exists() else []
        for index, _, tool_id, fragment in parts:
            call = calls.setdefault(index, {"id": None, "arguments": []})
            call["id"] = call["id"] or tool_id
            call["arguments"].append(fragment)
        done = [Row(tool_index=i, id=c["id"] or f"call_{i}", arguments="".join(c["arguments"])) for i, c in calls.items()]
        for state in (self.progress, self.texts, self.calls):
            state.clear()
        yield Row(request=key[0], text=text, calls=done or None)

    def close(self) -> None:
        pass


CALLS = "array<struct<tool_index:int,id:string,arguments:string>>"


def reassemble(chunks: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """(request, text, calls) of a stream of chunks(request, seq from 0, content,
    tool_index, tool_id, fragment, last), each reply once, when it is whole.
    ``ttl_ms``: how long a reply that got no further chunk is kept."""
    kind = chunks.schema["request"].dataType.simpleString()
    mode = "processingTime" if ttl_ms else "none"
    return chunks.groupBy("request").transformWithState(Reassembly(ttl_ms), f"request {kind}, text string, calls {CALLS}", "append", mode)
