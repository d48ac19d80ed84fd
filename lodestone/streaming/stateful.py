"""Streams: run events, the run state machine, budget gate, key rotation.

Folds over ordered events exist twice: as an exact fold over each key's ordered
rows for tables, and as ``applyInPandasWithState`` for streams.  Both share one
step function.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# fixed values: states of a run and where each may go
TRANSITIONS = {
    "idle": ["planning", "executing", "failed"],
    "planning": ["executing", "failed"],
    "executing": ["waiting_for_user", "completed", "failed"],
    "waiting_for_user": ["executing", "completed", "failed"],
    "completed": ["idle"],
    "failed": ["idle"],
}
TERMINAL = ["completed", "failed"]
EVENTS = "request string, seq bigint, kind string, content string, tool_index int, tool_id string, fragment string"


def event_stream(spark: SparkSession, path: str, schema: str = EVENTS, max_files: int = 100) -> DataFrame:
    """Run events from a folder of JSON files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def fan_out(stream: DataFrame, handlers: list, checkpoint: str, once: bool = False, failed: Callable[[object, int, Exception], None] | None = None):
    """Each micro-batch to every handler; one that fails does not stop others.
    ``failed`` gets handler, batch number and exception; without one the failure
    is logged.  What it raises stops the stream, and the batch comes again."""

    def logged(handler, number: int, error: Exception) -> None:
        name = getattr(handler, "__name__", handler)
        logging.getLogger(__name__).error("handler %s failed on batch %s", name, number, exc_info=error)

    def each(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for h in handlers:
                try:
                    h(batch, number)
                except Exception as e:  # noqa: BLE001
                    (failed or logged)(h, number, e)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def counts_by_window(stream: DataFrame, ts: str, kind: str, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events per time window and kind, late ones within the watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("events")).select(
        F.col("w.start").alias("window_start"), kind, "events"
    )


# ------------------------------------------------------------ state machine


def run_states(transitions: DataFrame, key: str = "run") -> DataFrame:
    """(key, seq, to_state, legal, state, terminal) of transitions(key, seq,
    to_state): an illegal one leaves the state as it is.  An exact fold in the
    JVM over each key's ordered rows."""
    table = F.create_map(*[x for a, bs in TRANSITIONS.items() for x in (F.lit(a), F.array(*[F.lit(b) for b in bs]))])
    zero = F.struct(F.lit("idle").alias("state"), F.array().cast("array<struct<seq:bigint,to_state:string,legal:boolean,state:string>>").alias("out"))

    def step(s, x):
        ok = F.coalesce(F.array_contains(F.try_element_at(table, s["state"]), x["to_state"]), F.lit(False))
        now = F.when(ok, x["to_state"]).otherwise(s["state"])
        row = F.struct(x["seq"].alias("seq"), x["to_state"].alias("to_state"), ok.alias("legal"), now.alias("state"))
        return F.struct(now.alias("state"), F.concat(s["out"], F.array(row)).alias("out"))

    each = transitions.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("seq").cast("bigint").alias("seq"), "to_state"))).alias("t"))
    return each.select(key, F.explode(F.aggregate("t", zero, step)["out"]).alias("x")).select(key, "x.*", F.col("x.state").isin(TERMINAL).alias("terminal"))


def run_states_stream(transitions: DataFrame, key: str = "run") -> DataFrame:
    """The same on a stream, the state kept between micro-batches."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get[0] if state.exists else "idle"
        rows = []
        for f in frames:
            for seq, to in sorted(zip(f["seq"], f["to_state"])):
                ok = to in TRANSITIONS.get(now, [])
                now = to if ok else now
                rows.append((k[0], seq, to, ok, now))
        state.update((now,))
        yield pd.DataFrame(rows, columns=[key, "seq", "to_state", "legal", "state"])

    kind = transitions.schema[key].dataType.simpleString()
    return transitions.groupBy(key).applyInPandasWithState(
        step, f"{key} {kind}, seq bigint, to_state string, legal boolean, state string", "state string", "append", GroupStateTimeout.NoTimeout
    )


# ------------------------------------------------------------------- budget


def budget_gate_stream(calls: DataFrame, key: str, max_calls: int | None, max_prompt: int | None) -> DataFrame:
    """(key, seq, accepted) of a stream of calls(key, seq, prompt_tokens); a
    rejected call adds nothing."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, used = state.get if state.exists else (0, 0)
        rows = []
        for f in frames:
            for seq, tokens in sorted(zip(f["seq"], f["prompt_tokens"].fillna(0).clip(lower=0).astype(int))):
                ok = (max_calls is None or n < max_calls) and (max_prompt is None or used + tokens <= max_prompt)
                n, used = n + ok, used + (tokens if ok else 0)
                rows.append((k[0], seq, bool(ok)))
        state.update((int(n), int(used)))
        yield pd.DataFrame(rows, columns=[key, "seq", "accepted"])

    kind = calls.schema[key].dataType.simpleString()
    return calls.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, seq bigint, accepted boolean", "calls bigint, used bigint", "append", GroupStateTimeout.NoTimeout)


# ------------------------------------------------------------- key rotation


def rotate_keys(requests: DataFrame, keys: list[str], cooldown: float = 60.0) -> DataFrame:
    """(pool, seq, key) for requests(pool, seq, ts, limited): the next key in
    turn that is not cooling down, else the one that is free first; a limited
    request sends its key to cool down."""
    names = list(dict.fromkeys(k for k in keys if k))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        at, until, out = 0, {}, []
        for r in frame.sort_values("seq").itertuples():
            order = [names[(at + i) % len(names)] for i in range(len(names))]
            key = next((k for k in order if r.ts >= until.get(k, 0)), None) or min(names, key=lambda k: until.get(k, 0))
            at = (names.index(key) + 1) % len(names)
            if r.limited:
                until[key] = r.ts + cooldown
            out.append((r.pool, r.seq, key))
        return pd.DataFrame(out, columns=["pool", "seq", "key"])

    if not names:
        return requests.select("pool", "seq", F.lit(None).cast("string").alias("key"))
    kind = requests.schema["pool"].dataType.simpleString()
    return requests.groupBy("pool").applyInPandas(run, f"pool {kind}, seq bigint, key string")
