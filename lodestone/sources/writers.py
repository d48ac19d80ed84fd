"""Sinks: append tables with sequence ids, documents, snapshots.

All of them publish by one pointer (see ``store``): a reader sees a change as a
whole or not at all, and a writer that dies leaves what was there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ledger import latest_by_key
from .store import Store


def append_json_lines(rows: DataFrame, path: str, prefix: str, key: str, order: list[str], batch: tuple[str, int] | None = None) -> int:
    """Append rows as JSON lines with ids ``prefix-000001``, which go on within
    each key from one append to the next; a batch that was stored before is not
    stored again.  Returns the version."""
    return Store(rows.sparkSession, path, "json").append_numbered(rows, prefix, key, order, batch)


def write_snapshot(rows: DataFrame, path: str) -> int:
    """Replace a table's snapshot."""
    return Store(rows.sparkSession, path).replace(rows)


def upsert_view(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The current state of an append table."""
    return latest_by_key(rows, keys, order)


def write_documents(rows: DataFrame, path: str, key: str) -> int:
    """One sorted-key JSON document per row (key, value), replacing that of its key."""
    cols = sorted(c for c in rows.columns if c != key)
    return Store(rows.sparkSession, path, "json").upsert(rows.select(key, F.to_json(F.struct(*cols)).alias("value")), [key])


def artifact_names(rows: DataFrame, category: str, name: str) -> DataFrame:
    """Safe file names of stored artifacts, at most 160 characters."""
    from ..functions.text import label_name

    return rows.withColumn("artifact", F.concat_ws("/", label_name(F.col(category)), label_name(F.col(name))))
