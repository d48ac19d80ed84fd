"""Word-window deduplication by level-wise doubling.

Which windows of ``window`` words occur more than once?  Windows of a short
length (the window halved, rounding up, while at least ``least`` words are left)
are hashed and dealt out by hash; those that repeat keep a label.  Only where
two labelled windows lie side by side can a window of twice the length repeat:
its key is the pair of labels, and it goes through the same exchange.  The last
step overlaps its halves to reach exactly ``window`` words.  Positions of
windows that occur once leave at every level.

Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged; windows never
cross documents.  Every occurrence of a repeated window is covered, the first
included, and the windows are judged on the input.

Null texts have no words.  Rows with the same id and text (repeated rows) count
as separate documents, so their windows repeat.  Ids are integers or null; null
ids are kept.  An empty table gives an empty result, and further columns are
ignored.  Keys are 64-bit hashes (45-bit filters below the last level).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, column, mix, powers, R, R_INV, task, text_buffers, width, word_hashes, word_spans
from .positions import SCHEMA, deal, gather, join_parts, judge, pack_sorted, split_parts, unpack_sorted


def lengths(window: int, least: int = 16) -> list[int]:
    """Window lengths from the first level to the last."""
    out = [window]
    while (out[0] + 1) // 2 >= least:
        out.insert(0, (out[0] + 1) // 2)
    return out


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.lit(1), text).alias("k"), text.alias("text"))


def doc_notes(b: pa.RecordBatch, first: np.ndarray) -> bytes:
    """Ids, null flags, content keys and first positions of a source's documents."""
    ids = column(b, "id")
    null = np.array(ids.is_null())
    return join_parts(
        ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
        np.packbits(null).tobytes(),
        column(b, "k").to_numpy().astype("<i8").tobytes(),
        pack_sorted(first),
    )


def read_notes(notes: bytes):
    ids, null, k, first = split_parts(notes)
    ids = np.frombuffer(ids.tobytes(), "<i8")
    return ids, np.unpackbits(null)[: len(ids)].astype(bool), np.frombuffer(k.tobytes(), "<i8"), unpack_sorted(first)


def repeated(docs: DataFrame, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words covered by repeated windows: id, k (content key), runs (binary:
    pairs of first and last-plus-one word index as 32-bit integers), one row
    per distinct (id, k) with a run."""
    spark = docs.sparkSession
    n = width(spark)
    levels = lengths(window)
    keyed = _keyed(docs, id_col, text_col)

    def first_level(batches):
        size, part, at = levels[0], TaskContext.get().partitionId(), 0
        for b in chunks(batches, "text"):
            data, offs = text_buffers(column(b, "text"))
            start, end, first = word_spans(data, offs)
            h = word_hashes(data, start, end)
            sums = np.zeros(len(h) + 1, np.uint64)
            np.cumsum(h * powers(R, len(h)), out=sums[1:])
            per = np.diff(first)
            left = np.repeat(first[1:], per) - np.arange(len(h))  # words to the document's end
            i = np.flatnonzero(left >= size)
            keys = mix((sums[i + size] - sums[i]) * powers(R_INV, len(h) + 1)[i])
            doc = np.repeat(np.arange(len(per)), per)
            # one unused position between documents: no window reaches over it
            yield deal((part << 32) + at, i + doc[i], keys, n, 4 if len(levels) > 1 else 8, doc_notes(b, first[:-1] + np.arange(len(per))))
            at += 1

    def judged(bits, labels):
        return lambda batches: judge(batches, bits, labels)

    def next_level(half, size):
        def run(batches):
            for src, notes, pos, ids in gather(batches, True):
                j = np.searchsorted(pos, pos + (size - half))
                j[j == len(pos)] = 0
                ok = pos[j] == pos + (size - half) if len(pos) else np.zeros(0, bool)
                keys = mix(ids[ok] * np.uint64(R) + ids[j[ok]])
                yield deal(src, pos[ok], keys, n, 8, notes)

        return run

    def runs(batches):
        for _, notes, pos, _ in gather(batches, False):
            if notes is None or not len(pos):
                continue
            ids, null, k, first = read_notes(notes)
            cut = np.ones(len(pos), bool)
            cut[1:] = pos[1:] > pos[:-1] + window  # runs that touch are one
            a = pos[cut]
            z = np.append(pos[np.flatnonzero(cut)[1:] - 1], pos[-1]) + window
            doc = np.searchsorted(first, a, side="right") - 1
            pairs = np.stack([a - first[doc], z - first[doc]], 1).astype("<i4")
            at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            d = doc[at]
            blobs = [pairs[i:j].tobytes() for i, j in zip(at, np.append(at[1:], len(doc)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[d], pa.int64(), mask=null[d]), pa.array(k[d], pa.int64()), pa.array(blobs, pa.binary())], ["id", "k", "runs"]
            )

    flow = keyed.mapInArrow(task(first_level), SCHEMA)
    for i, size in enumerate(levels):
        last = size == window
        flow = flow.repartition(n, "key").mapInArrow(task(judged(4 if i == 0 and not last else 8, not last)), SCHEMA).repartition(n, "src")
        if not last:
            flow = flow.mapInArrow(task(next_level(size, levels[i + 1])), SCHEMA)
    found = flow.mapInArrow(task(runs), "id long, k long, runs binary")
    return found.groupBy("id", "k").agg(F.max("runs").alias("runs"))  # equal rows have equal runs


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 and, where
    asked for, kept_text (the words left, joined by one space)."""
    keyed = _keyed(docs, id_col, text_col)
    masks = repeated(docs, window, id_col, text_col)
    joined = keyed.alias("d").join(masks.alias("m"), F.col("d.id").eqNullSafe(F.col("m.id")) & (F.col("d.k") == F.col("m.k")), "left").select(
        "d.id", "d.text", "m.runs"
    )
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text

    def apply(batches):
        for b in chunks(batches, "text"):
            total, gone, sha, kept = [], [], [], []
            for text, runs in zip(column(b, "text").to_pylist(), column(b, "runs").to_pylist()):
                words = text.encode().split()
                total.append(len(words))
                if runs:
                    for i, j in np.frombuffer(runs, "<i4").reshape(-1, 2)[::-1].tolist():
                        del words[i:j]
                gone.append(total[-1] - len(words))
                left = b" ".join(words)
                sha.append(hashlib.sha256(left).hexdigest())
                if keep_text:
                    kept.append(left.decode())
            cols = [column(b, "id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)]
            names = ["id", "n_words", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept)] * keep_text, names + ["kept_text"] * keep_text)

    return joined.mapInArrow(task(apply), schema).withColumnRenamed("id", id_col)
