"""Shared plumbing: scratch space, Arrow text access, numpy text kernels.

Every kernel works on one chunk of concatenated UTF-8 text with per-document
offsets, so Python never loops over characters or words.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------- scratch


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; only where it is unset (tests,
    local mode) a temporary folder is created and set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodestone-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage at a Parquet table in the shared scratch folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SIEVE_WORDS = 1 << 20  # bound of a sieve: 8 MB


def sieved(df: DataFrame, keys: DataFrame, on: str, n: int) -> DataFrame:
    """``df`` without most of the rows whose ``on`` is none of ``keys`` (about
    ``n`` of them), by one bit for each key's hash: less to shuffle for the join
    with the keys that must follow.  The bits are of bounded size, however many
    keys there are; with more keys more rows stay."""
    from pyspark.sql import functions as F

    words = 1 << min(SIEVE_WORDS.bit_length() - 1, max(4, (max(n, 1) // 4).bit_length()))
    place = F.pmod(F.xxhash64(F.lit(3), F.col(on)), F.lit(64 * words))
    ones = keys.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b"))
    every = ones.unionByName(keys.sparkSession.range(words).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b")))
    bits = every.groupBy("w").agg(F.bit_or("b").alias("b")).agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "b"))), lambda x: x["b"]).alias("bits"))
    word = F.get(bits.scalar(), F.floor(place / 64).cast("int"))
    return df.where(F.getbit(word, (place % 64).cast("int")) == 1)


def width(spark: SparkSession) -> int:
    """Number of hash buckets for explicit exchanges: follows the session."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------- arrow


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls count as empty texts."""
    import pyarrow.compute as pc

    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offs = np.frombuffer(off, np.int64)[texts.offset : texts.offset + n + 1]
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def chunks(batches, text_col: str, limit: int = 2 << 20):
    """Slices of record batches with about ``limit`` bytes of text each.  One
    longer document makes a chunk of its own: texts are never cut."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        _, offs = text_buffers(column(batch, text_col))
        i = 0
        while i < n:
            j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
            j = min(n, max(i + 1, j))
            yield batch.slice(i, j - i)
            i = j


def give_back() -> None:
    """Return freed memory to the system, where that is possible: Python workers
    live on between tasks, and what they keep adds up beside the JVM."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def task(run):
    """A function for mapInArrow whose task ends by giving its memory back."""

    def whole(batches):
        pa.set_memory_pool(pa.system_memory_pool())
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


# ---------------------------------------------------------------- kernels

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
COEF = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
R = 0x9E3779B97F4A7C15 | 5
R_INV = pow(R, -1, 2**64)
_pow: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next chunk."""
    have = _pow.get(base)
    if have is None or len(have) < n:
        size = -(-n >> 18) << 18
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        with np.errstate(over="ignore"):
            while done < size:
                step = min(done, size - done)
                have[done : done + step] = have[:step] * np.uint64(pow(base, done, 2**64))
                done += step
        if size <= 1 << 23:
            _pow[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(32)
    return h


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[j]-S[i] = sum of BYTE[data[k]] * R**k for i <= k < j."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(R, len(data)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit content hashes of byte spans, whatever their position."""
    h = (sums[end] - sums[start]) * powers(R_INV, len(sums))[start]
    return mix(h + (end - start).astype(np.uint64) * COEF[0])


def word_spans(data: np.ndarray, offs: np.ndarray):
    """Starts, ends of words and, per document, the index of its first word
    (one more entry than documents).  Words are runs of bytes other than
    0x20 and 0x09-0x0D; none crosses a document."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last = solid
    last[:-1] &= ~solid[1:] | edge[1:n]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hash(prefix_sums(data), start, end)


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenation of arange(first[i], first[i]+count[i])."""
    total = int(count.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    at = np.cumsum(count) - count
    keep = count > 0
    at, f, c = at[keep], first[keep], count[keep]
    out[at[0]] = f[0]
    out[at[1:]] = f[1:] - (f[:-1] + c[:-1] - 1)
    return np.cumsum(out)
