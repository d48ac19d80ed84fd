"""Token counts through a digest cache.

A text's content digest (SHA-256 of its UTF-8 bytes, null as empty text) and
the tokenizer's version digest (its file, library version and options) key a
Parquet table of stored counts.  A call joins the input's digests to that
table, encodes each distinct missing text once, appends the new counts and
answers from the table.

Null or empty text: 0 tokens.  Repeated texts share one encoding.  Null ids
stay null.  An empty input gives an empty result.  Further input columns are
ignored.  Whole texts only.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .common import chunks, column, scratch_path, task

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"


def resolve(tokenizer: str) -> str:
    """A path as it is, or the name of an installed public tokenizer file."""
    if "/" in tokenizer:
        return tokenizer
    import public_tokenizers

    return str(public_tokenizers.path(tokenizer))


def tokenizer_version(tokenizer: str) -> str:
    """Digest of everything that decides a count: file, library, options."""
    path = resolve(tokenizer)
    if path.endswith(".model"):
        import sentencepiece as lib
    elif path.endswith(".json"):
        import tokenizers as lib
    else:
        import tiktoken as lib
    h = hashlib.sha256(open(path, "rb").read())
    h.update(f"|{lib.__name__} {lib.__version__}|plain, whole text".encode())
    return h.hexdigest()


def counter(tokenizer: str):
    """A function from a list of texts to their token counts, without begin,
    end or added special tokens."""
    path = resolve(tokenizer)
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return lambda texts: [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(enc.encode_ordinary(t)) for t in texts]


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; a missing table is created empty."""
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        spark.createDataFrame([], CACHE_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        return spark.read.schema(CACHE_SCHEMA).parquet(path)


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    cache: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 4096,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit.

    ``cache`` is the folder of stored counts; without one a fresh folder in
    the shared scratch space is used.
    """
    spark = docs.sparkSession
    cache = cache or scratch_path(spark, "token-counts")
    version = tokenizer_version(tokenizer)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("content"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    stored = open_cache(spark, cache).where(F.col("tokenizer") == version)
    # partial aggregation keeps one copy of each text per task, so a hot text
    # crosses the exchange once per task
    misses = keyed.groupBy("content").agg(F.first("text").alias("text")).join(stored, "content", "left_anti")

    def encode(batches):
        count = counter(tokenizer)
        for b in chunks(batches, "text", 256 << 10):
            n = count(column(b, "text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [column(b, "content"), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())],
                ["content", "tokenizer", "n_tokens"],
            )

    misses.mapInArrow(task(encode), CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = (
        spark.read.schema(CACHE_SCHEMA)
        .parquet(cache)
        .where(F.col("tokenizer") == version)
        .groupBy("content")
        .agg(F.max("n_tokens").alias("n_tokens"))  # writers that ran side by side may repeat a row
    )
    return keyed.drop("text").join(counts, "content", "left").select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
