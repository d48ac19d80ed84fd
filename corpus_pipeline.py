"""Corpus pipeline: documents in, token ids of the clean, distinct ones out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, ngram_join, secrets, sentencepiece_codec, toxicity
from lodestone.llm.common import written

MODEL = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    model = toxicity.from_labels(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, score_col="__score").where("__score < 0.5").drop("__score")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8)."""
    return ngram_join.keep_one(docs, k=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Confirmed secrets are masked; every document stays."""
    out = secrets.redact(docs, secrets.train(secrets.labelled_findings(spark)))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left."""
    rows = sentencepiece_codec.encode(docs.select("doc_id", "source", "lang", "text"), MODEL, ids_col="token_ids")
    return rows.drop("text").withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("sentencepiece_encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: Scores, approximate search and encoding have no SQL form; the pipeline is
#: tested against a brute-force version.
ORACLE_SQL = None
