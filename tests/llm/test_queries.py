"""The queries over the synthetic tables, and the pipeline."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import sentencepiece_codec
from lodestone.llm.queries import oracle_sql, queries
from tests.conftest import SF, rows
from tests.llm import brute
from tests.llm.test_small import MODEL, library


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_warc(spark, duck):
    got = queries()["op1_warc"](spark, SF).toPandas()
    assert rows(got) == rows(duck.execute(oracle_sql()["op1_warc"]).df())


def test_tokens(spark, texts):
    sp = library()
    n = {i: len(x) for i, x in zip(texts, sp.encode(list(texts.values())))}
    assert {r.doc_id: r.n_tokens for r in queries()["op10_token_counts"](spark, SF).collect()} == n
    got = queries()["op2_sentencepiece"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == n and all(r.exact for r in got)


def test_dedup(spark, texts):
    got = queries()["op3_substring_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.substring_dedup(texts, 35)
    got = queries()["op7_suffix_dedup"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.suffix_dedup(texts, 100)
    got = queries()["op6_ngram_join"](spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.ngram_components(texts, 4, 85)


def test_decontamination(spark, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in queries()["op4_decontamination"](spark, SF).collect()}
    assert got >= {(d, i) for d, t in texts.items() for i, q in items.items() if q in t}
    from lodestone.llm.decontaminate import least_distance

    for d, i in got:
        assert least_distance(items[i].lower(), texts[d].lower().replace("\n", " "))[0] <= 0.2 * len(items[i]) + 1


def test_hnsw_recall(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    v, ids = np.array(e.embedding.tolist(), float), e.vec_id.values
    got = queries()["op5_hnsw"](spark, SF).toPandas()
    hit = 0
    for q, g in got.groupby("query_id"):
        d = np.sqrt(((v - v[ids == q][0]) ** 2).sum(1))
        want = sorted((x, i) for x, i in zip(d, ids) if i != q)[:10]
        hit += len({i for _, i in want} & set(g.vec_id))
    assert hit / len(got) >= 0.9


def test_toxicity(spark):
    got = queries()["op8_toxicity"](spark, "/root/testdata/sf0.1").toPandas()
    lab = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    m = got.merge(lab, on="doc_id")
    m = m[m.held_out]
    a, b = m[m.toxic == 1].score.values, m[m.toxic == 0].score.values
    assert np.mean((a[:, None] > b) + 0.5 * (a[:, None] == b)) > 0.9 and np.mean(b >= 0.5) < 0.02


def test_pipeline(spark, texts):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    df = docs
    for name, stage in p.STAGES:
        df = stage(spark, df, SF).cache()
        kept[name] = {r.doc_id for r in df.select("doc_id").collect()}
        if name != "sentencepiece_encoding":
            assert sorted(df.columns) == sorted(docs.columns)
    one, two, three, four, five = kept.values()
    groups = brute.ngram_components({i: texts[i] for i in one}, 5, 80)
    assert two == {i for i in one if groups[i][1] == i}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(q in texts[i] for i in three for q in items) and three <= two
    assert three == four == five
    codec = sentencepiece_codec.Codec(MODEL)
    final = p.run(spark, SF)
    assert final.count() == len(five)
    for r in final.limit(20).collect():
        assert codec.decode(r.token_ids) == texts[r.doc_id] or "[SECRET]" in codec.decode(r.token_ids)
    toxic = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").select(F.collect_set("doc_id").alias("s")).first()["s"]
    assert len(set(texts) - one) <= len(toxic) + 10
