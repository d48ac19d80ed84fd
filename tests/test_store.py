"""Stores: ids that go on, keyed and whole snapshots, writers that die."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from lodestone.sources import writers
from lodestone.sources.store import Conflict, Store


def ids(store):
    return sorted(((r.k, r.n, r.id) for r in store.read().collect()), key=repr)


def numbered(spark, rows):
    return spark.createDataFrame(rows, "k string, n int")


def test_ids_go_on(spark, tmp_path):
    path = str(tmp_path / "e")
    first = [("a", 3), ("a", 1), ("b", 1), (None, 7)]
    assert writers.append_json_lines(numbered(spark, first), path, "ev", "k", ["n"], ("w", 0)) == 1
    for _ in range(2):  # the second time the batch is there already
        assert writers.append_json_lines(numbered(spark, [("a", 0), (None, 1), ("c", 9)]), path, "ev", "k", ["n"], ("w", 1)) == 2
    got = ids(Store(spark, path, "json"))
    assert got == sorted(
        [("a", 1, "ev-000001"), ("a", 3, "ev-000002"), ("a", 0, "ev-000003"), ("b", 1, "ev-000001"), (None, 7, "ev-000001"), (None, 1, "ev-000002"), ("c", 9, "ev-000001")], key=repr
    )
    assert writers.append_json_lines(numbered(spark, []), path, "ev", "k", ["n"], ("w", 2)) == 3
    assert ids(Store(spark, path, "json")) == got
    with pytest.raises(ValueError):
        Store(spark, path, "json").append_numbered(numbered(spark, []).withColumn("id", F.lit("x")), "ev", "k", ["n"])
    with pytest.raises(ValueError):
        Store(spark, path, "json").append_numbered(numbered(spark, []).withColumn("m", F.lit(1)), "ev", "k", ["n"])


def test_ids_of_a_hot_key(spark, tmp_path):
    store, n = Store(spark, str(tmp_path / "hot")), 3000
    for batch in range(2):
        rows = spark.range(n).selectExpr("if(id % 10 = 0, concat('k', id % 30), 'hot') k", f"cast(id + {batch * n} as int) n")
        store.append_numbered(rows.repartition(4), "x", "k", ["n"], ("w", batch), width=4)
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{store.path}/_work").groupBy("k", "__part").count().where("k = 'hot'").count() > 2
    got = store.read().groupBy("k").agg(F.sort_array(F.collect_list(F.struct("n", "id"))).alias("x")).collect()
    assert {r.k: len(r.x) for r in got} == {"hot": 2 * n * 9 // 10, "k0": 200, "k10": 200, "k20": 200}
    for r in got:
        assert [x.id for x in r.x] == [f"x-{i:04d}" for i in range(1, len(r.x) + 1)]


def test_a_writer_that_dies(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    store.replace(spark.range(5).toDF("n"))

    def slow(batches):
        for b in batches:
            time.sleep(0.5)
            yield b

    # killed between tasks: some files of the new snapshot are there, others never come
    many = spark.range(40).repartition(40).mapInArrow(slow, "id long").toDF("n")
    failed = []

    def write():
        try:
            store.replace(many)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    files = lambda: len(list((tmp_path / "s").rglob("part-*")))
    before = files()
    t = threading.Thread(target=write)
    t.start()
    deadline = time.time() + 60
    while time.time() < deadline and files() < before + 3:
        time.sleep(0.02)
    spark.sparkContext.cancelAllJobs()
    t.join()
    assert failed and store.versions() == [1]
    assert sorted(r.n for r in store.read().collect()) == [0, 1, 2, 3, 4]

    @F.udf("long")
    def broken(x):
        raise RuntimeError("no")

    with pytest.raises(Exception):
        store.replace(spark.range(9).select(broken("id").alias("n")))
    assert store.versions() == [1]
    # the table may be made from itself
    assert store.replace(store.read().where("n > 2")) == 2 and store.read().count() == 2 and store.read(1).count() == 5
    assert store.vacuum(keep=1) >= 2 and store.versions() == [2] and store.read().count() == 2


def test_two_writers_from_one_version(spark, tmp_path):
    a, b = Store(spark, str(tmp_path / "c")), Store(spark, str(tmp_path / "c"))
    a.append(spark.range(3))
    held = b.manifest()
    a.append(spark.range(3))
    b.manifest = lambda version=None: held
    with pytest.raises(Conflict):
        b.append(spark.range(7))
    assert a.read().count() == 6
    with pytest.raises(FileNotFoundError):
        Store(spark, str(tmp_path / "none")).read()
    with pytest.raises(ValueError):
        Store(spark, str(tmp_path / "none"), "csv")


def test_snapshot_by_key(spark, tmp_path):
    store = Store(spark, str(tmp_path / "k"))
    make = lambda rows: spark.createDataFrame(rows, "a int, b string, v int, at int")
    store.upsert(make([(i, "x", i, 0) for i in range(50)] + [(None, None, 1, 0)]), ["a", "b"], buckets=8)
    before = store.manifest()["keyed"]["places"]
    store.upsert(make([(7, "x", 70, 1), (7, "x", 71, 2), (7, "y", 5, 1), (None, None, 2, 1)]), ["a", "b"], order="at")
    after = store.manifest()["keyed"]["places"]
    assert sum(before[b] == after[b] for b in before) >= 5  # other buckets keep their files
    got = {(r.a, r.b): r.v for r in store.read().collect()}
    assert got == {(i, "x"): i for i in range(50)} | {(7, "x"): 71, (7, "y"): 5, (None, None): 2}
    with pytest.raises(ValueError):
        store.upsert(make([]), ["a"])
    with pytest.raises(ValueError):
        store.append(make([]))
    docs = str(tmp_path / "d")
    writers.write_documents(spark.createDataFrame([(1, "é", 2)], "k int, z string, a int"), docs, "k")
    writers.write_documents(spark.createDataFrame([(1, "new", None), (2, "b", 3)], "k int, z string, a int"), docs, "k")
    assert {r.k: r.value for r in Store(spark, docs, "json").read().collect()} == {1: '{"z":"new"}', 2: '{"a":3,"z":"b"}'}
