"""Tables that change by one published pointer.

A store is a folder.  Spark writes the rows of a change into a folder of their
own, ``data=<name>``; ``read`` does not know it yet.  When the job has ended, the driver
publishes the next version: a small file in ``_published/`` that names the
folders which make up the table.  It is written under another name first and
then renamed, without overwriting, so a reader sees the old version or the new
one, a writer that dies leaves the old one, and of two writers that start from
one version the second fails with ``Conflict`` instead of losing the first's
rows.  (Renaming is atomic on HDFS and local disks; an object store needs a file
system that makes it so.)

``batch=(writer, number)`` makes a change idempotent: a number that this writer
has published before, or a smaller one, changes nothing.  Streams pass their
batch id, so a batch that runs again after a failure is not stored twice.

Where rows are only appended, the folder may also be read as it is, as a table
partitioned by ``data``; it then has what dead writers left complete, too.

Nothing is collected but version files, whose size follows the number of appends
since the last ``replace`` (or of key buckets), not the rows.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ledger import latest_by_key


class Conflict(RuntimeError):
    """Another writer published the version that this one was about to."""


class Store:
    def __init__(self, spark: SparkSession, path: str, format: str = "parquet"):
        if format not in ("parquet", "json"):
            raise ValueError(f"parquet or json, not {format}")
        self.spark, self.path, self.format = spark, path.rstrip("/"), format

    # ------------------------------------------------------------- pointer

    def _hadoop(self):
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_published")
        conf = self.spark._jsc.hadoopConfiguration()
        return jvm, root, root.getFileSystem(conf), conf

    def versions(self) -> list[int]:
        _, root, fs, _ = self._hadoop()
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """What a version consists of; of an empty store, version 0."""
        if version is None:
            known = self.versions()
            version = known[-1] if known else 0
        if version == 0:
            return {"version": 0, "folders": [], "schema": None, "writers": {}, "marks": None, "keyed": None}
        jvm, root, fs, _ = self._hadoop()
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(root, f"{version:020d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> int:
        jvm, root, fs, conf = self._hadoop()
        Path = jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(root)
        own = Path(root, f".{uuid.uuid4().hex}")
        stream = fs.create(own, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        to = Path(root, f"{manifest['version']:020d}.json")
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), conf).rename(own, to, none)
        except Exception as e:
            fs.delete(own, False)
            if fs.exists(to):
                raise Conflict(f"version {manifest['version']} of {self.path} is another writer's") from e
            raise
        return manifest["version"]

    # ---------------------------------------------------------------- parts

    def _seen(self, manifest: dict, batch: tuple[str, int] | None) -> bool:
        return batch is not None and batch[1] <= manifest["writers"].get(batch[0], -1)

    def _next(self, manifest: dict, batch: tuple[str, int] | None, **changes) -> int:
        writers = manifest["writers"] | ({batch[0]: batch[1]} if batch else {})
        return self._publish(manifest | changes | {"version": manifest["version"] + 1, "writers": writers})

    def _written(self, rows: DataFrame, kind: str = "data", format: str | None = None, by: str | None = None) -> str:
        folder = f"{kind}{'=' if kind == 'data' else '/'}{uuid.uuid4().hex}"
        out = rows.write.format(format or self.format)
        (out.partitionBy(by) if by else out).save(f"{self.path}/{folder}")
        return folder

    def _load(self, folders: list[str], schema: str, format: str | None = None) -> DataFrame:
        kind = StructType.fromJson(json.loads(schema))
        if not folders:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).format(format or self.format).load([f"{self.path}/{f}" for f in folders])

    def _same(self, manifest: dict, rows: DataFrame) -> None:
        have = manifest["schema"] and [(f["name"], f["type"]) for f in json.loads(manifest["schema"])["fields"]]
        given = [(f["name"], f["type"]) for f in json.loads(rows.schema.json())["fields"]]
        if have and have != given:
            raise ValueError(f"the table has columns {have}, not {given}")

    # ------------------------------------------------------------ interface

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, the last one where none is given."""
        m = self.manifest(version)
        if not m["version"]:
            raise FileNotFoundError(f"nothing has been published in {self.path}")
        return self._load(m["folders"], m["schema"])

    def replace(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """The whole table becomes ``rows``; they may be read from it."""
        m = self.manifest()
        if self._seen(m, batch):
            return m["version"]
        return self._next(m, batch, folders=[self._written(rows)], schema=rows.schema.json(), marks=None, keyed=None)

    def append(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> int:
        m = self.manifest()
        if self._seen(m, batch):
            return m["version"]
        if m["keyed"] or m["marks"]:
            raise ValueError("rows of this table have keys or numbers")
        self._same(m, rows)
        return self._next(m, batch, folders=[*m["folders"], self._written(rows)], schema=m["schema"] or rows.schema.json())

    def append_numbered(
        self, rows: DataFrame, prefix: str, key: str, order: list[str | Column], batch: tuple[str, int] | None = None, width: int = 6, name: str = "id"
    ) -> int:
        """Append with ids ``prefix-000001``, which go on from one append to the
        next within each key (null is a key of its own).

        Rows are dealt by range of key and order, so that a key with most of the
        rows is numbered in many tasks: numbers within a task's rows of a key,
        plus what the key has in the tasks before, plus its mark, which is the
        last number given so far.
        """
        m = self.manifest()
        if self._seen(m, batch):
            return m["version"]
        if m["folders"] and not m["marks"]:
            raise ValueError("the rows of this table have no numbers to go on from")
        own_names = {"__part", "__own", "__first", "__p", "__k", name}
        if clash := [c for c in rows.columns if c.lower() in {x.lower() for x in own_names}]:
            raise ValueError(f"the rows already have {clash}")
        parts = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = rows.repartitionByRange(parts, key, *order).withColumn("__part", F.spark_partition_id())
        # kept as written: ids must not change if a task is done again
        staged = self._load([self._written(dealt, "_work", "parquet")], dealt.schema.json(), "parquet")
        counts = staged.groupBy("__part", key).agg(F.count(F.lit(1)).alias("__n"))
        mark_kind = StructType().add("__key", rows.schema[key].dataType).add("__last", "long").json()
        marks = self._load([m["marks"]] if m["marks"] else [], mark_kind, "parquet")
        before = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        first = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        first = first.join(marks, F.col(key).eqNullSafe(F.col("__key")), "left").select(
            F.col("__part").alias("__p"), F.col(key).alias("__k"), (F.col("__before") + F.coalesce("__last", F.lit(0))).alias("__first")
        )
        own = F.row_number().over(Window.partitionBy("__part", key).orderBy(*order))
        joined = staged.withColumn("__own", own).join(first, (F.col("__part") == F.col("__p")) & F.col(key).eqNullSafe(F.col("__k")))
        numbered = joined.select(F.format_string(f"{prefix}-%0{width}d", F.col("__first") + F.col("__own")).alias(name), *rows.columns)
        self._same(m, numbered)
        folder = self._written(numbered)
        now = marks.unionByName(counts.select(F.col(key).alias("__key"), F.col("__n").alias("__last"))).groupBy("__key").agg(F.sum("__last").alias("__last"))
        return self._next(m, batch, folders=[*m["folders"], folder], schema=m["schema"] or numbered.schema.json(), marks=self._written(now, "_marks", "parquet"))

    def upsert(self, rows: DataFrame, keys: list[str], order: str | None = None, buckets: int = 64, batch: tuple[str, int] | None = None) -> int:
        """Rows replace those of their keys.  Of rows that share a key, that with
        the largest ``order`` counts.  The table lies in buckets by its keys'
        hash, and only buckets that get rows are written anew."""
        m = self.manifest()
        if self._seen(m, batch):
            return m["version"]
        if m["version"] and not m["keyed"] and m["folders"]:
            raise ValueError("this table has no keys")
        self._same(m, rows)
        keyed = m["keyed"] or {"keys": keys, "buckets": buckets, "places": {}}
        if keyed["keys"] != keys:
            raise ValueError(f"the keys of this table are {keyed['keys']}")
        bucket = F.pmod(F.xxhash64(*keys), F.lit(keyed["buckets"])).cast("int").alias("__bucket")
        new = latest_by_key(rows, keys, order).select(rows.columns) if order else rows
        # at most as many values as there are buckets
        hit = {str(r[0]) for r in new.select(bucket).distinct().collect()}
        schema = m["schema"] or rows.schema.json()
        old = self._load([f for b, f in keyed["places"].items() if b in hit], schema)
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
        on = same[0]
        for c in same[1:]:
            on = on & c
        kept = old.alias("o").join(new.select(*keys).distinct().alias("n"), on, "left_anti")
        both = kept.unionByName(new).withColumn("__bucket", bucket)
        folder = self._written(both.repartition("__bucket"), by="__bucket")
        places = keyed["places"] | {b: f"{folder}/__bucket={b}" for b in hit}
        return self._next(m, batch, folders=sorted(places.values()), schema=schema, keyed=keyed | {"places": places})

    def vacuum(self, keep: int = 2) -> int:
        """Delete what only versions before the last ``keep`` use, and what was
        written but never published; no writer may be at work.  Returns the
        number of folders deleted."""
        jvm, root, fs, _ = self._hadoop()
        Path = jvm.org.apache.hadoop.fs.Path
        known = self.versions()
        used: set[str] = set()
        for v in known[-keep:]:
            m = self.manifest(v)
            used |= {f.split("/")[0] for f in m["folders"]} | ({m["marks"]} if m["marks"] else set())
        gone = 0
        for top in ("", "_marks/", "_work/"):
            folder = Path(f"{self.path}/{top}")
            for s in fs.listStatus(folder) if fs.exists(folder) else []:
                name = f"{top}{s.getPath().getName()}"
                if name not in used and (top or name.startswith("data=")):
                    gone += bool(fs.delete(s.getPath(), True))
        for v in known[:-keep]:
            fs.delete(Path(root, f"{v:020d}.json"), False)
        return gone
