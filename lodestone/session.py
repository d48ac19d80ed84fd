"""Session settings that the operators assume."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with the engine's settings.  On a cluster leave ``master`` and
    the partition count to the deployment; tests pass both."""
    b = SparkSession.builder.appName("lodestone")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return b.config(map=SETTINGS | conf).getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared folder that the session names in
    spark.checkpoint.dir; only in local mode may that be a temporary one."""
    return f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"


def _shared(spark: SparkSession) -> str:
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and sc._jsc.sc().getCheckpointDir().isDefined():
        folder = sc._jsc.sc().getCheckpointDir().get()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lodestone-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The table, computed once and kept as Parquet in the shared folder that the
    session names in spark.checkpoint.dir, so that loops neither repeat work nor
    grow their plans.  A checkpoint would keep its plan's size estimate, which
    joins multiply: a loop of self-joins doubles that number's digits each round."""
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcastable(df, limit_bytes: int = 32 << 20) -> bool:
    """Whether Catalyst's size estimate of a table is under a bound.  Rule
    tables that were built on the driver always are."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes())) <= limit_bytes


def few(df: DataFrame) -> DataFrame:
    """A table for the small side of a join: broadcast where its size is known to
    be bounded, else left to Catalyst."""
    return F.broadcast(df) if broadcastable(df) else df
