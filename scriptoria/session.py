"""Session settings and materialised cuts of a plan."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "scriptoria", cores: str = "*", partitions: int | None = None) -> SparkSession:
    """The session of the cluster this was submitted to, with its own settings; a local one of `cores` elsewhere.

    The number of shuffle partitions is set for a local session only (8 unless given); a cluster has its own, which
    adaptive execution coalesces.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    if "PYSPARK_GATEWAY_PORT" not in os.environ and "SPARK_REMOTE" not in os.environ:
        builder = builder.master(f"local[{cores}]").config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", str(partitions or 8))
    elif partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. A temporary one is made only in local mode, where every task sees the same disk."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir names no folder that all executors share")
    own = os.environ.get("SCRIPTORIA_LOCAL_SHARED")
    if not own:
        own = os.environ["SCRIPTORIA_LOCAL_SHARED"] = tempfile.mkdtemp(prefix="scriptoria-")
    return "file://" + own


#: The setting by which a write removes the shuffle files of its plan.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables that cut lineage: written once into the shared folder and read from there.

    Every executor sees the folder, so a lost executor costs only its running tasks. drop() removes a table that
    no later step reads; a result that is still to be read holds the others, so the whole folder goes when the
    application ends, or earlier with close().
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/scriptoria-{label}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)

    def path(self, name: str) -> str:
        self.count += 1
        return f"{self.root}/{self.count:04d}-{name}"

    def cut(self, df: DataFrame, name: str, release: bool = False) -> DataFrame:
        """df, written and read back. release: the shuffle files of its plan go as soon as it is written, not when the driver's garbage is collected."""
        where = self.path(name)
        seen = Observation()
        before = self.spark.conf.get(RELEASE, None)
        if release:
            self.spark.conf.set(RELEASE, "true")
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", "zstd").parquet(where)
        finally:
            if release:
                self.spark.conf.unset(RELEASE) if before is None else self.spark.conf.set(RELEASE, before)
        out = self.spark.read.schema(df.schema).parquet(where)
        out._scratch_path, out._scratch_rows = where, seen.get["rows"]
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            where = getattr(t, "_scratch_path", None)
            if where:
                delete_path(self.spark, where)

    def close(self) -> None:
        delete_path(self.spark, self.root)


def delete_path(spark: SparkSession, where: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
