"""Session helpers: settings, and working tables in the folder the cluster shares."""

from __future__ import annotations

import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Settings the library assumes. Only session settings: nothing that needs a restart."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, named by ``spark.checkpoint.dir``.

    Unset, a session whose executors are threads of this process gets a fresh local folder (tests,
    trials); on a cluster that is an error, as executors do not see each other's disks.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="quotegrid-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def working_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/quotegrid/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    For a frame several branches of one plan need: it is computed once, the columns each branch
    does not use are never read, and the loss of an executor costs a re-read, not a recomputation.
    """
    path = working_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class WorkingTables:
    """Tables of a plan with many steps, which are given up as soon as no later step reads them.

    Spark deletes the shuffle files of a finished step when its driver collects garbage; a step's end is a good
    moment for that, and without it the files of all steps lie on the executors' disks at once.
    """

    def __init__(self, name: str):
        self.name = name
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame, step: str) -> DataFrame:
        """Write ``df`` to the shared folder and read it back, as :func:`stage` does."""
        path = working_path(df.sparkSession, f"{self.name}-{step}")
        df.write.option("compression", "zstd").parquet(path)
        table = df.sparkSession.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        del df
        sweep(table.sparkSession)
        return table

    def keep_bucketed(self, df: DataFrame, step: str, key: str) -> DataFrame:
        """The same, as a table bucketed by ``key``: joins on it do not move the table's rows again. It is not dropped."""
        spark = df.sparkSession
        name = f"{self.name}_{step}_{uuid.uuid4().hex}".replace("-", "_")
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        path = working_path(spark, f"{self.name}-{step}")
        df.write.bucketBy(buckets, key).option("path", path).option("compression", "zstd").saveAsTable(name)
        del df
        sweep(spark)
        return spark.table(name)

    def drop(self, *tables: DataFrame) -> None:
        """Empty tables of :meth:`keep` that nothing reads any more."""
        for table in tables:
            path = self.paths.pop(id(table))
            table.sparkSession.createDataFrame([], table.schema).coalesce(1).write.mode("overwrite").parquet(path)


def sweep(spark: SparkSession) -> None:
    """Let the driver collect what finished steps have left."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()
