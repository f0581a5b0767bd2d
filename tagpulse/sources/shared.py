"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, one process alone (master local) gets a temporary folder."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, free: bool = False) -> DataFrame:
    """``df`` written as Parquet and read back: a cut lineage that survives lost executors.

    ``free``: the shuffle files of the write go with its end, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path, before = new_path(spark, "step"), spark.conf.get(CLEANUP, "false")
    try:
        if free:
            spark.conf.set(CLEANUP, "true")
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if free:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by ``written`` of which nothing unwritten depends any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if re.search(r"/step-[0-9a-f]{32}$", path):
                p = sc._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
