"""What a session offers: the folder that the driver and all executors share, and its cores."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the checkpoint folder set on the context. Where neither is set, a temporary one if all
    runs on this machine; on a cluster each executor would see its own, so that is refused with RuntimeError."""
    sc = spark.sparkContext
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named.rstrip("/")
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pairscore-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def spread(df: DataFrame) -> DataFrame:
    """The same rows, dealt to all cores if they come in fewer partitions, as from a file of one row group. Tables of many
    splits are left as they are, without an exchange."""
    plan, cores = df._jdf.queryExecution().executedPlan(), df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in plan.toString() or df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def parts_by_size(df: DataFrame, size: int) -> int:
    """How many partitions a table is to be dealt to, so that each gets the rows of about ``size`` bytes of its files; at
    least one for each core."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-stats.sizeInBytes() // size))
