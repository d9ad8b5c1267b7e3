"""Durable intermediate tables in the shared checkpoint folder, and ranks without a single task."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """The rows as a checkpoint in the folder that the cluster names, or, in local mode only, a temporary one."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not named and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="sedimark-"))
    return df.checkpoint()


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Numbers all rows from 1 in ``order``, which must be total.

    Range partitions are numbered apart and shifted by the sizes of those before them; only one row for each partition
    passes through a single task.
    """
    spark: SparkSession = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_pid").count().select("_pid", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    return ranged.withColumn("_in", inside).join(F.broadcast(sizes), "_pid").withColumn(name, (F.col("_before") + F.col("_in")).cast("long")).drop("_pid", "_in", "_before")
