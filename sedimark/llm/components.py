"""Connected components of an edge table, by rounds of distributed joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.llm.common import drop_written, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` can reach.

    Alternates two star steps (every node's larger neighbours, then its smaller ones, are linked to the smallest
    node around it) until the edges stop changing, in about log(n) rounds. Each round is written to the shared
    folder. A node's neighbours are only ever aggregated with min, so a hub is combined before its shuffle.
    Null ends are ignored; no edges give an empty table.
    """
    now = written(edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    spark = edges.sparkSession
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = written(small, "links")
        drop_written(spark, large)
        # order-independent digest of the edge set: equal in two rounds means nothing moved
        digest = tuple(small.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        drop_written(spark, now)
        now = small
        if digest == mark:
            break
        mark = digest
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
