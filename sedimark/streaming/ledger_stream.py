"""The revision ledger over a stream of observations (an extension: the batch ledger is the reference form).

Each micro-batch is joined with the earlier observations of the postings it touches, and only its own rows are
appended, so a batch costs what its postings have, not the whole ledger. A batch that is run again writes the same
folder again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sedimark.operators.ledger import lifecycle


def _earlier(spark: SparkSession, path: str, batch: int, like: DataFrame) -> DataFrame:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return like.limit(0)
    return spark.read.parquet(path).where(F.col("batch") < batch).select(like.columns)


def ledger_batch(batch: DataFrame, number: int, path: str, keys: Sequence[str], seq: str = "seq", digest: str = "hash") -> None:
    """Appends one batch of observations with their states to the ledger at ``path``."""
    spark = batch.sparkSession
    old = _earlier(spark, path, number, batch).join(batch.select(*keys).distinct(), list(keys), "left_semi")
    both = old.withColumn("_own", F.lit(False)).unionByName(batch.withColumn("_own", F.lit(True)))
    states = lifecycle(both, keys, seq, digest).where("_own").drop("_own")
    states.write.mode("overwrite").parquet(f"{path}/batch={number}")


def start(observations: DataFrame, path: str, checkpoint: str, keys: Sequence[str], seq: str = "seq", digest: str = "hash", **trigger: object) -> StreamingQuery:
    """Runs the ledger over a streaming DataFrame of observations."""
    run = lambda batch, number: ledger_batch(batch, number, path, keys, seq, digest)
    writer = observations.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
