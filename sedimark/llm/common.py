"""What the operators share: shared scratch tables, partition counts, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id inside operators, so that keys and joins stay total; given back as null.
NULL_ID = -(2**63)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; without it one of our own, in local mode only."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not set_to:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        set_to = getattr(spark.sparkContext, "_sedimark_scratch", None)
        if not set_to:
            set_to = spark.sparkContext._sedimark_scratch = "file://" + tempfile.mkdtemp(prefix="sedimark-")
    return set_to.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new folder's path; what is written there is deleted when the driver's JVM ends, if not before."""
    path = f"{shared_dir(spark)}/sedimark/{name}-{uuid.uuid4().hex}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path


@contextmanager
def _own_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind: Spark deletes those of a plan when it has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, name)
    with _own_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, n: int, by: str, deal: bool = True) -> DataFrame:
    """The rows as a table in the shared folder, one file for each of ``n`` hash buckets of ``by``, sorted by it.

    Joins and groupings on ``by`` then need no exchange of this side. drop_written() forgets the table too.
    deal: False where the rows already lie in ``n`` hash partitions of ``by``, as a grouping or join by it leaves them.
    """
    spark = df.sparkSession
    table = f"sedimark_{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(n, by).sortWithinPartitions(by) if deal else df
    with _own_shuffles(spark):
        dealt.write.format("parquet").option("compression", "zstd").option("path", new_path(spark, name)).bucketBy(n, by).sortBy(by).saveAsTable(table)
    held = spark.table(table)
    held._sedimark_table = table
    return held


def drop_written(spark: SparkSession, df: DataFrame) -> None:
    """Deletes a table of written() or bucketed() that no later plan reads."""
    files = df.inputFiles()[:1]
    if table := getattr(df, "_sedimark_table", None):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for file in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with nulls replaced; only these columns of a wider table are read."""
    return docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )


def given_back(name: str = "doc_id"):
    """The outward form of an internal id column."""
    return F.when(F.col(name) != NULL_ID, F.col(name)).alias(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    while name in df.columns:
        name += "_"
    return name


def groups_for(total_bytes: int, per_group: int) -> int:
    return max(1, -(-int(total_bytes or 0) // per_group))


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and its n + 1 offsets; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The values as UTF-8 bytes; nulls count as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def portions(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one portion holds about ``most`` bytes of ``column`` (a single longer value stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = raw(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last
