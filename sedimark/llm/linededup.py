"""Line deduplication over levelled sorted runs of line hashes.

A run is a table of (key, n, top): a line key's hash, in how many documents it was found, and the largest doc_id that
holds it, bucketed and sorted by key. Runs live in levels: each batch of documents adds one run to level 0, and when a
level holds ``fan`` runs they are merged into one run of the next level. A new batch first merge-anti-joins the runs:
keys whose fate is already settled are not added again. Settled means found in ``min_docs`` documents, all with larger
ids than the batch can hold; batches therefore come in falling order of doc_id. All runs have the same buckets, so the
anti-join and the merges read them as they lie, without an exchange.

A document is a doc_id: rows that share one are one document, with all their lines. A line's key is the line without
ASCII white space at its ends and with A-Z lower-cased.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.llm.common import NULL_ID, bucketed, drop_written, free_name, keyed, portions, texts, written

MIN_CHARS, MIN_DOCS, FAN = 20, 3, 2
#: Fewest batches, and the number of lines from which on each doubling adds one more.
BATCHES, LINES = 4, 1 << 22
_BLANK = b" \t\n\x0b\x0c\r"
RUN = "key binary, n long, top long"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The 16-byte hash of a line's key, or None for a key of under ``min_chars`` code points."""
    key = line.strip(_BLANK).lower()
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key): every long line key once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text"):
            ids, keys = [], []
            for i, text in zip(part.column("doc_id").to_pylist(), texts(part.column("text"))):
                own = {k for line in text.split(b"\n") if (k := line_key(line, min_chars))}
                ids += [i] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    return docs.mapInArrow(run, "doc_id long, key binary")


def batches_for(lines: int) -> int:
    """How many batches ``lines`` keys come in: one more for each doubling."""
    return BATCHES + max(0, (lines // LINES).bit_length())


class LineRuns:
    """The levels of runs; every run is a bucketed table in the shared folder."""

    def __init__(self, spark: SparkSession, fan: int = FAN):
        self.spark, self.fan, self.levels = spark, fan, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def entries(self) -> DataFrame:
        """(key, n, top) over all runs."""
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], RUN)
        return self._merged(runs) if len(runs) > 1 else runs[0]

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """One row for each key of sorted runs: a chain of merge joins, which keeps the buckets and the order."""
        out = runs[0]
        for run in runs[1:]:
            other = run.select(F.col("key").alias("_key"), F.col("n").alias("_n"), F.col("top").alias("_top"))
            both = out.hint("merge").join(other, out["key"] == other["_key"], "full")
            zero = F.lit(0).cast("long")
            n = F.coalesce("n", zero) + F.coalesce("_n", zero)
            out = both.select(F.coalesce("key", "_key").alias("key"), n.alias("n"), F.greatest("top", "_top").alias("top"))
        return out

    def add(self, batch: DataFrame, min_docs: int = MIN_DOCS) -> None:
        """Adds a batch of (doc_id, key), which may repeat."""
        run = batch.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("top"))
        for held in self.runs():  # a key settled by one run alone, or by several together
            settled = held.where(F.col("n") >= min_docs).select(F.col("key").alias("_key"), F.col("top").alias("_top"))
            run = run.join(settled.hint("merge"), (F.col("key") == F.col("_key")) & (F.col("top") <= F.col("_top")), "left_anti")
        self._put(0, run)

    def _put(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(bucketed(run, f"run{level}", self.buckets, "key", deal=False))
        if len(self.levels[level]) >= self.fan:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merged(full))
            for old in full:
                drop_written(self.spark, old)

    def drop(self) -> None:
        for run in self.runs():
            drop_written(self.spark, run)


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, fan: int = FAN) -> DataFrame:
    """(doc_id, keys): for each document that loses lines, the key hashes it loses. docs: as keyed() gives them."""
    spark = docs.sparkSession
    keys = written(line_keys(docs, min_chars), "linekeys")
    if batches is None:
        batches = batches_for(keys.count())
    cuts = keys.select(F.percentile_approx("doc_id", [k / batches for k in range(1, batches)], 1000)).first()[0] or []
    runs = LineRuns(spark, fan)
    bounds = [None, *sorted(set(cuts)), None]
    for low, high in reversed(list(zip(bounds, bounds[1:]))):  # falling doc_id
        batch = keys
        batch = batch if low is None else batch.where(F.col("doc_id") > low)
        batch = batch if high is None else batch.where(F.col("doc_id") <= high)
        runs.add(batch, min_docs)
    # a table of its own: Spark then splits a key that many documents share
    dropped = written(runs.entries().where(F.col("n") >= min_docs).select("key", "top"), "dropped")
    runs.drop()
    lost = keys.join(dropped, "key").where("doc_id < top")
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None, fan: int = FAN) -> DataFrame:
    """``docs`` with the text of every row, in place, less the lines repeated across documents.

    Two columns are added, ``n_lines`` and ``n_dropped`` (replaced where the table has such columns); n_chars, where
    the table has it, follows the text. Lines are cut at \\n. A key of at least ``min_chars`` code points found in at
    least ``min_docs`` documents keeps its lines only in the largest doc_id that holds it; the other lines are joined
    by \\n, and a document that loses all has the empty text. Null or empty text: one empty line, kept; the text
    becomes empty. Rows that repeat a doc_id are one document: a key counts once however many of them hold it, and they
    keep or lose its lines together; each row gives a row. Rows of null doc_id are one document too, of the smallest
    id, and it stays null. An empty table gives an empty result.
    """
    base = docs.drop("n_lines", "n_dropped")
    lost = repeated_lines(keyed(docs), min_chars, min_docs, batches, fan)
    id_, keys_ = free_name(base, "_id"), free_name(base, "_keys")
    rows = base.withColumn("text", F.coalesce("text", F.lit(""))).withColumn(id_, F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)))
    both = rows.join(lost.select(F.col("doc_id").alias(id_), F.col("keys").alias(keys_)), id_, "left").drop(id_)
    names = base.columns
    chars = "n_chars" in names

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(parts, "text"):
            out: list[list] = [[], [], []]
            for text, keys in zip(texts(part.column("text")), part.column(keys_).to_pylist()):
                lines = text.split(b"\n")
                gone = set(keys or ())
                kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                out[0].append(len(lines))
                out[1].append(len(lines) - len(kept))
                out[2].append(b"\n".join(kept))
            columns = {n: part.column(n) for n in names}
            columns["text"] = pa.array(out[2], pa.binary()).cast(columns["text"].type)
            if chars:
                columns["n_chars"] = pc.utf8_length(columns["text"]).cast(columns["n_chars"].type)
            columns |= {"n_lines": pa.array(out[0], pa.int64()), "n_dropped": pa.array(out[1], pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    added = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    return both.mapInArrow(run, T.StructType([*base.schema.fields, *added]))


def digests(deduped: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256): the result of dedup_lines() with the text as its SHA-256."""
    return deduped.select(F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: A document is a doc_id, null the smallest; every row gives a row.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS id, string_split(coalesce(text, ''), chr(10)) AS all_lines FROM documents
), lines AS (
  SELECT r, doc_id, id, unnest(all_lines) AS line, generate_subscripts(all_lines, 1) AS pos FROM docs
), keys AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), found AS (
  SELECT key, max(id) AS top FROM keys WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT id) >= 3
), marked AS (
  SELECT k.r, k.doc_id, k.line, k.pos, coalesce(k.id < f.top, false) AS gone FROM keys k LEFT JOIN found f ON k.key = f.key
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
