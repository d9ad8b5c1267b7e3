"""The append-only revision ledger, as window expressions over observations.

Input: observations (posting keys, seq, hash). For each posting in the order of seq, an observation is OBSERVED (its
first content), CHANGED (content not seen before), UNCHANGED (the current content), or REJECTED (content that was
current earlier but is not now: a revision is unique by its content, so going back fails). With
``revert_policy='new_revision'``, an extension, going back makes a new revision instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lifecycle(observations: DataFrame, keys: Sequence[str], seq: str = "seq", digest: str = "hash", revert_policy: str = "reject") -> DataFrame:
    """``observations`` with state, revision_no (the current one after it) and current_hash."""
    whole = Window.partitionBy(*keys).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if revert_policy == "new_revision":
        new = ~F.lag(digest).over(Window.partitionBy(*keys).orderBy(seq)).eqNullSafe(F.col(digest)) | (F.row_number().over(Window.partitionBy(*keys).orderBy(seq)) == 1)
    elif revert_policy == "reject":
        new = F.row_number().over(Window.partitionBy(*keys, digest).orderBy(seq)) == 1
    else:
        raise ValueError(f"unknown revert_policy {revert_policy!r}")
    out = observations.withColumn("_new", new)
    out = out.withColumn("revision_no", F.sum(F.col("_new").cast("long")).over(whole))
    out = out.withColumn("current_hash", F.last(F.when(F.col("_new"), F.col(digest)), ignorenulls=True).over(whole))
    state = (
        F.when(F.col("_new") & (F.col("revision_no") == 1), "OBSERVED")
        .when(F.col("_new"), "CHANGED")
        .when(F.col(digest).eqNullSafe(F.col("current_hash")), "UNCHANGED")
        .otherwise("REJECTED")
    )
    return out.withColumn("state", state).drop("_new")


def revisions(states: DataFrame) -> DataFrame:
    """The accepted observations: one row for each revision."""
    return states.where(F.col("state").isin("OBSERVED", "CHANGED"))


def current_revisions(states: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """Each posting's last accepted revision, with first and last successful observation."""
    accepted = F.col("state").isin("OBSERVED", "CHANGED")
    return states.where("state <> 'REJECTED'").groupBy(*keys).agg(
        F.max(F.when(accepted, F.col("revision_no"))).alias("revision_no"),
        F.max_by("hash", F.when(accepted, F.col(seq))).alias("hash"),
        F.min(seq).alias("first_seq"),
        F.max(seq).alias("last_seq"),
    )


def changed_fields(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """Names of the fields, sorted, whose values differ; nulls are equal to each other."""
    names = sorted({*before, *after})
    none = F.lit(None)
    return F.filter(F.array(*[F.when(~before.get(n, none).eqNullSafe(after.get(n, none)), F.lit(n)) for n in names]), lambda x: x.isNotNull())


def preview(text: Column, most: int = 500) -> Column:
    return F.left(text, F.lit(most))


#: Rows that a task of append_new() sorts and hashes where it is told how many there are.
TASK_ROWS = 1_000_000


def append_new(existing: DataFrame, new: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """The rows of ``new`` whose keys ``existing`` lacks, once each: what an insert that ignores conflicts adds.

    ``rows``: about how many rows ``new`` has, where it can have many more than its input. There are then as many tasks
    as keep each one's memory the same; Spark's setting is a fixed number of them.
    """
    if rows is not None:
        n = max(int(new.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))
        existing, new = existing.select(*keys).repartition(n, *keys), new.repartition(n, *keys)
    return new.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")


def latest(events: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last event of each key: what an upsert leaves."""
    rest = [c for c in events.columns if c not in keys]
    best = events.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return best.select(*keys, *[F.col("_last")[c].alias(c) for c in rest])


def assign_ids(existing: DataFrame, new: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """New rows with ids that follow the largest one in use, in ``order``."""
    from sedimark.operators.scratch import global_rank

    top = existing.agg(F.coalesce(F.max(name), F.lit(0)).alias("_top"))
    return global_rank(new, order, "_n").join(F.broadcast(top)).withColumn(name, F.col("_top") + F.col("_n")).drop("_top", "_n")
