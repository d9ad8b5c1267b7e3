"""Minimax contiguous partition of ordered atomic groups into shards, in DataFrame operations only.

Documents of equal text are one atomic group; groups are ordered by their smallest doc_id. The partition cuts that
order into contiguous shards so that the largest shard is as small as can be: the smallest feasible capacity is found
by binary search, several capacities a round, each checked greedily. A greedy check needs only, for each shard, the
last group boundary within reach, which is one aggregate over the rows of the sorted table of running sums that lie near
it; nothing but these boundaries, and at last no more than ``KNOWN`` others, reaches the driver. Within that capacity the
cuts are then set nearest to equal sizes, so that no shard stays empty behind greedily filled ones.

Running sums come from range partitions: a sum for each partition, added to a window within each.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimark.llm.common import NULL_ID, given_back, written

SHARDS = 8
#: Capacities that one round of the search checks together.
PROBES = 24
#: Most boundaries that the driver reads to end the search.
KNOWN = 100_000


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key): what a document weighs, and the digest that equal texts share."""
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    return docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
    )


def ranged(df: DataFrame, *order: str, name: str) -> DataFrame:
    """The rows range-partitioned by ``order``, with the partition's number as ``pid``, as a written table."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()), name)


def running(df: DataFrame, weight: Column, order: list[str], within: list[str]) -> DataFrame:
    """``df``, as ranged() gives it, with ``upto``: the sum of ``weight`` up to and with each row, apart for each value of ``within``.

    What goes to every task is one row for each partition and value of ``within``.
    """
    df = df.withColumn("_w", weight)
    part = df.groupBy("pid", *within).agg(F.sum("_w").alias("_sum"))
    before = Window.partitionBy(*within).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("pid", *within, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("pid", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_in", F.sum("_w").over(inside)).join(F.broadcast(part), ["pid", *within]).withColumn("upto", F.col("_before") + F.col("_in")).drop("_w", "_in", "_before")


class Boundaries:
    """Looks up group boundaries (running sums, and 0) in the table of groups.

    Every look-up reads only rows near its limits: the table is sorted by ``upto``, so Parquet's statistics prune the rest.
    """

    def __init__(self, sums: DataFrame, total: int, largest: int):
        self.sums, self.total, self.largest = sums.select("upto"), total, largest

    def _near(self, limits: list[int]) -> DataFrame:
        """A boundary lies at most ``largest`` from any limit within the total; overlapping stretches are joined."""
        stretches: list[list[int]] = []
        for x in sorted(limits):
            low, high = x - self.largest, x + self.largest
            if stretches and low <= stretches[-1][1]:
                stretches[-1][1] = high
            else:
                stretches.append([low, high])
        within = F.lit(False)
        for low, high in stretches:
            within = within | F.col("upto").between(low, high)
        return self.sums.where(within)

    def around(self, limits: list[int]) -> list[tuple[int, int]]:
        """For each limit the largest boundary not above it and the smallest not below it (the total at most)."""
        limits = [min(max(x, 0), self.total) for x in limits]
        each = []
        for i, x in enumerate(limits):
            each += [F.max(F.when(F.col("upto") <= x, F.col("upto"))).alias(f"a{i}"), F.min(F.when(F.col("upto") >= x, F.col("upto"))).alias(f"b{i}")]
        got = self._near(limits).agg(*each).first()
        return [(got[2 * i] or 0, 0 if x == 0 else got[2 * i + 1]) for i, x in enumerate(limits)]

    def count_between(self, stretches: list[tuple[int, int]]) -> int:
        return self._within(stretches).count()

    def between(self, stretches: list[tuple[int, int]]) -> list[int]:
        """The boundaries from low to high of each stretch, in order; the caller has counted them."""
        return sorted({0, *(r[0] for r in self._within(stretches).collect())})

    def _within(self, stretches: list[tuple[int, int]]) -> DataFrame:
        within = F.lit(False)
        for low, high in stretches:
            within = within | F.col("upto").between(low, high)
        return self.sums.where(within)


def _fill(at: Boundaries, shards: int, capacities: list[int]) -> list[list[int]]:
    """Where greedily filled shards of each capacity end: one job a shard for all capacities."""
    ends = [[0] for _ in capacities]
    for _ in range(shards):
        for own, (end, _) in zip(ends, at.around([e[-1] + c for e, c in zip(ends, capacities)])):
            own.append(end)
        if all(e[-1] == at.total for e in ends):
            break
    return [e + [at.total] * (shards + 1 - len(e)) for e in ends]


def smallest_capacity(at: Boundaries, shards: int, known: int = KNOWN) -> int:
    """The least capacity with which filling shards greedily needs no more than ``shards``.

    Each round fills shards by several capacities at once and narrows the search between the largest that fails and the
    smallest that does. Ends only grow with the capacity, so those still open lie between the ends of these two; once
    no more than ``known`` boundaries lie there, they are read and the rest of the search needs no jobs.
    """
    low, high = max(-(-at.total // shards), at.largest), at.total // shards + at.largest  # the upper one always suffices
    high = max(low, high)
    below, above = low - 1, high
    while low < high:
        step = max(1, (high - low) // (PROBES + 1))
        tried = sorted({min(high - 1, low + step * i) for i in range(PROBES)} | {low, high})
        ends = dict(zip(tried, _fill(at, shards, tried)))
        good = [c for c in tried if ends[c][-1] == at.total]
        bad = [c for c in tried if ends[c][-1] < at.total]
        high, below = min(good), max(bad, default=below)
        low, above = below + 1, high
        if low < high:
            stretches = list(zip(ends[below][1:], ends[above][1:])) if below in ends else []
            if stretches and at.count_between(stretches) <= known:
                held = at.between(stretches)
                while low < high:
                    middle, end = (low + high) // 2, 0
                    for _ in range(shards):
                        end = held[bisect.bisect_right(held, end + middle) - 1]
                    low, high = (low, middle) if end == at.total else (middle + 1, high)
    return high


def cuts(at: Boundaries, shards: int, capacity: int) -> list[int]:
    """The last boundary of each shard but the final one: nearest to equal sizes, with no shard over ``capacity``."""
    least = [at.total]  # least[k]: the earliest boundary from which k shards still hold the rest
    for _ in range(shards - 1):
        least.append(at.around([least[-1] - capacity])[0][1])
    out, end = [], 0
    for left in range(shards, 1, -1):
        low, high = max(end, least[left - 1]), end + capacity
        aim = min(max(end + round((at.total - end) / left), low), high)
        down, up = at.around([aim])[0]
        down = max(low, down)
        end = up if up <= high and up - aim < aim - down else down
        out.append(end)
    return out


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    size: UTF-8 bytes of the text (null: none) plus 1. law: ``bytes``. slot: gapless from 0 in each shard, in the
    order of doc_id, then checksum. grown_shard: null under this law. Null and empty text are equal texts. A null
    doc_id counts as the smallest; rows with equal ids keep separate slots. One group may exceed a fair share: then
    the capacity is that group's size. Other columns are ignored; an empty table gives an empty result.
    """
    rows = written(sized(docs), "sized")
    groups = ranged(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.min("doc_id").alias("first")), "first", "key", name="groups")
    sums = running(groups, F.col("bytes"), ["first", "key"], [])
    sums = written(sums.repartitionByRange("upto").sortWithinPartitions("upto"), "sums")
    total, largest = sums.agg(F.sum("bytes"), F.max("bytes")).first()
    placed = []
    if total:
        at = Boundaries(sums, total, largest)
        placed = cuts(at, shards, smallest_capacity(at, shards))
    of = sum(((F.col("upto") > c).cast("int") for c in placed), F.lit(0))
    held = rows.join(sums.select("key", of.alias("shard")), "key").drop("key")
    order = ["doc_id", "text_crc32", "size"]
    slots = running(ranged(held, *order, name="held"), F.lit(1).cast("long"), order, ["shard"])
    return slots.select(given_back(), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("upto") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
