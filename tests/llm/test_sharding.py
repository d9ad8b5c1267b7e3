import random
import zlib

import pytest

from sedimark.llm import sharding


def best_capacity(sizes, shards):
    def fits(c):
        used, now = 1, 0
        for s in sizes:
            if s > c:
                return False
            if now + s > c:
                used, now = used + 1, 0
            now += s
        return used <= shards

    return next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("seed,hot", [(1, 0), (2, 40), (3, 3)])
def test_minimax_against_brute_force(spark, seed, hot):
    pick = random.Random(seed)
    rows = [(pick.randrange(10_000), "".join(pick.choice("aä ") for _ in range(pick.randrange(0, 60)))) for _ in range(90)]
    rows += [(pick.randrange(10_000), "the same text") for _ in range(hot)] + [(None, None), (77, ""), (77, "q"), (77, "q")]
    pick.shuffle(rows)
    df = spark.createDataFrame([(*r, 9, "y") for r in rows], "doc_id long, text string, shard int, key string")
    got = sharding.shard(df).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.size, r.text_crc32) for r in got) == sorted((i is None, i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    low = lambda i: -(2**63) if i is None else i
    groups = {}
    for i, t in rows:
        g = groups.setdefault(t or "", [low(i), 0])
        groups[t or ""] = [min(g[0], low(i)), g[1] + len((t or "").encode()) + 1]
    firsts = [g[0] for g in groups.values()]
    sizes = [g[1] for g in sorted(groups.values())]
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 8
    assert {c: len({x.shard for x in got if x.text_crc32 == c}) for c in {x.text_crc32 for x in got}} == {c: 1 for c in {x.text_crc32 for x in got}}
    if len(set(firsts)) == len(firsts):
        assert max(sum(r.size for r in rs) for rs in by.values()) == best_capacity(sizes, 8)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "d")], "doc_id long, text string")
    assert sorted(r.size for r in sharding.shard(df).collect()) == [2, 4]
    assert sharding.shard(df.limit(0)).count() == 0
    assert "Python" not in sharding.shard(df)._jdf.queryExecution().toString()


class _Listed(sharding.Boundaries):
    """Boundaries over a list; counts the look-ups."""

    def __init__(self, sizes):
        self.sums = [sum(sizes[: i + 1]) for i in range(len(sizes))]
        self.total, self.largest, self.jobs = sum(sizes), max(sizes), 0

    def around(self, limits):
        self.jobs += 1
        limits = [min(max(x, 0), self.total) for x in limits]
        return [(max([0, *(b for b in self.sums if b <= x)]), 0 if x == 0 else min(b for b in self.sums if b >= x)) for x in limits]

    def count_between(self, stretches):
        return len(self.between(stretches))

    def between(self, stretches):
        return sorted({0, *(b for b in self.sums if any(low <= b <= high for low, high in stretches))})


def test_capacity_with_and_without_reading_the_rest():
    pick = random.Random(9)
    for n in (1, 5, 8, 40, 300):
        for top in (3, 1000, 10**6):
            sizes = [pick.randrange(1, top) for _ in range(n)]
            if n == 40:
                sizes[7] = sum(sizes)
            for known in (0, 10, 10**6):
                at = _Listed(sizes)
                got = sharding.smallest_capacity(at, 8, known)
                ends = sharding._fill(at, 8, [got, got - 1])
                assert ends[0][-1] == at.total and (ends[1][-1] < at.total or got == max(-(-at.total // 8), at.largest))
                placed = [0, *sharding.cuts(at, 8, got), at.total]
                assert max(b - a for a, b in zip(placed, placed[1:])) <= got and placed == sorted(placed)


def test_very_long_texts(spark):
    rows = [(k, "x" * (3 << 20) + str(k)) for k in range(9)] + [(100 + k, "y") for k in range(30)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    load = [sum(r.size for r in got if r.shard == k) for k in range(8)]
    assert len(got) == 39 and max(load) < 2.1 * (3 << 20) and min(load) > 3 << 20


def test_equals_the_law_in_sql(spark):
    """size, groups and gapless slots, by DuckDB over the result."""
    import duckdb

    pick = random.Random(5)
    rows = [(i, "".join(pick.choice("abc ") for _ in range(pick.randrange(40)))) for i in range(300)] + [(1000 + i, "copies of one text") for i in range(150)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()  # noqa: F841
    base = duckdb.connect()
    assert base.execute("SELECT count(*) FROM (SELECT text_crc32, size FROM found GROUP BY ALL HAVING count(DISTINCT shard) > 1)").fetchone() == (0,)
    assert base.execute("SELECT count(*) FROM (SELECT shard FROM found GROUP BY shard HAVING min(slot) <> 0 OR max(slot) <> count(*) - 1 OR count(DISTINCT slot) <> count(*))").fetchone() == (0,)
    total = sum(len(t) + 1 for _, t in rows)
    assert base.execute("SELECT max(s) FROM (SELECT sum(size) AS s FROM found GROUP BY shard)").fetchone()[0] == 150 * 19 and total > 150 * 19
