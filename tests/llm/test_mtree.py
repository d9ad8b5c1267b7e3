import math
import random

import numpy as np

from sedimark.llm import mtree


def slow(rows, k=5, every=50):
    rows = [(i, e) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    whole = [(i, [math.floor(256 * x) for x in e]) for i, e in rows]
    out = []
    for q in sorted({i for i, _ in whole if i % every == 0}):
        found = [(-sum(a * b for a, b in zip(e, f)), j) for i, e in whole if i == q for j, f in whole if j != q]
        out += [(q, r, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(sorted(found)[:k], 1)]
    return out


def _rows(seed, n, wide=8):
    pick = random.Random(seed)
    rows = [(i, [pick.gauss(0, 0.3) for _ in range(wide)]) for i in range(n)]
    for i in range(0, n, 3):
        rows[i] = (i, rows[1][1])  # one vector held by a third of the rows
    return rows


def test_equals_brute_force(spark):
    rows = _rows(1, 700) + [(-50, [0.1] * 8), (9000, None), (9050, [1.0, None]), (9100, [float("nan")] * 8), (9150, []), (9200, [0.5]), (7, [0.9] * 8), (7, [0.9] * 8), (100, [0.7] * 8), (100, [0.7] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<double>, score int")
    for least, most in ((8192, 1 << 16), (100, 1 << 16), (10, 40)):
        got = sorted(tuple(r) for r in mtree.search(df, least=least, most=most).collect())
        assert got == sorted(slow(rows))
    assert mtree.search(df.limit(0)).count() == 0


def test_large_scores_and_few_rows(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [2e30, 0.0]), (3, [-1e30, 0.0]), (4, [-3e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in mtree.search(df).collect()) == slow(rows)
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<double>")
    assert mtree.search(one).count() == 0


def test_several_vectors_of_the_query_id(spark):
    rows = [(0, [3.0 + k, 0.0]) for k in range(3)] + [(i, [1.0 + i / 100, 0.1]) for i in range(1, 21)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in mtree.search(df).collect()) == slow(rows)
    tree = mtree.Tree(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]) * 256)
    assert [i for _, i in tree.top(np.array([768.0, 0.0]), 0, 5)[0]] == [20, 19, 18, 17, 16]


def test_bounds_save_products():
    pick = np.random.default_rng(2)
    centre = pick.normal(0, 300, (20, 16))
    vectors = np.floor(centre[pick.integers(0, 20, 4000)] + pick.normal(0, 10, (4000, 16)))
    tree = mtree.Tree(np.arange(4000), vectors, 64)
    taken = [tree.top(vectors[i], i, 5)[1] for i in range(0, 4000, 100)]
    assert np.mean(taken) < 0.5 * 4000
    for node, kids in enumerate(tree.children):
        for c in kids:
            assert abs(tree.parent_distance[c] - np.sqrt(((tree.routing[c] - tree.routing[node]) ** 2).sum())) < 1e-9


def test_a_tree_comes_back_from_its_bytes_and_a_floor_cuts_nothing_it_needs():
    pick = np.random.default_rng(4)
    vectors = np.floor(pick.normal(0, 100, (1500, 8)))
    vectors[::3] = vectors[1]
    tree = mtree.Tree(np.arange(1500), vectors)
    again = mtree.Tree.load(tree.dump())
    for i in range(0, 1500, 70):
        want = tree.top(vectors[i], i, 5)
        assert again.top(vectors[i], i, 5) == want
        cut, taken = again.top(vectors[i], i, 5, want[0][-1][0])
        assert cut == want[0] and taken <= want[1]
    some = np.arange(0, 1500, 70)
    wants = [tree.top(vectors[i], i, 5)[0] for i in some]
    for low in (0, 500):  # with the k-th score itself as the floor, and with a lower one
        assert tree.sweep(vectors[some], some, 5, np.array([w[-1][0] - low for w in wants], float)) == wants
    assert tree.sweep(vectors[some], some, 5, np.array([w[0][0] + 1 for w in wants], float)) == [[]] * len(some)
    large = mtree.Tree(np.arange(2), np.array([[10**40, 1], [-(10**40), 2]], object))
    assert (mtree.Tree.load(large.dump()).vectors == large.vectors).all()


def test_equals_the_sql_with_repeated_rows(spark):
    import duckdb
    import pandas as pd

    rows = [(i, [float(x) for x in e]) for i, e in _rows(6, 150, 4)]
    rows += rows[:4] + [(0, rows[5][1]), (50, rows[7][1]), (1, [9.0, 0.0, 0.0, 0.0])]
    base = duckdb.connect()
    base.register("embeddings", pd.DataFrame({"vec_id": [r[0] for r in rows], "embedding": [r[1] for r in rows]}))
    got = mtree.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), least=20).collect()
    assert sorted(tuple(r) for r in got) == sorted(base.execute(mtree.ORACLE).fetchall())
