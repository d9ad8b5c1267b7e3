import random

import numpy as np
import zlib

from sedimark.llm import quality


def _rows(n, seed=1):
    pick = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(pick.choice(["th", "er", "on", "an", "re"]) for _ in range(pick.randrange(1, 4))) for _ in range(pick.randrange(20, 90))]
        good = pick.random() < 0.7
        if not good:
            words = [w + pick.choice(["###", "***"]) for w in words] if pick.random() < 0.5 else words[:3] * 20
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = _rows(600)
    docs = spark.createDataFrame([*rows, (None, None, "en", "s"), (9999, "", None, None)], "doc_id long, text string, score string, held_out string")
    got = quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    want = dict(labels)
    assert len(got) == 602
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out and r.doc_id in want]
    assert np.mean([r.predicted == want[r.doc_id] for r in held]) > 0.95


def test_sum_of_squares_identity():
    pick = np.random.default_rng(3)
    size = quality.BUCKETS + len(quality.STATS) * quality.BINS
    model = quality.Model(0.3, pick.normal(size=size), pick.normal(size=(size, quality.RANK)), np.sort(pick.normal(size=(len(quality.STATS), quality.BINS - 1)), 1))
    rows = [quality.features(t, quality._Hashes()) for t in (b"a b c a", b"", b"One TWO three!! | |")]
    where, value, start = model.inputs(rows)
    logit, _ = model.margin(where, value, start)
    for k in range(len(rows)):
        w, x = where[start[k] : start[k + 1]], value[start[k] : start[k + 1]]
        slow = 0.3 + sum(model.linear[w] * x) + sum(model.factors[w[i]] @ model.factors[w[j]] * x[i] * x[j] for i in range(len(w)) for j in range(i))
        assert abs(slow - logit[k]) < 1e-9


def test_without_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.classify(docs, none).collect()] == [0.5, 0.5]
    assert quality.classify(docs.limit(0), none).count() == 0
    assert quality.accepted(docs, none).columns == docs.columns
