import hashlib
import random

import numpy as np
import pyarrow as pa

from sedimark.llm import suffixdedup as sd


def slow(rows):
    low = lambda i: -(2**63) if i is None else i
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], low(i)), low(i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < low(i):
                gone[k : k + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_smaller_neighbours():
    pick = random.Random(2)
    for n in (1, 2, 50, 300):
        x = [pick.randrange(12) for _ in range(n)]
        before, after = sd.smaller_neighbours(np.array(x))
        for i in range(n):
            assert before[i] == max((j for j in range(i) if x[j] < x[i]), default=-1)
            assert after[i] == min((j for j in range(i + 1, n) if x[j] < x[i]), default=n)


def test_every_window_has_one_minimizer():
    pick = random.Random(3)
    for text in (b"ab" * 60 + bytes(range(200)) + b"\0" * 90, bytes(pick.choice(b"abc") for _ in range(3000))):
        h, at, first, last = sd._minimizers(np.frombuffer(text, np.uint8))
        assert first[0] == 0 and last[-1] == len(text) - sd.SPAN and (first[1:] == last[:-1] + 1).all()
        assert ((first <= at) & (last <= at) & (at <= first + sd.REACH)).all()
        of = {}
        for x, a, i, j in zip(h.tolist(), at.tolist(), first.tolist(), last.tolist()):
            for s in range(i, j + 1):  # equal windows have equal minimizers at equal places
                assert of.setdefault(text[s : s + sd.SPAN], (x, a - s)) == (x, a - s)


def test_a_long_text_is_taken_in_steps():
    pick = random.Random(3)
    text = np.array([pick.choice(b"abc ") for _ in range(5000)] + [122] * 400, np.uint8)
    whole = sd._minimizers(text)
    for step in (200, 333, 5000):
        assert all(np.array_equal(x, np.concatenate(y)) for x, y in zip(whole, zip(*sd.minimizers(text, step))))


def test_matches_brute_force(spark):
    pick = random.Random(7)
    word = lambda n: "".join(pick.choice("abcdé ") for _ in range(n))
    shared = [word(n) for n in (49, 50, 51, 80, 300, 700)] + ["z" * 400, "xy" * 100]
    rows = []
    for i in range(120):
        rows.append((pick.randrange(90), "".join(pick.choice(shared) if pick.random() < 0.4 else word(pick.randrange(120)) for _ in range(pick.randrange(5)))))
    rows += [(None, shared[3]), (200, None), (201, ""), (202, shared[5]), (203, shared[5]), (203, shared[5]), (204, "z" * 49), (205, "q" * 60 + "z" * 60), (206, "\0" * 70), (207, "\0" * 55)]
    df = spark.createDataFrame([(*r, "s", 4) for r in rows], "doc_id long, text string, kept string, n_bytes int")
    for bytes_, hot in ((sd.GROUP, sd.HOT), (3000, 2)):
        got = [tuple(r) for r in sd.digests(sd.remove_repeats(df, bytes_, hot)).collect()]
        assert sorted(got, key=str) == slow(rows)
    assert sd.remove_repeats(df.limit(0)).count() == 0


def test_previous_factors_are_exact():
    pick = np.random.default_rng(5)
    for n in (1, 2, 40, 200):
        text = pick.integers(97, 99, (n, 12)).astype(np.uint8)
        doc = pick.integers(0, 9, n)
        lcp = lambda a, b: next((k for k in range(12) if a[k] != b[k]), 12)
        want = [max((lcp(text[i], text[j]) for j in range(n) if doc[j] < doc[i]), default=0) for i in range(n)]
        assert sd.previous_factors(text, doc).tolist() == want


def _group(*rows):
    none = pa.table({"kind": pa.array([], pa.int32()), "x": pa.array([], pa.int64()), "y": pa.array([], pa.int64()), "places": pa.array([], pa.binary())})
    return (pa.scalar(0),), pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "sha8": [0] * len(rows)}), none


def _shared(hashes, hot):
    order = np.argsort(hashes.column("h").to_numpy())
    return pa.Table.from_batches(sd._shared_hashes(hot)(iter(hashes.take(pa.array(order)).combine_chunks().to_batches(7))))


def test_occurrences_in_a_document_make_a_hash_hot_and_equal_contexts_travel_once():
    key, docs, none = _group((1, b"z" * 400), (2, b"z" * 400 + b"q"))
    hashes = sd._gather_hashes(key, docs, none)
    for hot, want in ((600, True), (100_000, False)):
        shared = _shared(hashes, hot)
        assert (shared.column("y").to_numpy() > 0).any() == want
        assert sd._contexts(key, docs, shared.drop_columns("grp")).num_rows < 150


def test_a_minimizer_with_very_many_occurrences_in_one_group():
    rows = [(k, b"a shared passage of some sixty bytes that all of the rows hold, " * 3 + str(k).encode() * 12) for k in range(20_000)]
    key, docs, none = _group(*rows)
    hashes = sd._gather_hashes(key, docs, none)
    assert max(hashes.column("held").to_numpy() >> 1) >= 40_000
    contexts = sd._contexts(key, docs, _shared(hashes, 5000).drop_columns("grp"))
    assert contexts.num_rows < 20 * 20_000 and max(len(p) for p in contexts.column("places").to_pylist()) >= 12 * 20_000


def test_very_long_texts_of_one_letter_take_bounded_memory():
    import tracemalloc

    size = 20 << 20
    key, docs, none = _group((1, b"-" * size), (2, b"-" * (size - 7) + b" " * 7))
    tracemalloc.start()
    hashes = sd._gather_hashes(key, docs, none)
    contexts = sd._contexts(key, docs, _shared(hashes, sd.HOT).drop_columns("grp"))
    assert tracemalloc.get_traced_memory()[1] < 1 << 30
    tracemalloc.stop()
    assert contexts.num_rows < 1000 and sum(len(p) for p in contexts.column("places").to_pylist()) < 100_000


def test_runs_end_where_hashes_end():
    pick = random.Random(4)
    h = sorted(pick.randrange(30) for _ in range(500))
    batches = pa.table({"h": h}).to_batches(9)
    got = [t.column("h").to_pylist() for t in sd._runs(iter(batches))]
    assert sum(got, []) == h and all(a[-1] != b[0] for a, b in zip(got, got[1:]))


def test_names_that_clash(spark):
    rows = [(1, "x" * 60, "a", "b", 3, 60), (2, "x" * 60 + "é", "c", "d", 4, 61), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, kept string, own_kept string, n_bytes int, n_chars int")
    got = sorted((tuple(r) for r in sd.without_repeats(df).collect()), key=str)
    assert got == sorted([(1, "x" * 60, "a", "b", 3, 60), (2, "é", "c", "d", 4, 1), (None, "", None, None, None, 0)], key=str)
