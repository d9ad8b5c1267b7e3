import random
import re

import numpy as np
import xxhash

from sedimark.llm import simhash


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_sketch(text):
    """The word fingerprint and the wide one of five-word shingles, as whole numbers."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0, 0
    majority = lambda h, bits: sum(1 << b for b in range(bits) if 2 * sum(x >> b & 1 for x in h) > len(h))
    whole, h = 2**64 - 1, [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    shingles = []
    for i in range(max(1, len(h) - 4)):
        x = 0
        for y in h[i : i + 5]:
            x = (x * 0x9E3779B97F4A7C15 + y) & whole
        wide = 0
        for k in range(8):
            y = x ^ ((k + 1) * 0x9E3779B97F4A7C15 & whole)
            y = (y ^ y >> 30) * 0xBF58476D1CE4E5B9 & whole
            wide |= (y ^ y >> 31) << 64 * k
        shingles.append(wide)
    return majority(h, 64), majority(shingles, 512)


def alike(a, b):
    return (a[0] ^ b[0]).bit_count() <= 5 and (a[1] ^ b[1]).bit_count() <= 90


def slow_components(prints, links=lambda a, b: (a ^ b).bit_count() <= 3):
    top = {i: i for i, _ in prints}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in prints:
        for j, b in prints:
            if links(a, b):
                x, y = sorted((root(i), root(j)))
                top[y] = x
    return {i: root(i) for i, _ in prints}


def test_fingerprints_and_components(spark):
    pick = random.Random(3)
    base = [" ".join(pick.choice(["Ab", "ç d", "e\tf", "GH", "ijk", "ß"]) for _ in range(pick.choice([1, 2, 3, 40, 200]))) for _ in range(60)]
    texts = base + base[:10] + [t + " tail" for t in base[:30]] + ["", None, "  \n", "one", "One two"]
    rows = [(i * 3, t, "x") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string")).collect()}
    prints = [(i, slow_print(t)) for i, t, _ in rows]
    assert {i: f"{p:016x}" for i, p in prints} == {i: r.fingerprint for i, r in got.items()}
    assert slow_components(prints) == {i: r.component_id for i, r in got.items()}


def test_links_find_every_pair_within_three_bits_in_small_blocks(spark):
    pick = random.Random(5)
    centre = [pick.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << b for b in pick.sample(range(64), pick.choice([0, 1, 2, 3, 4, 5]))) for c in centre for _ in range(60)}
    signed = [(p - (1 << 64) if p >> 63 else p) for p in prints]
    nodes = spark.createDataFrame([(s, s) for s in signed], "fp long, node long")
    for block in (2048, 5):
        comp = {r.node: r.component for r in simhash.connected_components(simhash.links(nodes, block)).collect()}
        want = slow_components([(s, s & (2**64 - 1)) for s in signed])
        groups = lambda m: sorted(sorted(x for x in m if m[x] == c) for c in set(m.values()))
        assert groups({s: comp.get(s, s) for s in signed}) == groups(want)


def test_nulls_ties_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, None)], "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [(False, 5, None), (False, 5, None), (False, 7, 7), (True, 0, None)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_every_chain_is_found(spark):
    pick = random.Random(11)
    centre = [pick.getrandbits(64) for _ in range(3)]
    for most in (5, 7):
        prints = sorted({c ^ sum(1 << b for b in pick.sample(range(64), pick.choice([0, 2, most - 1, most, most + 1]))) for c in centre for _ in range(50)})
        nodes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, k) for k, p in enumerate(prints)], "fp long, node long")
        want = slow_components(list(enumerate(prints)), lambda a, b: (a ^ b).bit_count() <= most)  # noqa: B023
        for block in (2048, 6):
            comp = {r.node: r.component for r in simhash.connected_components(simhash.links(nodes, block, most)).collect()}
            assert {k: comp.get(k, k) for k in range(len(prints))} == want


def test_every_way_of_comparing_joins_what_all_pairs_join(monkeypatch):
    pick = np.random.default_rng(3)
    base = pick.integers(0, 2**63, 5).astype(np.uint64)
    i, j = np.triu_indices(300, 1)
    real = simhash._near
    for flips in (1, 4):  # dense groups and sparse ones
        fp = base[pick.integers(0, 5, 300)]
        for _ in range(flips):
            fp = fp ^ (np.uint64(1) << pick.integers(0, 64, 300).astype(np.uint64))
        wide = np.where(pick.random((300, 8)) < 0.5, np.uint64(0), np.uint64(2**20 - 1))
        for table in range(6):
            ok = simhash.linked(fp[i], fp[j], np.full(len(i), table), 5) & simhash._agree(wide, i, j)
            want = slow_components([(k, k) for k in range(300)], lambda x, y, p=set(zip(i[ok].tolist(), j[ok].tolist())): (min(x, y), max(x, y)) in p)
            for near in (real, lambda *x: None):  # by near pairs where they are few, and by a walk
                monkeypatch.setattr(simhash, "_near", near)
                a, b = simhash._compare(np.full(300, table << 24), fp, np.arange(300), wide, 5)
                got = slow_components([(k, k) for k in range(300)], lambda x, y, p=set(zip(a.tolist(), b.tolist())) | set(zip(b.tolist(), a.tolist())): (x, y) in p)
                assert got == want and len(a) < 300


def test_similar_texts_against_brute_force(spark):
    pick = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    base = [[pick.choice(words) for _ in range(pick.choice([3, 60, 120, 300]))] for _ in range(30)]
    texts = [" ".join(b) for b in base]
    for b in base:  # copies with a word or a few changed
        for n in (1, 2, 6):
            c = list(b)
            for k in pick.sample(range(len(c)), min(n, len(c))):
                c[k] = pick.choice(words)
            texts.append(" ".join(c).upper())
    rows = [(k * 2, t) for k, t in enumerate(texts)] + [(1001, ""), (1003, None), (1005, texts[3]), (1005, texts[9]), (None, texts[12])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _kept string")
    low = lambda i: -(2**63) if i is None else i
    prints = [(low(i), slow_sketch(t)) for i, t in rows]
    # rows that share an id are one document
    top = slow_components([(k, (p, i)) for k, (i, p) in enumerate(prints)], lambda a, b: a[1] == b[1] or alike(a[0], b[0]))
    least = {}
    for k, (i, _) in enumerate(prints):
        least[top[k]] = min(least.get(top[k], i), i)
    want = {i: least[top[k]] for k, (i, _) in enumerate(prints)}
    for block in (2048, 3):
        assert {r.doc_id: r.component_id for r in simhash.similar(simhash.keyed(df), block).collect()} == want
    kept = simhash.without_near_duplicates(df).collect()
    assert sorted(low(r.doc_id) for r in kept) == sorted(i for i, _ in prints if want[i] == i)
    changed = [(k, 30 + 3 * k) for k, b in enumerate(base) if len(b) >= 120]  # one word of 120 or more
    assert all(want[2 * k] == want[2 * j] for k, j in changed)
    assert simhash.without_near_duplicates(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = " ".join(f"w{k % 5000} v{k}" for k in range(150_000))
    df = spark.createDataFrame([(1, text), (2, text + " end"), (3, "short")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash.similar(simhash.keyed(df)).collect()} == {1: 1, 2: 1, 3: 3}
    assert {r.component_id for r in simhash.near_duplicates(df).collect()} == {1, 3}
