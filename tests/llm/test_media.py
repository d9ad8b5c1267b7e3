import hashlib
import random
import zlib

import numpy as np

from sedimark.llm import media


def test_round_trip(spark):
    pick = random.Random(6)
    texts = ["", None, "a", "x" * 192, "y" * 193, "ß中\U0001f600" * 70, " " * 500, "\0" * 10, "word " * 9000]
    texts += ["".join(pick.choice("etaoin shrdlu\né") for _ in range(pick.randrange(9000))) for _ in range(12)]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, texts[4], 0), (4, texts[4], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, feature int")
    got = media.round_trip(df).collect()
    assert len(got) == len(rows)
    for r in got:
        b = (texts[4 if r.doc_id is None else r.doc_id] or "").encode()
        payload = b + b" " * (max(192, -(-len(b) // 192) * 192) - len(b))
        stored = media.store(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0][0]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(b), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:])
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        own = media.Summary()
        own.add(stored, np.frombuffer(payload, np.uint8).reshape(-1, 64, 3))
        assert r.feature == media.features(own.counts[None], own.columns[None])[0]
    assert len({tuple(r)[1:] for r in got if r.doc_id in (None, 4)}) == 1
    assert media.round_trip(df.limit(0)).count() == 0
    long = next(r for r in got if r.doc_id == 8)
    assert long.media_bytes < 0.5 * long.payload_bytes


def test_long_texts_are_stored_in_pieces(monkeypatch):
    data = np.frombuffer("".join(random.Random(1).choice("abc \n") for _ in range(100_001)).encode(), np.uint8)
    at = np.array([0, len(data)])
    whole = next(media.summaries(data, at))
    monkeypatch.setattr(media, "PORTION", 20_000)
    again = next(media.summaries(data, at))
    assert again.row() == whole.row() and (again.counts == whole.counts).all() and (again.columns == whole.columns).all()


def test_stored_files_use_every_feature(monkeypatch):
    pick = random.Random(3)
    word = lambda letters, n: "".join(pick.choice(letters) for _ in range(n))
    line = word("etaoin shrdlu", 64 * 3)
    texts = {
        "cache, far copies": " ".join(pick.choice(["one", "two", "four", "five and"]) for _ in range(1200)) + line + word("xyz", 700) + line,
        "palette": "".join(pick.choice(["abc", "xyz", "opq"]) for _ in range(600)),
        "cross": "".join(c + c + pick.choice("0123456789") for c in word("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 2000)),
        "predictor": "".join("".join(chr(65 + (ord(c) - 65 + (pick.random() < 0.02)) % 58) for c in line) if k else line for k, line in enumerate([word("".join(map(chr, range(65, 123))), 192)] * 30)),
    }
    used: dict[str, set] = {name: set() for name in texts}
    now = [""]
    for name in ("invert_predictor", "invert_cross_colour", "invert_palette"):
        real = getattr(media.webp, name)
        monkeypatch.setattr(media.webp, name, lambda *a, real=real, name=name: (used[now[0]].add(name), real(*a))[1])
    copies, cache = media.webp._copies, media.webp._cache_pays
    monkeypatch.setattr(media.webp, "_copies", lambda *a: (found := copies(*a), used[now[0]].add("far" if (found[2] > 1).any() else "near"))[0])
    monkeypatch.setattr(media.webp, "_cache_pays", lambda *a: (found := cache(*a), used[now[0]].add(f"cache {found.any()}"))[0])
    for name, text in texts.items():
        now[0] = name
        data = np.frombuffer(text.encode(), np.uint8)
        stored, rows = media.store(data, np.array([0, len(data)]))
        assert media.load(stored)[0].tobytes().rstrip(b" ") == text.encode().rstrip(b" ")
    assert {"far", "cache True"} <= used["cache, far copies"] and "invert_palette" in used["palette"]
    assert "invert_cross_colour" in used["cross"] and "invert_predictor" in used["predictor"], used


def test_every_choice_is_an_images_own():
    pick = np.random.default_rng(8)
    parts = [pick.integers(97, 123, 192 * k).astype(np.uint8) for k in (1, 3, 8)] + [np.tile(np.frombuffer(b"abcabd", np.uint8), 32 * 5), np.repeat(pick.integers(97, 123, 64 * 9), 3).astype(np.uint8)]
    at = np.r_[0, np.cumsum([len(p) for p in parts])]
    together = media.store(np.concatenate(parts), at)[0]
    assert together == [media.store(p, np.array([0, len(p)]))[0][0] for p in parts]
    for p, x in zip(parts, media.load(together)):
        assert x.tobytes() == p.tobytes()
