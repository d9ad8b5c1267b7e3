import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sedimark.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_every_limit_holds_and_nothing_is_lost():
    pick = random.Random(2)
    for length, segments, loss in ((64, 4, 64), (64, 3, 20), (2048, 64, 2048)):
        done = {}
        packer = packing.Packer(lambda k, p: done.__setitem__(k, p), length, segments, loss, 6)
        sizes = [pick.choice([1, 1, 2, 5, 17, length - 1, length, 3 * length + 5]) for _ in range(300)]
        bearing = [np.r_[0, np.cumsum([pick.random() < (0.3 if loss < length else 1) for _ in range(n)])] for n in sizes]
        for i, n in enumerate(sizes):
            packer.add(i, n, bearing[i] if loss < length else None)
        packer.finish()
        seen = {}
        for pieces in done.values():
            assert len(pieces) <= segments and sum(n for _, _, n in pieces) <= length
            assert loss == length or sum(bearing[i][s + n] - bearing[i][s] for i, s, n in pieces) <= loss
            for i, s, n in pieces:
                assert n > 0
                for t in range(s, s + n):
                    assert (i, t) not in seen
                    seen[i, t] = 1
        assert len(seen) == sum(sizes)
        if loss == length:
            total = [sum(n for _, _, n in p) for p in done.values()]
            assert all(n == length or n & (n - 1) == 0 for n in total)


def test_pack_with_a_limit_on_loss_bearing_tokens(spark):
    pick = random.Random(4)
    rows = [(i, " ".join(pick.choice(["Word", "x", "12"]) for _ in range(pick.choice([1, 30, 900])))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    lib = Tokenizer.from_file(PATH)
    ids = {i: np.array(lib.encode(t, add_special_tokens=False).ids + [1]) for i, t in rows}
    held, got = {}, packing.pack(df, PATH, 256, 16, 40, bears=lambda x: x % 2 == 0).collect()
    for r in got:
        held[r.sequence_id] = held.get(r.sequence_id, 0) + int((ids[r.doc_id][r.start : r.start + r.length] % 2 == 0).sum())
    assert max(held.values()) == 40 and sum(r.length for r in got) == sum(map(len, ids.values()))


def test_pack(spark):
    lib = Tokenizer.from_file(PATH)
    pick = random.Random(8)
    odd = ["", None, "É́ ΣΑΣ ΑΣ", "a b　c", "<|startoftext|>x <|endoftext|>", "don't  I'LL\n1234", "\x1c\x85 z", "ﬀ Å Ķ é"]
    rows = [(i, t, 7) for i, t in enumerate(odd)] + [(100 + i, " ".join(pick.choice(["Word", "naïve", "x-y", "12"]) for _ in range(pick.choice([1, 30, 900, 9000]))), 7) for i in range(60)] + [(None, "q", 1), (5, odd[5], 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(3)
    got = packing.pack(df, PATH).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        own = sorted(by_doc[i], key=lambda r: r.start)
        times = sum(1 for x in rows if x[0] == i)
        assert sum(r.length for r in own) == times * len(ids)
        for r in own:
            assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_word_codec_equals_the_library():
    lib, own, pick = Tokenizer.from_file(PATH), packing.WordCodec(PATH), random.Random(9)
    parts = ["Word", "naïve", "ÀÉß", "'s", "'RE", "'", "12", "...", "×", "é", "中", " ", "\n", "<|endoftext|>", "<|", "!?", "İ", "Σ", "ª", "x" * 40, "\x7f", "\x01"]
    samples = ["".join(pick.choice(parts) for _ in range(pick.randrange(30))) for _ in range(3000)] + [chr(c) + "aZ" for c in range(0x300)]
    for s, ids in zip(samples, own.encode([s.encode() for s in samples])):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(s, add_special_tokens=False).ids, s


def test_a_long_text_is_encoded_in_pieces(monkeypatch):
    text = ("Some wörds, 12 中 don't\n" * 40 + "x" * 300 + " end").encode()
    whole = list(packing.WordCodec(PATH).encode([text]))
    monkeypatch.setattr(packing, "LONG", 64)
    assert list(packing.WordCodec(PATH).encode([text])) == whole


def _slow(items, length, segments, loss, most_open):
    """The rule in plain loops: whole pieces by the largest dot product, others into the fullest sequence that they fill."""
    bins, done, count = [], {}, 0

    def put(b, i, start, n, mask):
        b["pieces"].append((i, start, n))
        b["room"] = [b["room"][0] - n, b["room"][1] - 1, b["room"][2] - sum(mask[start : start + n])]
        if b["room"][0] <= 0 or b["room"][2] <= 0:
            bins.remove(b)
            done[b["number"]] = b["pieces"]

    for i, mask in enumerate(items):
        start = 0
        while start < len(mask):
            left, bears = len(mask) - start, sum(mask[start:])
            whole = [b for b in bins if left < length and b["room"][0] >= left and b["room"][2] >= bears and (b["room"][1] > 1 or b["room"][0] == left)]
            if whole:
                dot = lambda b: b["room"][0] / length * (left / length) + b["room"][1] / segments * (1 / segments) + b["room"][2] / loss * (bears / loss)
                put(max(whole, key=dot), i, start, left, mask)
                break
            fills = [b for b in bins if b["room"][0] <= left or b["room"][2] <= bears] if left < length and len(bins) >= most_open else []
            if fills:
                b = min(fills, key=lambda b: b["room"][0] + length * (b["room"][2] * left < min(b["room"][0], left) * bears))
            else:
                b = {"number": count, "pieces": [], "room": [length, segments, loss]}
                bins.append(b)
                count += 1
            n = 0
            while n < min(left, b["room"][0]) and sum(mask[start : start + n + 1]) <= b["room"][2]:
                n += 1
            put(b, i, start, n, mask)
            start += n
    return done


def test_the_choice_equals_a_slow_one():
    pick = random.Random(6)
    for loss in (64, 50):
        items = [[pick.random() < pick.choice([0.5, 0.9, 1.0]) for _ in range(pick.choice([1, 3, 9, 20, 40, 63, 64, 150]))] for _ in range(250)]
        done = {}
        packer = packing.Packer(lambda k, p: done.__setitem__(k, p), 64, 40, loss, 6)
        for i, mask in enumerate(items):
            packer.add(i, len(mask), np.r_[0, np.cumsum(mask)])
        want = _slow(items, 64, 40, loss, 6)
        assert done == want and len(want) > 50
        if loss < 64:
            assert any(sum(n for _, _, n in p) < 64 for p in done.values())  # the loss limit binds


def test_loss_bearing_tokens_limit_what_pack_gives(spark):
    rows = [(i, "word " * 3000 if i % 2 else "well, yes. " * 1200) for i in range(6)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), PATH).collect()
    lib, codec, held = Tokenizer.from_file(PATH), packing.word_codec(PATH), {}
    for r in got:
        ids = np.array(lib.encode(rows[r.doc_id][1], add_special_tokens=False).ids + [1])
        bears = np.r_[codec.bearing[ids[:-1]], False]
        n, loss = held.get(r.sequence_id, (0, 0))
        held[r.sequence_id] = (n + r.length, loss + int(bears[r.start : r.start + r.length].sum()))
    assert max(loss for _, loss in held.values()) == packing.LOSS and max(n for n, _ in held.values()) == 2048
    assert {",", ".", "!"} <= {lib.id_to_token(i).removesuffix("</w>") for i in np.flatnonzero(~codec.bearing)}


def test_another_file_is_left_to_the_library(tmp_path):
    import json

    bare = json.loads(open(PATH).read())
    bare["normalizer"] = {"type": "NFC"}
    (tmp_path / "t.json").write_text(json.dumps(bare))
    lib, own = Tokenizer.from_file(str(tmp_path / "t.json")), packing.WordCodec(str(tmp_path / "t.json"))
    assert not own.known and packing.WordCodec(PATH).known
    for s in ("Some Words here", "", "x, y"):
        assert np.frombuffer(next(own.encode([s.encode()])), "<u4").tolist() == lib.encode(s, add_special_tokens=False).ids
