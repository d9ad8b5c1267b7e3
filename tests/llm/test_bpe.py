import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sedimark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = [
    "", " ", "  ", "\n \n a", "don't can't !'t '' 's x'sy", "I'll we've  they're", "a b 　 c \n中文字", "<|endoftext|>", "x<|endoftext|> y<|end", "a  \t b\r\n\r\nc   ",
    "é è́ ﬁ\U0001f600\U0001f600 ß\x00\x01\x1c\x1d z", "123 4567.89 $%^&*()_+", "'" * 5, "\u0085x y  z", "THE!! END!!", "a" * 3000, "x    q",
]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(PATH)


def test_equals_the_library(lib):
    pick = random.Random(4)
    parts = [*"aZ é9'\n\t.,!<|>#ß中  \x1f", "  ", "'s", "'re", "the", " and", "<|endoftext|>", "###", "\U0001f600"]
    samples = TRICKY + ["".join(pick.choice(parts) for _ in range(pick.randrange(40))) for _ in range(3000)]
    data = [s.encode() for s in samples]
    ends = np.cumsum([len(d) for d in data])
    starts = ends - np.array([len(d) for d in data])
    own = bpe.Codec(PATH)
    got = list(own.encode(np.frombuffer(b"".join(data), np.uint8), starts, ends))
    for s, ids in zip(samples, got):
        want = lib.encode(s, add_special_tokens=False).ids
        assert ids == want, s
        assert own.decode(ids) == lib.decode(want, skip_special_tokens=False)


def test_query_form(spark, lib):
    rows = [(i, t, 1) for i, t in enumerate(TRICKY)] + [(None, None, 1), (3, "again", 2), (3, "again", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sorted([tuple(r) for r in bpe.round_trip(df, PATH).collect()], key=str)
    want = []
    for i, t, _ in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(ids), digest(",".join(map(str, ids))), digest(lib.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(df.limit(0), PATH).count() == 0


def test_a_long_text_is_encoded_in_blocks(lib, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 7)
    text = "".join(TRICKY)
    data = np.frombuffer(text.encode(), np.uint8)
    assert list(bpe.Codec(PATH).encode(data, np.array([0]), np.array([len(data)]))) == [lib.encode(text, add_special_tokens=False).ids]
