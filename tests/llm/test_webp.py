import random

import numpy as np
import pytest
from vp8l_writer import webp as slow_webp

from sedimark.llm import webp

KINDS = [(), ("predictor",), ("cross",), ("green",), ("palette",), ("predictor", "cross", "green"), ("palette", "predictor"), ("green", "predictor"), ("cross", "predictor")]


def _picture(pick, few):
    width, height = pick.choice([1, 3, 17, 40]), pick.choice([1, 2, 9, 23])
    colours = [pick.getrandbits(32) for _ in range(few)]
    out = []
    for _ in range(width * height):
        if len(out) > 5 and pick.random() < 0.5:
            out.append(out[-pick.randrange(1, 5)])
        else:
            out.append(pick.choice(colours) if few < 300 else pick.getrandbits(32))
    return out, width


def test_reads_every_feature():
    pick, files, want = random.Random(12), [], []
    for k in range(110):
        kinds = KINDS[k % len(KINDS)]
        pixels, width = _picture(pick, pick.choice([1, 2, 3, 7, 40]) if "palette" in kinds else pick.choice([1, 5, 300]))
        files.append(slow_webp(pixels, width, pick, kinds, pick.choice([0, 0, 1, 4, 11]), pick.choice([0, 0, 2, 3])))
        want.append((pixels, width))
    for (pixels, width), got in zip(want, webp.decode(files)):
        assert got.shape == (len(pixels) // width, width) and got.ravel().tolist() == pixels


def test_writes_what_it_reads():
    pick = np.random.default_rng(3)
    rows = np.array([1, 2, 5, 1, 3, 1])
    parts = [np.full((64, 3), 32), pick.integers(0, 256, (128, 3)), pick.choice(list(b"etaoin shrdlu"), (320, 3)), np.full((64, 3), 0), np.repeat(pick.integers(0, 9, (48, 3)), 4, 0), np.arange(192).reshape(64, 3)]
    samples = np.concatenate(parts).astype(np.uint8)
    files = webp.encode(samples, rows, 64)
    for part, got in zip(parts, webp.decode(files)):
        assert (webp._bytes_of(got)[..., 1:].reshape(-1, 3) == part).all() and (got >> np.uint32(24) == 255).all()


def test_code_lengths_are_complete():
    pick = np.random.default_rng(5)
    counts = pick.integers(0, 3, (300, 280)) * pick.integers(0, 900, (300, 280)) ** pick.integers(0, 3, (300, 1))
    counts[:20, 2:] = 0
    counts[:, 0] += 1
    lengths = webp.code_lengths(counts)
    many = (counts > 0).sum(1) > 1
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max() <= 11
    assert (np.where(lengths > 0, 2.0 ** -lengths, 0).sum(1)[many] == 1).all()


@pytest.mark.parametrize("damage", [b"", b"RIFF", b"RIFFxxxxWEBPVP8 " + b"\0" * 20])
def test_damaged_files(damage):
    with pytest.raises(webp.WebPError):
        webp.decode([damage])
    good = webp.encode(np.arange(192, dtype=np.uint8).reshape(64, 3), np.array([1]), 64)[0]
    with pytest.raises(webp.WebPError):
        webp.decode([good[:60]])
