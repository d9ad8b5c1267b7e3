"""Texts stored as lossless WebP pictures, read back as samples, with features.

A text's UTF-8 bytes, padded with spaces to whole rows of 64 RGB pixels, are the samples of a picture 64 pixels wide.
A picture of more than ``STRIP`` rows is stored as strips, one WebP file after another, so that no text is too long for
the format and many pictures can be decoded in lock step.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sedimark.llm import webp
from sedimark.llm.common import portions, raw

WIDTH, ROW = 64, 192
STRIP = 32
PORTION = 5 << 20
#: Bytes of texts that are written together: arrays of this size stay in the caches.
WRITTEN = 1 << 20
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def split_files(media: bytes) -> list[bytes]:
    """The files of a stored picture, one for each strip."""
    out, at = [], 0
    while at < len(media):
        size = 8 + int.from_bytes(media[at + 4 : at + 8], "little")
        out.append(media[at : at + size])
        at += size
    return out


def store(data: np.ndarray, at: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The stored form of each text (bytes at[i]..at[i+1] of ``data``), and its number of rows."""
    media, rows, first = [], [], 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + WRITTEN, "right")) - 1)
        found, high = _store(data[at[first] : at[last]], at[first : last + 1] - at[first])
        media += found
        rows.append(high)
        first = last
    return media, np.concatenate(rows) if rows else np.zeros(0, np.int64)


def _store(data: np.ndarray, at: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    size = np.diff(at)
    rows = np.maximum(1, -(-size // ROW))
    start = np.r_[0, np.cumsum(rows * ROW)]
    payload = np.full(start[-1], 32, np.uint8)
    # each text keeps its order: its bytes move by as much as the padding before it
    payload[np.arange(len(data)) + np.repeat(start[:-1] - at[:-1], size)] = data
    strips = -(-rows // STRIP)
    height = np.full(strips.sum(), STRIP)
    last = np.cumsum(strips) - 1
    height[last] = rows - (strips - 1) * STRIP
    files = webp.encode(payload.reshape(-1, 3), height, WIDTH)
    first = np.r_[0, last + 1]
    return [b"".join(files[i:j]) for i, j in zip(first[:-1].tolist(), first[1:].tolist())], rows


def load(media: list[bytes]) -> list[np.ndarray]:
    """The samples (rows x 64 x 3) of stored pictures."""
    files = [split_files(m) for m in media]
    images = webp.decode([f for own in files for f in own])
    out, at = [], 0
    for own in files:
        strips = images[at : at + len(own)]
        at += len(own)
        p = strips[0] if len(strips) == 1 else np.concatenate(strips)
        out.append(np.stack([(p >> np.uint32(16)).astype(np.uint8), (p >> np.uint32(8)).astype(np.uint8), p.astype(np.uint8)], -1))
    return out


class Summary:
    """Digests and features of one text, gathered over its pieces from the bytes read back."""

    def __init__(self):
        self.payload, self.media = hashlib.sha256(), hashlib.sha256()
        self.rows = self.media_bytes = 0
        self.tail = b""
        self.counts = np.zeros(256, np.int64)
        self.columns = np.zeros(WIDTH, np.int64)

    def add(self, media: bytes, samples: np.ndarray, counts: np.ndarray | None = None, columns: np.ndarray | None = None) -> None:
        """A piece; counts of its sample values and sums of its columns of pixels are given where they are known."""
        data = samples.tobytes()
        self.payload.update(data)
        self.media.update(media)
        self.rows += len(samples)
        self.media_bytes += len(media)
        self.tail = data[-16:]
        self.counts += np.bincount(samples.ravel(), minlength=256) if counts is None else counts
        self.columns += samples.sum((0, 2), dtype=np.int64) if columns is None else columns

    def row(self) -> tuple:
        return (self.rows * ROW, self.payload.hexdigest(), zlib.crc32(self.tail), self.media_bytes, self.media.hexdigest())


def features(counts: np.ndarray, columns: np.ndarray) -> list[str]:
    """Of each row: height, mean and deviation of the samples, entropy in bits, and a 64-bit difference hash of the column sums."""
    n, levels = counts.sum(1), np.arange(256)
    total, squares = counts @ levels, counts @ (levels * levels)  # whole numbers: no order of adding shows
    mean = total / n
    spread = np.sqrt(np.maximum(squares * n - total * total, 0)) / n
    logs = (counts * np.log2(np.maximum(counts, 1))).sum(1)
    entropy = np.maximum(np.log2(n) - logs / n, 0) + 0.0
    dhash = np.where(columns > np.roll(columns, 1, 1), _BITS, np.uint64(0)).sum(1, dtype=np.uint64)
    values = zip((n // ROW).tolist(), mean.tolist(), spread.tolist(), entropy.tolist(), dhash.tolist())
    return [f"rows={r};mean={m:.4f};std={s:.4f};entropy={e:.4f};dhash={h:016x}" for r, m, s, e, h in values]


def summaries(data: np.ndarray, at: np.ndarray) -> Iterator[Summary]:
    """The summary of each text; one longer than ``PORTION`` is stored and read back in whole strips, piece by piece."""
    if len(at) == 2 and at[1] - at[0] > PORTION:
        out, step = Summary(), PORTION // (STRIP * ROW) * STRIP * ROW
        for first in range(at[0], at[1], step):
            piece = data[first : min(first + step, at[1])]
            stored, _ = store(piece, np.array([0, len(piece)]))
            out.add(stored[0], load(stored)[0])
        yield out
        return
    media, rows = store(data, at)
    images = load(media)
    every = np.concatenate(images) if images else np.zeros((0, WIDTH, 3), np.uint8)
    of = np.repeat(np.arange(len(rows)), rows)
    counts = np.bincount((of[:, None] << 8 | every.reshape(-1, ROW)).ravel(), minlength=len(rows) << 8).reshape(-1, 256)
    sums = every.sum(2, dtype=np.int64)
    columns = np.add.reduceat(sums, np.r_[0, np.cumsum(rows)][:-1]) if len(rows) else sums
    for stored, samples, c, x in zip(media, images, counts, columns):
        out = Summary()
        out.add(stored, samples, c, x)
        yield out


def round_trip(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature) for every row.

    The digests of the payload and the feature are of what is read back from the stored bytes. tail_crc32: of the
    payload's last 16 bytes. Null and empty text are one row of spaces. Equal texts give equal values; repeated rows
    give a row each. Other columns are ignored; an empty table gives an empty result.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text", PORTION):
            data, at = raw(part.column("text"))
            found = list(summaries(data, at))
            out = [*zip(*(x.row() for x in found)), features(np.array([x.counts for x in found]), np.array([x.columns for x in found]))]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at)), *(pa.array(c, t) for c, t in zip(out, kinds))], names)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, schema)
