"""Quality classifier: a factorisation machine over hashed words, structure statistics and length.

The score is a logistic function of  w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j.  The pairwise part is computed
in time linear in the number of features by the sum-of-squares identity:
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Features of a text: its words and their shapes, hashed (weights: square root of the count, scaled to length one), and
structure statistics cut into ten bins at quantiles of the training sample, one feature for each bin. Labels,
language, source and doc_id are never features.

The model is fitted on the driver over at most ``SAMPLE`` labelled rows, taken in the order of a hash of their ids;
everything else runs over all rows.
"""

from __future__ import annotations

import itertools
import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.llm.common import free_name, portions, texts

#: Most labelled rows the model is fitted on.
SAMPLE = 6000
BUCKETS, BINS, RANK, EPOCHS, RATE, DECAY = 1 << 14, 10, 8, 12, 0.05, 1e-4
THRESHOLD = 0.3
STATS = (
    "log_bytes", "log_words", "distinct_words", "repeated_next", "top_word", "upper", "symbols", "digits",
    "word_bytes", "distinct_lines", "line_bytes", "bare_symbols", "accents", "stops",
)
_SHAPE = bytes(ord("a") if chr(b).islower() or b >= 128 else ord("A") if chr(b).isupper() else ord("0") if 48 <= b < 58 else b for b in range(256))
_LETTER, _UPPER, _DIGIT, _SPACE = (np.array([f(b) for b in range(256)]) for f in (lambda b: b >= 128 or chr(b).isalpha(), lambda b: b < 128 and chr(b).isupper(), lambda b: 48 <= b < 58, lambda b: b == 32 or 9 <= b <= 13))


#: A word's packed number: its bucket, its shape's bucket, and whether it is a short one of bare symbols.
_BITS = BUCKETS.bit_length() - 1


class _Hashes(dict):
    """word -> its packed number; cleared when it grows large, and so are the shapes."""

    def __init__(self):
        super().__init__()
        self.shapes: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        plain = word.translate(_SHAPE)
        shape = self.shapes.get(plain)
        if shape is None:
            if len(self.shapes) > 200_000:
                self.shapes.clear()
            shape = self.shapes[plain] = zlib.crc32(b"\0" + bytes(k for k, _ in itertools.groupby(plain))[:12]) % BUCKETS
        bare = len(word) <= 3 and not word.isalnum() and word.isascii() and not any(map(str.isalnum, word.decode()))
        out = self[word] = zlib.crc32(word.lower()) % BUCKETS | shape << _BITS | bare << 2 * _BITS
        return out


def features(text: bytes, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, weights, statistics) of UTF-8 bytes; a text without words has no buckets."""
    words = text.split()
    counts = Counter(words)
    packed = np.fromiter(map(hashes.__getitem__, counts), np.int64, len(counts))
    each = np.fromiter(counts.values(), np.float64, len(counts))
    kinds = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256, np.int64)
    n, lines = len(words), text.split(b"\n")
    letters, filled = int(kinds[_LETTER].sum()), len(text) - int(kinds[_SPACE].sum())
    stats = np.array([
        np.log1p(len(text)), np.log1p(n), len(counts) / max(1, n),
        sum(map(operator.eq, words, itertools.islice(words, 1, None))) / max(1, n),
        max(counts.values(), default=0) / max(1, n), int(kinds[_UPPER].sum()) / max(1, letters),
        (filled - letters - int(kinds[_DIGIT].sum())) / max(1, filled), int(kinds[_DIGIT].sum()) / max(1, filled), filled / max(1, n),
        len(set(lines)) / len(lines), np.log1p(len(text) / len(lines)),
        float(each[packed >> 2 * _BITS > 0].sum()) / max(1, n),
        int(kinds[128:].sum()) / max(1, len(text)), int(kinds[[46, 33, 63]].sum()) / max(1, n),
    ])
    if not n:
        return np.zeros(0, np.int64), np.zeros(0), stats
    both = np.concatenate([packed & (BUCKETS - 1), packed >> _BITS & (BUCKETS - 1)])
    where, back = np.unique(both, return_inverse=True)
    weight = np.sqrt(np.bincount(back, np.concatenate([each, each])))
    return where, weight / np.sqrt((weight**2).sum()), stats


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # D
    factors: np.ndarray  # D x RANK
    edges: np.ndarray  # statistics x (BINS - 1)

    def inputs(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers, values and row starts of all rows."""
        stats = np.array([r[2] for r in rows])
        bins = np.stack([np.searchsorted(e, stats[:, k], "right") for k, e in enumerate(self.edges)], 1)
        bins = BUCKETS + np.arange(len(STATS)) * BINS + bins
        size = np.array([len(r[0]) for r in rows]) + len(STATS)
        start = np.r_[0, np.cumsum(size)]
        where, value = np.empty(start[-1], np.int32), np.empty(start[-1], rows[0][1].dtype)
        for k, (w, x, _) in enumerate(rows):
            cut = start[k + 1] - len(STATS)
            where[start[k] : cut], value[start[k] : cut] = w, x
            where[cut : start[k + 1]], value[cut : start[k + 1]] = bins[k], 1 / np.sqrt(len(STATS))
        return where, value, start

    def margin(self, where: np.ndarray, value: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logit of each row, and the factor sums that its gradient needs."""
        vx = self.factors[where] * value[:, None]
        sums = np.add.reduceat(vx, start[:-1])
        squares = np.add.reduceat((vx**2).sum(1), start[:-1])
        return self.bias + np.add.reduceat(self.linear[where] * value, start[:-1]) + ((sums**2).sum(1) - squares) / 2, sums

    def score(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.margin(*self.inputs(rows))[0], -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """Fits by AdaGrad over the logistic loss. Without rows of both labels every score is the same: 1 or 0, or 0.5 without rows."""
    size = BUCKETS + len(STATS) * BINS
    pick = np.random.default_rng(seed)
    model = Model(0.0, np.zeros(size), pick.normal(0, 0.02, (size, RANK)), np.zeros((len(STATS), BINS - 1)))
    if not len(rows) or len(set(labels.tolist())) < 2:
        model.factors[:] = 0
        model.bias = 0.0 if not len(rows) else 40.0 if labels[0] else -40.0
        return model
    model.edges = np.quantile(np.array([r[2] for r in rows]), np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    model.bias = float(np.log(labels.mean() / (1 - labels.mean())))
    where, value, start = model.inputs(rows)
    seen = [np.full(size, 1e-3), np.full((size, RANK), 1e-3), 1e-3]
    for _ in range(EPOCHS):
        order = pick.permutation(len(rows))
        for k in range(0, len(order), 64):
            own = order[k : k + 64]
            n = start[own + 1] - start[own]
            begin = np.r_[0, np.cumsum(n)]
            at = np.repeat(start[own] - begin[:-1], n) + np.arange(begin[-1])
            w, x = where[at], value[at].astype(np.float64)
            logit, sums = model.margin(w, x, begin)
            off = np.repeat((1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[own]) / len(own), n)
            each = (off * x)[:, None] * (np.repeat(sums, n, axis=0) - model.factors[w] * x[:, None])
            used, back = np.unique(w, return_inverse=True)
            g1 = np.bincount(back, off * x) + DECAY * model.linear[used]
            g2 = np.stack([np.bincount(back, each[:, f]) for f in range(RANK)], 1) + DECAY * model.factors[used]
            seen[0][used] += g1**2
            seen[1][used] += g2**2
            model.linear[used] -= RATE * g1 / np.sqrt(seen[0][used])
            model.factors[used] -= RATE * g2 / np.sqrt(seen[1][used])
            g0 = float((off[begin[:-1]]).sum())
            seen[2] += g0**2
            model.bias -= RATE * g0 / seen[2] ** 0.5
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no model is fitted on: crc32 of the id as text, mod 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` rows of ``labels`` (doc_id, quality) that are not held out and that ``docs`` holds."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most ``sample`` pairs of numbers go to every task
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # however many rows share an id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for part in portions(batches, "text"):
            found = [features(t, hashes) for t in texts(part.column("text"))]
            columns = [part.column("doc_id"), part.column("quality"), *(pa.array([r[k] for r in found], pa.list_(t)) for k, t in ((0, pa.int32()), (1, pa.float32()), (2, pa.float64())))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "at", "weight", "stats"])

    got = rows.mapInArrow(run, "doc_id long, quality int, at array<int>, weight array<float>, stats array<double>").toArrow()
    got = got.take(pa.compute.sort_indices(got.column("doc_id"))).combine_chunks()
    lists = []
    for name in ("at", "weight", "stats"):  # slices of the Arrow buffers, 8 bytes a feature
        column = got.column(name).combine_chunks()
        cut, flat = column.offsets.to_numpy(), column.values.to_numpy()
        lists.append([flat[i:j] for i, j in zip(cut[:-1], cut[1:])])
    return fit(list(zip(*lists)), got.column("quality").to_numpy().astype(np.float64))


def with_score(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """``docs`` with the score of ``text`` as one more column; null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, own = _Hashes(), shared.value
        for part in portions(batches, "text"):
            score = own.score([features(t, hashes) for t in texts(part.column("text"))])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null text is scored as the empty text. Equal texts have equal scores. A null doc_id stays null and has no label.
    Of repeated labels of one id the largest counts; labels other than 0 and 1 are left out. Without labels every
    score is 0.5. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    scored = with_score(rows, train(docs, labels, sample), "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier predicts as good."""
    name = free_name(docs, "_quality_score")
    return with_score(docs, train(docs, labels, sample), name).where(F.col(name) >= threshold).drop(name)
