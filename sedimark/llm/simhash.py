"""SimHash near-duplicates with pigeonring filtering.

A text's words (A-Z lower-cased, separated by ASCII white space) give shingles; a fingerprint bit is set where over
half of the shingles' XXH64 values have it. Two fingerprints link when at most ``most`` bits differ.

Candidates follow the pigeonring principle. The 64 bits form a ring of most + 1 segments of nearly equal size. If two fingerprints differ in
at most ``most`` bits, then some segment i starts a chain whose first l segments differ in at most most * l / (most + 1)
bits, for every l: 0 bits in segment i, at most 1 in i..i+1, at most 2 in i..i+2, and so on. Segment i is therefore equal,
and of segment i+1 one half is equal; (i, half, segment i, that half) is the key of the index. The whole chain is checked
before the full Hamming distance.

near_duplicates() links by these fingerprints alone. without_near_duplicates() asks for five-word shingles with a
similarity of 0.8 or more: few bits of a fingerprint of such shingles would miss most pairs near that bound, so the ring
works on fingerprints of single words, which small edits change less, with 5 bits; each candidate then has to agree in a
wider fingerprint of its five-word shingles, whose differing bits measure their similarity.

Only distinct fingerprints take part, so copies cost one row. A key held by more than ``BLOCK`` fingerprints is cut
into blocks, and each pair of blocks is a group of its own: no group is unbounded, no pair is lost. A group gives back
a spanning forest of its links, never all pairs; a large one is walked, so that a dense group of n fingerprints takes
about n comparisons and not n squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimark.llm.common import NULL_ID, given_back, keyed, portions, texts, written
from sedimark.llm.components import connected_components

SEED, WIDTH, MAX_BITS = 42, 3, 3
#: For similarity: words of a shingle, bits of word fingerprints that may differ, and bits of the wider fingerprint that
#: may: shingle sets of Jaccard similarity 0.8 differ in 78 of 512 on average, deviation 8; of 0.7 in 98, of 0.5 in 137.
SHINGLE, WORD_BITS, WIDE, WIDE_BITS = 5, 5, 64, 90
#: Fingerprints of one index key that one task compares with each other.
BLOCK = 2048
#: Runs of one key of up to so many rows are compared for many keys at once, and of up to so many always by near pairs.
FEW, SOME = 16, 512
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 15


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    """The 64-bit SimHash of UTF-8 bytes; 0 without words; fewer than ``width`` words are one shingle."""
    words = text.lower().split()  # of bytes: lower() and split() are ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(line, SEED)  # one shingle: its own bits
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(sizes + 1) - sizes - 1
    last = (first + sizes)[width - 1 :].tolist()
    first = first[: len(last)].tolist()
    n, ones = len(last), np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):
        values = np.array([digest(line[i:j], SEED) for i, j in zip(first[k : k + _CHUNK], last[k : k + _CHUNK])], np.uint64)
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


_MIX, _STIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _STIR
    return x ^ (x >> np.uint64(31))


class Sketcher:
    """Word fingerprints and wide shingle fingerprints of texts; the hashes of words are remembered."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def sketch(self, text: bytes) -> tuple[int, bytes]:
        """(64-bit SimHash of the words, repeats included; ``WIDE`` bytes of SimHash of the five-word shingles); zeros without words.

        A word's hash is its XXH64; a shingle's is a polynomial of its words' hashes, from which each further 64 bits are
        stirred anew.
        """
        words = text.lower().split()
        if not words:
            return 0, bytes(WIDE)
        known = self.known
        if len(known) > 200_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w, SEED)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(SHINGLE, len(words))
        n = len(words) - width + 1
        narrow, wide = np.zeros(64, np.int64), np.zeros(8 * WIDE, np.int64)
        salt = (np.arange(WIDE // 8, dtype=np.uint64) + np.uint64(1)) * _MIX
        ones = lambda x, k: np.unpackbits(x.view(np.uint8).reshape(len(x), k), axis=1, bitorder="little").sum(0, dtype=np.int64)
        with np.errstate(over="ignore"):
            shingles = hashes[:n].copy()
            for j in range(1, width):
                shingles = shingles * _MIX + hashes[j : j + n]
            for k in range(0, len(words), _CHUNK // 8):
                narrow += ones(hashes[k : k + _CHUNK // 8], 8)
                part = shingles[k : k + _CHUNK // 8]
                if len(part):
                    wide += ones(_stirred(part[:, None] ^ salt), WIDE)
        fp = int.from_bytes(np.packbits(2 * narrow > len(words), bitorder="little").tobytes(), "little")
        return fp, np.packbits(2 * wide > n, bitorder="little").tobytes()


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) of every row; null text counts as empty, null ids keep a stand-in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches, "text"):
            values = np.array([fingerprint(t, width) for t in texts(part.column("text"))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values)], ["doc_id", "fp"])

    return keyed(docs).mapInArrow(run, "doc_id long, fp long")


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, wide) of every row: the fingerprints of its words and of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Sketcher()
        for part in portions(batches, "text"):
            both = [own.sketch(t) for t in texts(part.column("text"))]
            values = np.array([fp for fp, _ in both], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values), pa.array([w for _, w in both], pa.binary())], ["doc_id", "fp", "wide"])

    return keyed(docs).mapInArrow(run, "doc_id long, fp long, wide binary")


def borders(most: int) -> list[int]:
    """Where the segments of the ring begin, and its end."""
    return [64 * i // (most + 1) for i in range(most + 2)]


def linked(a: np.ndarray, b: np.ndarray, start: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Which pairs of fingerprints pass the chain of segment ``start`` and then the Hamming check."""
    edge = np.array(borders(most))
    diff = a ^ b
    alive = np.bitwise_count(diff) <= most
    at = np.flatnonzero(alive)  # few pass: the chains of the others need no look
    diff, start = diff[at], start[at]
    turn = edge[start].astype(np.uint64)
    ring = (diff >> turn) | np.where(turn > 0, diff << ((np.uint64(64) - turn) & np.uint64(63)), np.uint64(0))
    passed = np.ones(len(at), bool)
    for chain in range(1, most + 1):
        end = start + chain
        size = edge[end % (most + 1)] + np.where(end > most, 64, 0) - edge[start]
        passed &= np.bitwise_count(ring & ((np.uint64(1) << size.astype(np.uint64)) - np.uint64(1))) <= most * chain // (most + 1)
    alive[at] = passed
    return alive


def _agree(wide: np.ndarray | None, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows agree in their wide fingerprints (rows of 64-bit numbers); all where there are none."""
    if wide is None or not len(i):
        return np.ones(len(i), bool)
    return np.bitwise_count(wide[i] ^ wide[j]).sum(1) <= WIDE_BITS


def _walk(fp: np.ndarray, wide: np.ndarray | None, table: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) that join all linked fingerprints of a group: each one reached looks only at those not yet reached."""
    left, found_a, found_b, queue = np.arange(len(fp)), [], [], []
    while len(left):
        if queue:
            now = queue.pop()
        else:
            now, left = int(left[0]), left[1:]
        at = np.flatnonzero(linked(fp[now], fp[left], np.full(len(left), table), most))
        if len(at):
            at = at[_agree(wide, np.full(len(at), now), left[at])]
        if len(at):
            found_a.append(np.full(len(at), now))
            found_b.append(left[at])
            queue += left[at].tolist()
            left = np.delete(left, at)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _near(fp: np.ndarray, bound: int, most: int) -> tuple[np.ndarray, np.ndarray] | None:
    """All pairs (positions) within ``most`` bits, or None as soon as there are more than ``bound``."""
    a, b, count = [], [], 0
    for k in range(0, len(fp), 128):
        i, j = np.nonzero(np.bitwise_count(fp[k : k + 128, None] ^ fp[None, k:]) <= most)
        later = j > i
        a.append(i[later] + k)
        b.append(j[later] + k)
        count += len(a[-1])
        if count > bound:
            return None
    return np.concatenate(a), np.concatenate(b)


def _joined(fp: np.ndarray, wide: np.ndarray | None, table: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all linked fingerprints of a group: from the near pairs where these are few, else by a walk."""
    n = len(fp)
    pairs = _near(fp, n * SOME if n <= SOME else 64 * n, most)
    if pairs is None:
        return _walk(fp, wide, table, most)
    a, b = pairs
    ok = linked(fp[a], fp[b], np.full(len(a), table), most)
    a, b = a[ok], b[ok]
    ok = _agree(wide, a, b)
    a, b = a[ok], b[ok]
    keep = _forest(a, b)
    return a[keep], b[keep]


def _forest(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The positions of links that join two trees, taken in order."""
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = top.get(up, up)
            x = up
        return x

    kept = []
    for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = root(x), root(y)
        if x != y:
            top[max(x, y)] = min(x, y)
            kept.append(k)
    return np.array(kept, np.int64)


def _compare(key: np.ndarray, fp: np.ndarray, node: np.ndarray, wide: np.ndarray | None, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within each run of equal keys; bits 24 to 26 of a key are the segment that starts the chain."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    cut = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[cut, len(key)])
    table = ((key >> 24) & 7).astype(np.int64)
    # runs of a few rows: every shift d compares row r with row r + d of the same run, for all runs at once
    small = size <= FEW
    end = np.repeat(cut + size, size)
    few = np.repeat(small, size)
    rows = np.arange(len(key))
    for d in range(1, FEW):
        at = rows[few & (rows + d < end)]
        if not len(at):
            break
        ok = at[linked(fp[at], fp[at + d], table[at], most)]
        ok = ok[_agree(wide, ok, ok + d)]
        found.append((node[ok], node[ok + d]))
    for first, n in zip(cut[~small].tolist(), size[~small].tolist()):
        own = slice(first, first + n)
        a, b = _joined(fp[own], None if wide is None else wide[own], int(table[first]), most)
        found.append((node[own][a], node[own][b]))
    if not found:
        return node[:0], node[:0]
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def links(nodes: DataFrame, block: int = BLOCK, most: int = MAX_BITS) -> DataFrame:
    """(a, b): links that join all fingerprints that are linked. nodes: (fp, node), and wide where that has to agree too.

    most: from 3 to 7.
    """
    edge = borders(most)
    bits = lambda low, high: F.shiftrightunsigned("fp", low).bitwiseAND((1 << (high - low)) - 1)
    keys = []
    for i in range(most + 1):
        low, high = edge[(i + 1) % (most + 1)], edge[(i + 1) % (most + 1) + 1]
        middle = (low + high) // 2
        for half, part in enumerate((bits(low, middle), bits(middle, high))):
            keys.append(F.lit((half << 28) | (i << 24)).cast("long") + F.shiftleft(bits(edge[i], edge[i + 1]), 32) + F.shiftleft(part, 48))
    more = [c for c in ("wide",) if c in nodes.columns]
    index = nodes.select("fp", "node", *more, F.explode(F.array(*keys)).alias("key"))
    held = index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    index = index.join(held, "key")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    index = index.select("key", "fp", "node", *more, blocks.alias("k"), own.alias("own"))
    index = index.select("key", "fp", "node", *more, "own", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    lo, hi = F.least("own", "other"), F.greatest("own", "other")
    index = index.select("key", lo.alias("lo"), hi.alias("hi"), "fp", "node", *more)
    spread = index.repartition(F.col("key"), F.col("lo"), F.col("hi")).sortWithinPartitions("key", "lo", "hi", "fp")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = frame.iloc[-1]
            open_ = ((frame["key"] == last["key"]) & (frame["lo"] == last["lo"]) & (frame["hi"] == last["hi"])).to_numpy()
            rest, frame = frame[open_], frame[~open_]
            if len(frame):
                yield from answer(frame)
        if rest is not None and len(rest):
            yield from answer(rest)

    def answer(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        key, lo, hi = (frame[c].to_numpy() for c in ("key", "lo", "hi"))
        # a run is (key, lo, hi); the bits of the table stay readable in the run's own key
        new = np.r_[True, (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
        run_key = (np.cumsum(new).astype(np.int64) << 28) | (key & (7 << 24))
        wide = np.frombuffer(b"".join(frame["wide"]), np.uint64).reshape(len(frame), -1) if more else None
        a, b = _compare(run_key, frame["fp"].to_numpy().view(np.uint64), frame["node"].to_numpy(), wide, most)
        yield pd.DataFrame({"a": a, "b": b})

    return spread.mapInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text, any other columns).

    fingerprint: 16 lower-case hex digits. component_id: the smallest doc_id that links reach, a row's own included.
    Null or blank text: fingerprint zero, linked like any other. Null doc_id: doc_id null; null counts as the smallest
    id, so the component of such a row has the null id. Repeated rows:
    one result each. An empty table gives an empty result.
    """
    prints = written(fingerprints(docs, width), "prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("node"))
    nodes = written(nodes, "nodes")
    comp = connected_components(links(nodes.select("fp", F.col("fp").alias("node")), block))
    label = nodes.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "node", F.coalesce("component", "fp").alias("component"))
    least = label.groupBy("component").agg(F.min("node").alias("component_id"))
    label = label.join(least, "component").select("fp", "component_id")
    out = prints.join(label, "fp")
    return out.select(given_back(), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), given_back("component_id"))


def similar(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(doc_id, component_id) of every distinct id: component_id is the smallest doc_id that links of similar texts reach.

    Texts are similar when their word fingerprints differ in at most ``WORD_BITS`` bits and the wide fingerprints of
    their five-word shingles in at most ``WIDE_BITS``. Rows that share an id are one document here, with links of all.
    Ids as keyed() gives them. Null or blank texts are all similar to each other.
    """
    prints = written(sketches(docs), "sketches")
    nodes = written(prints.groupBy("fp", "wide").agg(F.min("doc_id").alias("node")), "nodes")
    # a document belongs to the node of its text, so that equal texts and equal ids are joined too
    own = prints.join(nodes, ["fp", "wide"]).select(F.col("doc_id").alias("a"), F.col("node").alias("b")).where("a <> b")
    comp = connected_components(links(nodes, block, WORD_BITS).unionByName(own))
    ids = prints.select("doc_id").distinct()
    return ids.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component_id"))


def without_near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each group of similar texts: the one of smallest doc_id.

    Rows that share an id are one document: they stay or go together. A null doc_id counts as the smallest id.
    """
    kept = similar(docs, block).where("doc_id = component_id").select(F.col("doc_id").alias("_kept"))
    return docs.join(kept, F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)) == kept["_kept"], "left_semi")
