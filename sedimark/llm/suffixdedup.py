"""Removal of long byte strings that an earlier document already has, by longest-previous-factor arrays.

A document loses each byte covered by a string of ``SPAN`` bytes that also starts in a document of smaller doc_id.

No suffix array over the corpus is ever built in one place. Every window of ``SPAN`` bytes has one minimizer: the first
position of the least hash among its ``GRAM``-byte substrings; neighbouring windows mostly share it. Equal windows have
equal minimizers at equal places, so windows can be compared apart for each minimizer value:

1. Documents lie in groups of about 4 MB, dealt once and kept as a table bucketed by group. Each group gives the
   distinct hashes of its minimizers, a row each; sorted by hash, those that occur in two or more documents go back to
   the groups that hold them. Whole copies of a text are settled before, by digest.
2. Each group gives, for its occurrences of those hashes, the text around them that holds the windows of it: one row
   for each distinct context of the group, by its smallest doc_id, with a list of places. Places of a document at most
   ``SPAN`` bytes apart are one entry, so a text of a short period takes no more rows than any other.
3. Sorted by hash, contexts stream through the tasks. For each hash with different contexts a suffix array over their
   windows is sorted to depth ``SPAN``, ties by document; previous and next smaller positions of the document order with
   the LCP array give each window's longest previous factor, and windows with one of ``SPAN`` bytes are marked. Of equal
   contexts the smallest doc_id stands for all. A hash with more than ``HOT`` occurrences is dealt out by its windows'
   own hashes, not by the minimizer, so a task holds at most ``HOT`` different contexts of one hash.
4. Marked windows return to their documents, which drop the bytes they cover.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimark.llm.common import NULL_ID, bucketed, drop_written, given_back, groups_for, raw, written

SPAN, GRAM = 50, 24
REACH = SPAN - GRAM  # bytes before a minimizer that its windows can take in
CONTEXT = REACH + SPAN
WINDOWS = REACH + 1
#: Occurrences of one minimizer value beyond which its windows are dealt out one by one.
HOT = 5_000
#: UTF-8 bytes of text in one group of documents.
GROUP = 4 << 20
#: Most buckets of the table of groups, which may hold several groups each.
BUCKETS = 100_000
#: Minimizers whose contexts are cut out at once, and contexts that are held before equal ones are combined.
STEP, HELD = 1 << 15, 1 << 17
#: Suffixes that are sorted at once.
SORTED = 250_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)


def _slide(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return np.minimum(x[: -(width - done)], x[width - done :]) if done < width else x


def _stir(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= _MIX2
    return h ^ (h >> np.uint64(29))


Minimizers = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def minimizers(text: np.ndarray, step: int = 1 << 20) -> Iterator[Minimizers]:
    """Hashes (56 bits) and positions of the minimizers of a text (uint8), and the first and last start of the windows of
    each, in pieces.

    What a position is depends on the ``SPAN`` bytes on its two sides alone, so a long text is taken ``step`` bytes at a time.
    """
    if len(text) <= step + 2 * SPAN:
        yield _minimizers(text)
        return
    for first in range(0, len(text), step):
        low = max(0, first - SPAN)
        h, *places = _minimizers(text[low : first + step + SPAN])
        own = (places[0] + low >= first) & (places[0] + low < first + step)
        yield h[own], *(x[own] + low for x in places)


def _minimizers(text: np.ndarray) -> Minimizers:
    if len(text) < SPAN:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    with np.errstate(over="ignore"):
        h, m, done = text.astype(np.uint64) + np.uint64(1), _MIX, 1
        while done * 2 <= GRAM:
            h = h[:-done] * m + h[done:]
            m, done = m * m, done * 2
        if done < GRAM:  # of two that overlap
            h = h[: done - GRAM] * m + h[GRAM - done :]
        h = _stir(h)
    # the least hash with the first position, as one number for each window
    owner = _slide((h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64), WINDOWS) & np.uint64(0xFFFFFFFF)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    at = owner[first].astype(np.int64)
    return h[at] >> np.uint64(8), at, first, np.r_[first[1:], len(owner)] - 1


def smaller_neighbours(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position the nearest one before, and after, with a smaller value; -1 and n where there is none."""
    n = len(order)
    order = np.unique(order, return_inverse=True)[1].ravel() if n else np.zeros(0, np.int64)  # from 0: -1 is below all
    result = []
    for values in (order, order[::-1]):
        padded = np.r_[np.array([-1]), values]
        near = np.arange(n)  # positions in padded: one before each
        open_ = np.flatnonzero(padded[near] >= values)
        while len(open_):  # a larger or equal neighbour's own answer is the next to try
            near[open_] = near[near[open_] - 1]
            open_ = open_[padded[near[open_]] >= values[open_]]
        result.append(near - 1)
    return result[0], n - 1 - result[1][::-1]


def _least_between(lcp: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of lcp[low + 1 .. high] for each pair low < high, by a table of powers of two."""
    size = np.frexp((high - low).astype(float))[1] - 1
    levels = [lcp]
    for k in range(int(size.max(initial=0))):
        last = levels[-1]
        levels.append(np.minimum(last[: -(1 << k)], last[1 << k :]))
    out = np.zeros(len(low), lcp.dtype)
    for k in np.unique(size):
        own = size == k
        out[own] = np.minimum(levels[k][low[own] + 1], levels[k][high[own] + 1 - (1 << int(k))])
    return out


def previous_factors(windows: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Longest previous factors, at most the window's length, of windows (n x SPAN bytes) in documents ordered by doc.

    The suffix array is sorted to the window's depth, ties by document. A window's longest match in a smaller document
    is with its previous or its next smaller position in suffix order; the LCP is the least between the two.
    """
    n, depth = windows.shape
    if not n:
        return np.zeros(0, np.int64)
    first = np.argsort(doc, kind="stable")
    flat = np.ascontiguousarray(windows[first]).view(f"S{depth}").ravel()
    array = first[np.argsort(flat, kind="stable")]
    rows, rank = windows[array], doc[array]
    lcp = np.zeros(n + 1, np.uint8)  # lcp[i]: of suffixes i - 1 and i
    step = rows[1:] != rows[:-1]
    lcp[1:n] = np.where(step.any(1), step.argmax(1), depth)
    before, after = smaller_neighbours(rank)
    out = np.zeros(n, np.int64)
    own = np.flatnonzero(before >= 0)
    out[own] = _least_between(lcp, before[own], own)
    own = np.flatnonzero(after < n)
    out[own] = np.maximum(out[own], _least_between(lcp, own, after[own]))
    factor = np.zeros(n, np.int64)
    factor[array] = out
    return factor


#: Kinds of rows that go to a group: (doc_id, digest) of a copy; (hash, whether it is hot) of a shared minimizer;
#: (windows where a smaller document of the group has the context too, other windows, places) of marks.
_COPIES, _SHARED, _MARKS = 0, 1, 2
_CARRY = "carried_"
_SIDE = "grp int, kind int, x long, y long, places binary"
_U64 = np.uint64


def _side(grp, kind: int, x: np.ndarray, y: np.ndarray, places: pa.Array | None = None) -> pa.RecordBatch:
    n = len(x)
    columns = [pa.array(grp, pa.int32()), pa.array(np.full(n, kind, np.int32)), pa.array(x.view(np.int64)), pa.array(y.view(np.int64)), pa.nulls(n, pa.binary()) if places is None else places]
    return pa.RecordBatch.from_arrays(columns, ["grp", "kind", "x", "y", "places"])


def _longs(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.to_numpy().view(_U64)


class _Group:
    """The documents of one group in a fixed order, without texts that are whole copies; and what came for it."""

    def __init__(self, table: pa.Table, side: pa.Table):
        bytes_, at = raw(table.column("text"))
        ids, sha = table.column("doc_id").to_numpy(), table.column("sha8").to_numpy()
        self.order = order = np.lexsort((sha, ids))
        self.ids, self.bytes, self.start, self.size = ids[order], bytes_, at[:-1][order], np.diff(at)[order]
        kind = side.column("kind").to_numpy()
        self.side = {k: side.filter(pa.array(kind == k)) for k in (_COPIES, _SHARED, _MARKS)}
        copies = set(zip(*(self.side[_COPIES].column(c).to_pylist() for c in "xy")))
        self.copy = np.array([x in copies for x in zip(self.ids.tolist(), sha[order].tolist())], bool) if copies else np.zeros(len(ids), bool)

    def text(self, i: int) -> np.ndarray:
        return self.bytes[self.start[i] : self.start[i] + self.size[i]]

    def minimizers(self) -> Iterator[tuple[int, Minimizers]]:
        """Pieces of each document's minimizers; a document's own follow each other."""
        for i in np.flatnonzero(~self.copy & (self.size >= SPAN)).tolist():
            for piece in minimizers(self.text(i)):
                yield i, piece


def _gather_hashes(key, docs: pa.Table, side: pa.Table) -> pa.Table:
    """Step 1: the distinct minimizer hashes of a group, with the group, how often each occurs, and whether in several documents (lowest bit)."""
    of: list[tuple[int, np.ndarray, np.ndarray]] = []
    for i, (h, *_) in _Group(docs, side).minimizers():
        if of and of[-1][0] == i:  # a further piece of a long document
            _, v, n = of.pop()
            u, m = np.unique(h, return_counts=True)
            values, where = np.unique(np.concatenate([v, u]), return_inverse=True)
            of.append((i, values, np.bincount(where, np.concatenate([n, m]), len(values)).astype(np.int64)))
        else:
            of.append((i, *np.unique(h, return_counts=True)))
    every = np.concatenate([v for _, v, _ in of]) if of else np.zeros(0, _U64)
    values, where, docs_ = np.unique(every, return_inverse=True, return_counts=True)
    times = np.bincount(where, np.concatenate([n for _, _, n in of]) if of else None, len(values)).astype(np.int64)
    held = np.int64(key[0].as_py() << 32) | np.minimum(times, 1 << 30) << 1 | (docs_ > 1)
    return pa.table([pa.array(values.view(np.int64)), pa.array(held)], ["h", "held"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows, sorted by h, in tables that hold every row of their hashes."""
    open_: list[pa.RecordBatch] = []  # rows of the last hash so far
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        if h[0] != h[-1]:
            last = int(np.searchsorted(h == h[-1], True))
            yield pa.Table.from_batches([*open_, batch.slice(0, last)])
            open_ = [batch.slice(last)]
        elif not open_ or open_[-1].column("h")[0].as_py() == h[0]:
            open_.append(batch)
        else:
            yield pa.Table.from_batches(open_)
            open_ = [batch]
    if open_:
        yield pa.Table.from_batches(open_)


def _shared_hashes(hot: int):
    """Step 1: the hashes found in two or more documents, for each group that has them; rows come sorted by h."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            h, held = table.column("h").to_numpy(), table.column("held").to_numpy()
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            size = np.diff(np.r_[start, len(h)])
            times = np.add.reduceat((held & 0xFFFFFFFF) >> 1, start)
            keep = np.repeat((size > 1) | (held[start] & 1 > 0), size)
            yield _side((held >> 32)[keep].astype(np.int32), _SHARED, h[keep], np.repeat((times > hot).astype(np.int64), size)[keep])

    return run


def _context_rows(text: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes around minimizers that their windows cover (other bytes zero), and a bit for each of these windows."""
    low, high = max(0, int(at[0]) - REACH), min(len(text), int(at[-1]) + SPAN)
    padded = np.zeros(int(at[-1]) - int(at[0]) + CONTEXT, np.uint8)
    padded[low - (int(at[0]) - REACH) :][: high - low] = text[low:high]
    rows = np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[at - at[0]]
    first, last = first - at + REACH, last - at + REACH
    column, begin, end = np.arange(CONTEXT, dtype=np.uint8), first.astype(np.uint8)[:, None], (last + SPAN).astype(np.uint8)[:, None]
    rows *= (column >= begin) & (column < end)
    one = _U64(1)
    return rows, ((one << (last + 1).astype(_U64)) - one) & ~((one << first.astype(_U64)) - one)


def _row_hash(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of bytes."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    with np.errstate(over="ignore"):
        h = np.zeros(len(rows), _U64)
        for word in wide.view(_U64).T:
            h = _stir((h + word) * _MIX)
    return h


def _bits(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bit) of every set bit."""
    return np.nonzero((masks[:, None] >> np.arange(WINDOWS, dtype=_U64)) & _U64(1))


class _Contexts:
    """The distinct contexts of a group, and the places of each: (context, document, first, last position).

    ``row`` numbers a context's smallest document. Equal contexts are combined whenever ``HELD`` of them are new.
    """

    def __init__(self):
        self.h, self.row, self.inside = np.zeros(0, _U64), np.zeros(0, np.int64), np.zeros(0, _U64)
        self.text = np.zeros((0, CONTEXT), np.uint8)
        self.places = np.zeros((0, 4), np.int64)
        self._new: list[tuple] = []
        self._count = 0

    def add(self, h: np.ndarray, row: int, at: np.ndarray, inside: np.ndarray, text: np.ndarray) -> None:
        self._new.append((h, np.full(len(h), row), at, inside, text))
        self._count += len(h)
        if self._count >= HELD:
            self.fold()

    def fold(self) -> None:
        if not self._count:
            return
        h, row, at, inside, text = (np.concatenate(x) for x in zip(*self._new))
        places = np.column_stack([len(self.h) + np.arange(len(h)), row, at, at])
        h, row = np.concatenate([self.h, h]), np.concatenate([self.row, row])
        inside, text = np.concatenate([self.inside, inside]), np.concatenate([self.text, text])
        places = np.concatenate([self.places, places])
        self._new, self._count = [], 0
        order = np.lexsort((row, inside, _row_hash(text), h))
        a, b = order[:-1], order[1:]
        new = np.ones(len(order), bool)
        new[1:] = (h[a] != h[b]) | (inside[a] != inside[b])
        for k in range(1, len(order), 1 << 16):
            new[k : k + (1 << 16)] |= (text[a[k - 1 : k - 1 + (1 << 16)]] != text[b[k - 1 : k - 1 + (1 << 16)]]).any(1)
        one = order[new]
        number = np.empty(len(h), np.int64)
        number[order] = np.cumsum(new) - 1
        self.h, self.row, self.inside, self.text = h[one], row[one], inside[one], text[one]
        places[:, 0] = number[places[:, 0]]
        places = places[np.lexsort((places[:, 2], places[:, 1], places[:, 0]))]
        # windows of one context at most SPAN bytes apart cover one stretch
        far = np.r_[True, (places[1:, :2] != places[:-1, :2]).any(1) | (places[1:, 2] - places[:-1, 3] > SPAN)]
        start = np.flatnonzero(far)
        self.places = np.column_stack([places[start, :3], np.maximum.reduceat(places[:, 3], start)])


def _contexts(key, docs: pa.Table, side: pa.Table) -> pa.Table:
    """Step 2: (h, inside, text, doc, grp, places) of each distinct context of the group, as its smallest document has it.

    places: (row, first, last) of each stretch as unsigned 32-bit numbers, the highest bit of row set where another doc_id has it.
    """
    group, found = _Group(docs, side), _Contexts()
    shared, heat = (_longs(group.side[_SHARED].column(c)) for c in "xy")
    order = np.argsort(shared)
    shared, heat = shared[order], heat[order] > 0
    for i, piece in group.minimizers() if len(shared) else ():
        near = np.minimum(np.searchsorted(shared, piece[0]), len(shared) - 1)
        keep = shared[near] == piece[0]
        hot, text = heat[near[keep]], group.text(i)
        cold = [x[keep][~hot] for x in piece]
        for k in range(0, len(cold[0]), STEP):
            h, at, first, last = (x[k : k + STEP] for x in cold)
            rows, inside = _context_rows(text, at, first, last)
            found.add(h, i, at, inside, rows)
        first, last = (x[keep][hot] for x in piece[2:])
        for k in range(0, len(first), STEP // WINDOWS):
            # one context for each window of a hot minimizer, keyed by the window itself
            size = (last - first + 1)[k : k + STEP // WINDOWS]
            start = np.repeat(first[k : k + STEP // WINDOWS] - np.cumsum(size) + size, size) + np.arange(size.sum())
            wide = np.zeros((len(start), CONTEXT), np.uint8)
            wide[:, :SPAN] = np.lib.stride_tricks.sliding_window_view(text, SPAN)[start]
            found.add(_row_hash(wide) >> _U64(8), i, start + REACH, np.ones(len(start), _U64), wide)
    found.fold()
    n, p = len(found.h), found.places
    doc = group.ids[found.row] if n else np.zeros(0, np.int64)
    later = group.ids[p[:, 1]] != doc[p[:, 0]] if n else np.zeros(0, bool)
    packed = np.column_stack([p[:, 1] | later.astype(np.int64) << 31, p[:, 2], p[:, 3]]).astype("<u4")
    cut = np.searchsorted(p[:, 0], np.arange(n + 1)) * 12
    places = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())])
    text = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * CONTEXT).astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(found.text).tobytes())])
    columns = [pa.array(found.h.view(np.int64)), pa.array(found.inside.view(np.int64)), text, pa.array(doc), pa.array(np.full(n, key[0].as_py(), np.int32)), places]
    return pa.table(columns, ["h", "inside", "text", "doc", "grp", "places"])


_CONTEXT = "h long, inside long, text binary, doc long, grp int, places binary"


def _marked(h: np.ndarray, doc: np.ndarray, inside: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The windows of distinct contexts, sorted by h, that a smaller document has in another context of the same hash."""
    marks = np.zeros(len(h), _U64)
    start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.r_[start, len(h)])
    need = np.flatnonzero(np.repeat(size > 1, size))
    ends = np.cumsum(size[size > 1])
    first = 0
    while first < len(need):
        # whole minimizers up to the bound; a larger one is sorted at once, as it has at most HOT contexts
        last = int(ends[max(np.searchsorted(ends, first + SORTED // WINDOWS, "right") - 1, np.searchsorted(ends, first, "right"))])
        own = need[first:last]
        r, w = _bits(inside[own])
        windows = np.lib.stride_tricks.sliding_window_view(text[own], SPAN, axis=1)[r, w]
        hit = previous_factors(windows, doc[own][r]) >= SPAN
        np.bitwise_or.at(marks, own[r[hit]], _U64(1) << w[hit].astype(_U64))
        first = last
    return marks


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3: marks for the groups; contexts come sorted by h, inside, text and doc."""
    for table in _runs(batches):
        h, inside, doc = _longs(table.column("h")), _longs(table.column("inside")), table.column("doc").to_numpy()
        text = raw(table.column("text"))[0].reshape(-1, CONTEXT)
        new = np.r_[True, (h[1:] != h[:-1]) | (inside[1:] != inside[:-1]) | (text[1:] != text[:-1]).any(1)]
        run, one = np.cumsum(new) - 1, np.flatnonzero(new)  # the first of equal contexts has the smallest doc_id
        marks = _marked(h[one], doc[one], inside[one], text[one])
        own = np.where(doc > doc[one][run], inside, marks[run])
        packed, at = raw(table.column("places"))
        later = np.bitwise_or.reduceat(packed.view("<u4").reshape(-1, 3)[:, 0], at[:-1] // 12) >> np.uint32(31)
        keep = np.flatnonzero((own > 0) | (later > 0))
        kept = table.take(pa.array(keep)).combine_chunks()
        if len(keep):
            yield _side(kept.column("grp").to_numpy(), _MARKS, inside[keep], own[keep], kept.column("places").chunk(0))


def covered(size: int, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, int]:
    """Which of ``size`` bytes the stretches first..last (ends excluded) cover, and in how many runs."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
    return gone, int(np.count_nonzero(gone & ~np.r_[False, gone[:-1]]))


def _stretches(marks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, end) of what marks cover, sorted by row. The marked windows of one context overlap, so each place covers one stretch."""
    if not marks.num_rows:
        return (np.zeros(0, np.int64),) * 3
    packed, at = raw(marks.column("places"))
    place = packed.view("<u4").reshape(-1, 3)
    of = np.repeat(np.arange(marks.num_rows), np.diff(at) // 12)
    mask = np.where(place[:, 0] >> np.uint32(31) > 0, _longs(marks.column("x"))[of], _longs(marks.column("y"))[of])
    place, mask = place[mask > 0].astype(np.int64), mask[mask > 0]
    low = np.frexp((mask & (~mask + _U64(1))).astype(float))[1] - 1
    high = np.frexp(mask.astype(float))[1] - 1  # under 2^35: exact
    row = place[:, 0] & 0x7FFFFFFF
    order = np.argsort(row, kind="stable")
    return row[order], (place[:, 1] - REACH + low)[order], (place[:, 2] - REACH + high + SPAN)[order]


def _cut(key, docs: pa.Table, side: pa.Table, as_text: bool) -> pa.Table:
    """Step 4: every document of a group, with its further columns, without its marked windows."""
    group = _Group(docs, side)
    row, first, last = _stretches(group.side[_MARKS])
    bound = np.searchsorted(row, np.arange(len(group.ids) + 1))
    out: list[list] = [[], [], []]
    for i in range(len(group.ids)):
        text = group.text(i)
        gone, spans = np.zeros(0, bool), 0
        if group.copy[i] and len(text) >= SPAN:
            gone, spans = np.ones(len(text), bool), 1
        elif bound[i] < bound[i + 1]:
            own = slice(bound[i], bound[i + 1])
            gone, spans = covered(len(text), first[own], last[own])
        kept = text[~gone] if spans else text
        out[0].append(len(text) - len(kept))
        out[1].append(spans)
        out[2].append(kept.tobytes().decode("utf-8", "ignore") if as_text else kept.tobytes())
    columns = [pa.array(group.ids), pa.array(group.size), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string() if as_text else pa.binary())]
    carried = docs.select([c for c in docs.column_names if c.startswith(_CARRY)]).take(pa.array(group.order))
    return pa.table([*columns, *carried.columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *carried.column_names])


def _removed(docs: DataFrame, carry: list[str], group_bytes: int, hot: int, as_text: bool) -> DataFrame:
    """The result of remove_repeats(), with a stand-in for null ids, then the columns of ``carry`` as carried_0, carried_1, ..."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = docs.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))).first()[0]
    groups = max(groups_for(total, group_bytes), parts)
    carried = {c: f"{_CARRY}{k}" for k, c in enumerate(carry)}
    text = F.coalesce(docs["text"], F.lit(""))
    whole = docs.select(
        F.coalesce(docs["doc_id"].cast("long"), F.lit(NULL_ID)).alias("doc_id"),
        text.cast("binary").alias("text"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        *(docs[c].alias(name) for c, name in carried.items()),
    )
    # by id, text and input partition: rows that share an id, or are equal, don't meet in one group
    group = F.pmod(F.xxhash64("doc_id", "sha", F.spark_partition_id()), F.lit(groups)).cast("int").alias("grp")
    sha8 = F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("long").alias("sha8")
    held = bucketed(whole.select("*", group, sha8), "texts", min(groups, BUCKETS), "grp")
    least = held.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    least = written(least, "firsts")  # a table of its own: Spark then splits a digest that many texts share
    copies = held.select("sha", "doc_id", "grp", "sha8").join(least, "sha").where("doc_id > first")
    copies = copies.select("grp", F.lit(_COPIES).alias("kind"), F.col("doc_id").alias("x"), F.col("sha8").alias("y"), F.lit(None).cast("binary").alias("places")).distinct()
    copies = written(copies, "copies")
    drop_written(spark, least)

    texts = held.drop("sha").groupBy("grp")
    plain = held.select("grp", "doc_id", "text", "sha8").groupBy("grp")
    hashes = plain.cogroup(copies.groupBy("grp")).applyInArrow(_gather_hashes, "h long, held long")
    hashes = hashes.repartition("h").sortWithinPartitions("h").mapInArrow(_shared_hashes(hot), _SIDE)
    shared = written(hashes, "shared")
    contexts = plain.cogroup(shared.unionByName(copies).groupBy("grp")).applyInArrow(_contexts, _CONTEXT)
    contexts = contexts.repartition("h").sortWithinPartitions("h", "inside", "text", "doc")
    marks = written(contexts.mapInArrow(_marks, _SIDE), "marks")
    drop_written(spark, shared)
    out = T.StructType.fromDDL(f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}")
    out = T.StructType([*out.fields, *(T.StructField(name, docs.schema[c].dataType) for c, name in carried.items())])
    return texts.cogroup(marks.unionByName(copies).groupBy("grp")).applyInArrow(lambda key, left, right: _cut(key, left, right, as_text), out)


def remove_repeats(docs: DataFrame, group_bytes: int = GROUP, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) for every row of ``docs``.

    kept: the bytes that no ``SPAN``-byte string starting in a document of smaller doc_id covers; cuts may fall inside
    a code point. n_spans: maximal removed runs. Null text: empty. Strings are judged on the input. A null doc_id
    counts as the smallest; rows that share an id never remove from each other. Texts under ``SPAN`` bytes are kept.
    Other columns are ignored; an empty table gives an empty result.
    """
    return _removed(docs, [], group_bytes, hot, False)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with the text of every row less its repeated strings.

    Bytes of a code point that a cut went through are dropped too, so that the text stays valid UTF-8. n_chars, where
    the table has it, follows the text. A null doc_id stays null; null text becomes empty.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    of = {c: F.col(f"{_CARRY}{k}").alias(c) for k, c in enumerate(others)}
    of |= {"doc_id": given_back().cast(docs.schema["doc_id"].dataType).alias("doc_id"), "text": F.col("kept").alias("text")}
    if "n_chars" in of:
        of["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return _removed(docs, others, GROUP, HOT, True).select(*(of[c] for c in docs.columns))


def digests(removed: DataFrame) -> DataFrame:
    """The result of remove_repeats() with the kept bytes as their SHA-256."""
    return removed.select(given_back(), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Every 50-byte string with the smallest doc_id in which it starts; spans of the strings that a smaller one has.
ORACLE = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS id, hex(encode(coalesce(text, ''))) AS h FROM documents
), starts AS (
  SELECT r, id, h, unnest(range(0, length(h) // 2 - 49)) AS s FROM docs WHERE length(h) >= 100
), strings AS (
  SELECT r, id, s, substring(h, 2 * s + 1, 100) AS g FROM starts
), firsts AS (
  SELECT g, min(id) AS first FROM strings GROUP BY g HAVING count(*) > 1
), marked AS (
  SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS p FROM strings JOIN firsts USING (g) WHERE id > first
), runs AS (
  SELECT r, s, sum(CASE WHEN p IS NULL OR s > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY s) AS k FROM marked
), spans AS (
  SELECT r, min(s) AS a, max(s) + 50 AS z FROM runs GROUP BY r, k
), gaps AS (
  SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS y FROM spans
), cut AS (
  SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last, string_agg(substring(h, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS kept FROM gaps JOIN docs USING (r) GROUP BY r
)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substring(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs d LEFT JOIN cut USING (r)
"""
