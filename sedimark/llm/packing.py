"""Vector bin packing of documents into token sequences by the dot-product heuristic.

A piece of a document needs (tokens, segments, loss-bearing tokens); a sequence offers (length, ``SEGMENTS``,
``LOSS``). Loss-bearing are the tokens that hold a letter, a digit or a character beyond ASCII; bare punctuation and the
closing token bear none. Of the open sequences that can take a whole piece, the one whose remaining room has the largest dot product
with the piece's needs takes it. Pieces may be cut: a piece that fits nowhere whole fills the fullest open sequence
and the rest goes on. The last segment of a sequence is only given to a piece that fills it, so no sequence ends short
for want of segments. When a task's documents end, what is still open is merged by cutting and closed at powers of
two, which need no padding.

Packing is local to the partitions of the input: no shuffle, no state that grows, and nothing that depends on how the
rows are spread over keys. A sequence's id is its task's partition number times 2^40 plus its number there.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from sedimark.llm.bpe import byte_alphabet
from sedimark.llm.common import portions, texts

LENGTH, END = 2048, 1
#: Pieces in one sequence, loss-bearing tokens in one sequence, and open sequences of a task.
SEGMENTS, LOSS, OPEN = 64, 2000, 48
_REMEMBERED = 400_000


#: Texts of these characters need no Unicode normalisation, and lower-casing them never depends on their neighbours.
_PLAIN = re.compile("[\\x09-\\x0d\\x20-\\x7e\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]*+")
#: The words of such a text, as the tokenizer's own pattern cuts them.
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\\xdf-\\xf6\\xf8-\\xff]+|[0-9]|[^\\x09-\\x0d\\x20a-z0-9\\xdf-\\xf6\\xf8-\\xff]+")


#: The normaliser and the splitter that these two patterns stand for; with others every text goes to the library.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
_SPLITTER = {"type": "Sequence", "pretokenizers": [_SPLIT, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


#: Bytes of one text that are encoded at once.
LONG = 8 << 20


def _cut_at_space(text: bytes) -> Iterator[bytes]:
    """Pieces of about half of ``LONG`` that begin at ASCII white space; a longer run without any stays whole."""
    first = 0
    while first < len(text):
        found = _BYTE_SPACE.search(text, first + LONG // 2)
        last = found.start() if found else len(text)
        yield text[first:last]
        first = last


_BYTE_SPACE = re.compile(rb"[\x09-\x0d\x20]")
_ASCII_SPACE = re.compile("[\\x09-\\x0d\\x20]+")


class WordCodec:
    """Ids by a lower-casing tokenizer that drops white space and ends words with a suffix.

    A text of plain letters is cut into words here, and new words go to the tokenizer's model together, without its
    normaliser, which has nothing to do for them. In other texts only the chunks between ASCII white space that are
    not plain go to the tokenizer as they are: white space is never inside a token. Of known words and chunks two
    generations are held; those in use move to the younger. All this holds for one way to normalise and split; a file
    that states another has its texts encoded by the library as they are.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        bare = json.loads(self.tokenizer.to_str())
        suffix = bare["model"].get("end_of_word_suffix") or ""
        self.known = bool(suffix) and bare["normalizer"] == _NORMALIZER and bare["pre_tokenizer"] == _SPLITTER
        self.special = [t["content"] for t in bare["added_tokens"]]
        bare |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}
        self.model = Tokenizer.from_str(json.dumps(bare))
        vocabulary = bare["model"]["vocab"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        of = byte_alphabet()
        self.alphabet = {b: c for c, b in of.items()} | {32: " "}
        #: Whether a token bears loss, by its id.
        self.bearing = np.ones(1 + max([*vocabulary.values(), *(t["id"] for t in json.loads(self.tokenizer.to_str())["added_tokens"])]), bool)
        self.bearing[[i for t, i in vocabulary.items() if all(of.get(c, 128) < 128 and not chr(of[c]).isalnum() for c in t.removesuffix(suffix))]] = False
        self.chunks: list[dict[str, bytes]] = [{}, {}]
        self.words: list[dict[str, bytes]] = [{}, {}]

    @staticmethod
    def _unknown(held: list[dict], wanted: set) -> list:
        if len(held[0]) > _REMEMBERED:
            held[:] = [{}, held[0]]
        young, old = held
        new = wanted.difference(young)
        young.update((x, old[x]) for x in new.intersection(old))
        return list(new.difference(young))

    def _learn_words(self, wanted: set[str]) -> None:
        new = self._unknown(self.words, wanted)
        known = self.words[0]
        for k in range(0, len(new), 1000):
            part = new[k : k + 1000]
            line = " ".join(part).encode().decode("latin-1").translate(self.alphabet)
            ids = np.array(self.model.encode(line, add_special_tokens=False).ids, "<u4")
            end = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(end) != len(part):
                raise ValueError("the tokenizer does not end each word with its suffix")
            whole, first = ids.tobytes(), 0
            for w, j in zip(part, end):
                known[w] = whole[first:j]
                first = j

    def _plain(self, s: str) -> bool:
        return _PLAIN.fullmatch(s) is not None and not ("<" in s and any(x in s for x in self.special))

    def _mixed(self, text: str) -> bytes:
        out = []
        for chunk in filter(None, _ASCII_SPACE.split(text)):
            if self._plain(chunk):
                words = _WORDS.findall(chunk.lower())
                self._learn_words(set(words))
                out += map(self.words[0].__getitem__, words)
            else:
                young, old = self.chunks
                ids = young.get(chunk) or old.get(chunk) or np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
                if len(young) > _REMEMBERED:
                    self.chunks = [{}, young]
                self.chunks[0][chunk] = ids
                out.append(ids)
        return b"".join(out)

    def encode(self, texts_: list[bytes]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; a very long one is cut at white space."""
        if not self.known:
            yield from (np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch([t.decode() for t in texts_], add_special_tokens=False))
        elif len(texts_) == 1 and len(texts_[0]) > LONG:
            yield b"".join(x for part in _cut_at_space(texts_[0]) for x in self._encode([part]))
        else:
            yield from self._encode(texts_)

    def _encode(self, texts_: list[bytes]) -> Iterator[bytes]:
        decoded = [t.decode() for t in texts_]
        words = [_WORDS.findall(s.lower()) if self._plain(s) else None for s in decoded]
        self._learn_words(set().union(*(w for w in words if w)))
        known = self.words[0]
        ready = [None if w is None else b"".join(map(known.__getitem__, w)) for w in words]
        for s, ids in zip(decoded, ready):
            yield self._mixed(s) if ids is None else ids


@lru_cache(2)
def word_codec(path: str) -> WordCodec:
    return WordCodec(path)


@dataclass
class _Bin:
    number: int
    pieces: list = field(default_factory=list)  # (item, start, length, running count of loss-bearing tokens)


class Packer:
    """Places items of (tokens, loss tokens) into sequences; done sequences are handed to ``emit``."""

    def __init__(self, emit: Callable[[int, list], None], length: int = LENGTH, segments: int = SEGMENTS, loss: int = LOSS, most_open: int = OPEN):
        self.emit, self.length, self.segments, self.loss, self.most_open = emit, length, segments, loss, most_open
        self.bins: list[_Bin] = []
        self.room = np.zeros((0, 3))  # tokens, segments, loss left in each open sequence
        self.count = 0

    def _open(self) -> int:
        self.bins.append(_Bin(self.count))
        self.count += 1
        self.room = np.vstack([self.room, [self.length, self.segments, self.loss]])
        return len(self.bins) - 1

    @staticmethod
    def _loss(bearing: np.ndarray | None, i: int, j: int) -> int:
        return j - i if bearing is None else int(bearing[j] - bearing[i])

    def _within(self, bearing: np.ndarray | None, start: int, n: int, room: float) -> int:
        """How many of ``n`` tokens from ``start`` on bear no more loss than ``room``."""
        if bearing is None:
            return int(min(n, room))
        return min(n, int(np.searchsorted(bearing[start : start + n + 1], bearing[start] + room, "right")) - 1)

    def _put(self, k: int, item, start: int, n: int, bearing: np.ndarray | None) -> None:
        self.bins[k].pieces.append((item, start, n, bearing))
        self.room[k] -= (n, 1, self._loss(bearing, start, start + n))
        if self.room[k, 0] <= 0 or self.room[k, 2] <= 0:
            b = self._take(k)
            self._emit(b.number, b.pieces)

    def _take(self, k: int) -> _Bin:
        self.room = np.delete(self.room, k, 0)
        return self.bins.pop(k)

    def _emit(self, number: int, pieces: list) -> None:
        self.emit(number, [p[:3] for p in pieces])

    def add(self, item, tokens: int, bearing: np.ndarray | None = None, start: int = 0) -> None:
        """Places tokens start..tokens of an item. bearing: running count of loss-bearing tokens (tokens + 1 numbers); all bear loss by default."""
        scale = np.array([self.length, self.segments, self.loss], float)
        while start < tokens:
            left = tokens - start
            whole = self._loss(bearing, start, tokens)
            if left < self.length:
                fits = (self.room[:, 0] >= left) & (self.room[:, 2] >= whole) & ((self.room[:, 1] > 1) | (self.room[:, 0] == left))
                if fits.any():
                    self._put(int(np.where(fits, (self.room / scale) @ (np.array([left, 1, whole]) / scale), -1).argmax()), item, start, left, bearing)
                    return
                if len(self.bins) < self.most_open:
                    fills = np.zeros(0, np.int64)
                else:
                    fills = np.flatnonzero((self.room[:, 0] <= left) | (self.room[:, 2] <= whole))
                    if not len(fills):  # all wait for a last, longer piece: one gives its rest back and is free again
                        self._break_up(int(self.room[:, 0].argmin()))
                        continue
                if len(fills):  # rather one whose tokens run out first than one whose loss does
                    short = self.room[fills, 2] * left < np.minimum(self.room[fills, 0], left) * whole
                    k = int(fills[(self.room[fills, 0] + self.length * short).argmin()])
                else:
                    k = self._open()
            else:
                k = self._open()
            n = self._within(bearing, start, int(min(left, self.room[k, 0])), self.room[k, 2])
            self._put(k, item, start, n, bearing)
            start += n

    def _cut(self, rest: list, size: int) -> list:
        """Takes pieces off the end of ``rest``: ``size`` tokens (a power of two), or fewer, a lower power, within the limits."""
        taken, bears, pieces = 0, 0, []
        while taken < size and rest and len(pieces) < self.segments:
            item, start, n, bearing = rest.pop()
            cut = self._within(bearing, start, min(n, size - taken), self.loss - bears)
            if cut < n:
                rest.append((item, start + cut, n - cut, bearing))
            if not cut:
                break
            pieces.append((item, start, cut, bearing))
            taken, bears = taken + cut, bears + self._loss(bearing, start, start + cut)
        over = taken - (1 << (taken.bit_length() - 1))
        while over:
            item, start, n, bearing = pieces.pop()
            back = min(n, over)
            rest.append((item, start + n - back, back, bearing))
            if back < n:
                pieces.append((item, start, n - back, bearing))
            over -= back
        return pieces

    def _break_up(self, k: int) -> None:
        b = self._take(k)
        rest = b.pieces[::-1]
        total = sum(p[2] for p in rest)
        self._emit(b.number, self._cut(rest, 1 << (total.bit_length() - 1)))
        for item, start, n, bearing in reversed(rest):
            self.add(item, start + n, bearing, start)

    def finish(self) -> None:
        """Empties the open sequences into full ones and powers of two, cutting pieces where a sequence ends."""
        rest = [p for b in self.bins for p in b.pieces][::-1]
        self.bins, self.room = [], self.room[:0]
        while rest:
            total = sum(p[2] for p in rest)
            self._emit(self.count, self._cut(rest, min(self.length, 1 << (total.bit_length() - 1))))
            self.count += 1


def pack(docs: DataFrame, path: str, length: int = LENGTH, segments: int = SEGMENTS, loss: int = LOSS, most_open: int = OPEN, bears: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): one row for each piece.

    A document's tokens are its ids by the tokenizer at ``path`` without added specials, then ``END``. Loss bear those
    with a letter, a digit or a character beyond ASCII, or those that ``bears`` marks: given a document's ids, a boolean
    for each; a sequence holds at most ``loss`` of them. Every token lies in exactly one piece, offsets in a sequence are
    gapless from 0, and a sequence has ``length`` tokens or a power of two, or fewer where its loss-bearing tokens or
    segments run out. Null text: empty, one token. Repeated rows are packed each. Other columns are ignored; an empty
    table gives an empty result. ``length`` is a power of two.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base, out = word_codec(path), TaskContext.get().partitionId() << 40, []

        def emit(number: int, pieces: list) -> None:
            at = 0
            for (doc_id, ids), start, n in pieces:
                out.append((doc_id, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), len(ids) // 4, base + number, at))
                at += n

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) or [()] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        packer, end = Packer(emit, length, segments, loss, most_open), np.array([END], "<u4").tobytes()
        marks = bears or own.bearing.__getitem__
        for part in portions(batches, "text", 4 << 20):
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), own.encode(texts(part.column("text")))):
                n = len(ids) // 4
                running = np.zeros(n + 2, np.int64)
                np.cumsum(marks(np.frombuffer(ids, "<u4")), out=running[1:-1])
                running[-1] = running[-2]  # the closing token bears none
                packer.add((doc_id, ids + end), n + 1, running)
            yield rows()
        packer.finish()
        yield rows()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, ", ".join(f"{c} long" for c in names))
