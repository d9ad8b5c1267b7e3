"""Byte-level BPE by forced-boundary splitting.

A pair of bytes that occurs inside no vocabulary token can never be joined, so every place between such a pair is a
certain cut: no token spans it, and merges on its two sides do not affect each other. A text is cut at all such places
(where the pre-tokenizer, too, decides the same on both sides), its fragments are encoded independently, each distinct
fragment once, and the ids are concatenated.

Places at which the pre-tokenizer could look across the cut stay uncut: after white space (a run of it is split by
what follows) and on either side of an apostrophe (contractions). A place inside a code point is never a cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from sedimark.llm.common import portions, raw

#: Distinct fragments that one task remembers before it starts afresh.
REMEMBERED = 300_000
#: Fragments of one very long text that are encoded at once.
BLOCK = 1_000_000


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable ones as themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Splitter:
    """Where a text may certainly be cut, by the vocabulary of a byte-level BPE tokenizer."""

    def __init__(self, tokens: list[bytes]):
        inside = np.zeros((256, 256), bool)
        for token in tokens:
            b = np.frombuffer(token, np.uint8)
            inside[b[:-1], b[1:]] = True
        inside[:, 0x80:0xC0] = True  # continuation bytes
        inside[ord("'"), :] = inside[:, ord("'")] = True
        for c in filter(str.isspace, map(chr, range(0x80))):
            inside[ord(c), :] = True
        for c in (0x1C, 0x1D, 0x1E, 0x1F):
            inside[c, :] = True
        self.uncut = inside.ravel()
        # white space of several bytes, by its last two bytes
        self.blank = np.zeros(1 << 16, bool)
        for c in filter(str.isspace, map(chr, range(0x80, 0x3001))):
            self.blank[c.encode()[-2] * 256 + c.encode()[-1]] = True

    def cuts(self, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Offsets at which fragments begin, in bytes of several texts that begin at ``starts``."""
        if len(text) < 2:
            return np.unique(starts[starts < len(text)])
        pair = (text[:-1].astype(np.uint16) << 8) | text[1:]
        cut = np.zeros(len(text), bool)
        cut[1:] = ~self.uncut[pair]
        cut[2:] &= ~self.blank[pair[:-1]]
        cut[starts[starts < len(text)]] = True
        return np.flatnonzero(cut)


class Codec:
    """Encodes and decodes with a tokenizer's file; one for each task."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        added = self.tokenizer.get_added_tokens_decoder()
        self.tokens: dict[int, bytes] = {}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.tokens[i] = token.encode() if i in added else bytes(alphabet[c] for c in token)
        self.decimal = {i: str(i) for i in self.tokens}
        self.splitter = Splitter(list(self.tokens.values()))
        self.known: dict[bytes, tuple[int, ...]] = {}

    def learn(self, fragments: list[bytes]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set(fragments).difference(self.known))
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            for fragment, got in zip(part, self.tokenizer.encode_batch([x.decode() for x in part], add_special_tokens=False)):
                self.known[fragment] = tuple(got.ids)

    def encode(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[list[int]]:
        """The ids of each of several texts lying one after another in ``text``."""
        at = self.splitter.cuts(text, starts)
        whole, at = text.tobytes(), np.r_[at, len(text)]
        bounds = list(zip(np.searchsorted(at, starts).tolist(), np.searchsorted(at, ends).tolist()))
        if len(bounds) > 1 or not bounds or bounds[0][1] - bounds[0][0] <= BLOCK:
            place = at.tolist()
            fragments = [whole[i:j] for i, j in zip(place, place[1:])]
            self.learn(fragments)
            known = self.known
            for i, j in bounds:
                yield [x for f in fragments[i:j] for x in known[f]]
            return
        ids: list[int] = []  # one very long text: block by block
        for k in range(*bounds[0], BLOCK):
            place = at[k : min(k + BLOCK, bounds[0][1]) + 1].tolist()
            fragments = [whole[i:j] for i, j in zip(place, place[1:])]
            self.learn(fragments)
            ids += [x for f in fragments for x in self.known[f]]
        yield ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row: encoded without added specials, then decoded.

    ids_sha256: of the decimal ids joined by commas. Null text: empty, no tokens. Special tokens' strings in a text
    are those tokens, as the tokenizer's file defines. ``path``: the tokenizer's file, on every executor. Other
    columns are ignored; an empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for part in portions(batches, "text", 2 << 20):
            text, at = raw(part.column("text"))
            out: list[list] = [[], [], []]
            for ids in own.encode(text, at[:-1], at[1:]):
                out[0].append(len(ids))
                out[1].append(hashlib.sha256(",".join(map(own.decimal.__getitem__, ids)).encode()).hexdigest())
                out[2].append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
