"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

Each block has features of its ancestors (tags, words of class, id and role, and whether it stands beside the page's
<article> or <main>) and of its text (length, share of links,
end mark). The field is trained by maximum likelihood on labelled pages (labelled_pages.py), once on the driver;
pages are decoded by Viterbi, each on its own, so pages never meet and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sedimark.llm import labelled_pages
from sedimark.llm.common import portions, texts
from sedimark.llm.dom import Block, blocks

PAGES, EPOCHS, RATE, PRIOR = 240, 25, 0.2, 1e-3


def block_features(all_blocks: list[Block]) -> list[list[str]]:
    """The feature names of each block of a page."""
    out = []
    holders = [t for t in ("in=main", "in=article") if any(t in b.path for b in all_blocks)]
    for b in all_blocks:
        n = len(b.text)
        # a page that has an <article> or <main> says by it what stands beside its text
        beside = [f"beside-{t}" for t in holders if t not in b.path]
        out.append([
            "any", *b.path, *beside, f"own={b.own}", f"size={min(8, n.bit_length())}", f"link={min(4, int(b.link * 5))}",
            f"end={b.text[-1] if b.text[-1] in '.?!:;,' else 'x'}", *(["copyright"] if "©" in b.text else []),
            *(["short+link"] if n < 30 and b.link > 0.8 else []), *([f"own={b.own}&end"] if b.text[-1] in ".?!" else []),
        ])
    return out


class Field:
    """Weights of a two-label chain: emission for label 1 of each feature, transitions, and the start."""

    def __init__(self, names: dict[str, int]):
        self.names = names
        self.weight = np.zeros(len(names))
        self.step = np.zeros((2, 2))
        self.begin = np.zeros(2)

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        get, w = self.names.get, self.weight
        return np.array([sum(w[k] for f in r if (k := get(f)) is not None) for r in rows])

    def viterbi(self, score: list[float]) -> list[int]:
        """The likeliest labels of a chain, given each block's score for label 1 against 0."""
        if not score:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = self.begin.tolist()
        b += score[0]
        back = []
        for x in score[1:]:
            from0, from1 = a + s00 >= b + s10, a + s01 > b + s11
            a, b = max(a + s00, b + s10), max(a + s01, b + s11) + x
            back.append((0 if from0 else 1, 0 if from1 else 1))
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]

    def expected(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label 1) of each block, and the expected transitions."""
        n = len(score)
        emit = np.stack([np.zeros(n), score], 1)
        fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
        fwd[0] = self.begin + emit[0]
        for t in range(1, n):
            fwd[t] = np.logaddexp(fwd[t - 1, 0] + self.step[0], fwd[t - 1, 1] + self.step[1]) + emit[t]
        for t in range(n - 2, -1, -1):
            ahead = bwd[t + 1] + emit[t + 1]
            bwd[t] = np.logaddexp(self.step[:, 0] + ahead[0], self.step[:, 1] + ahead[1])
        whole = np.logaddexp(*fwd[-1])
        pairs = np.exp(fwd[:-1, :, None] + self.step[None] + (emit + bwd)[1:, None, :] - whole)
        return np.exp(fwd[:, 1] + bwd[:, 1] - whole), pairs.sum(0)


def labelled(page: list[tuple[str, int]]) -> tuple[list[Block], np.ndarray]:
    """The blocks of a page given in labelled pieces, and their labels.

    A piece is marked by wrapping nothing: the blocks of each prefix tell how many the next piece adds.
    """
    html, counts = "", [0]
    for piece, _ in page:
        html += piece
        counts.append(len(blocks(html)))
    found = blocks(html)
    labels = np.zeros(len(found), np.int64)
    for k, (_, label) in enumerate(page):
        labels[counts[k] : counts[k + 1]] = label
    return found, labels


@lru_cache(4)
def trained(n: int = PAGES, seed: int = 11) -> Field:
    """The field fitted by AdaGrad to the log-likelihood of ``n`` labelled pages; the same for the same arguments."""
    data = []
    for page in labelled_pages.pages(n, seed):
        found, labels = labelled(page)
        if found:
            data.append((block_features(found), labels))
    names = {f: k for k, f in enumerate(sorted({f for rows, _ in data for r in rows for f in r}))}
    field = Field(names)
    coded = [([np.array([names[f] for f in r]) for r in rows], y) for rows, y in data]
    flat = [(np.concatenate(r), np.repeat(np.arange(len(r)), [len(x) for x in r]), y) for r, y in coded]
    seen = [np.full(len(names), 1e-2), np.full((2, 2), 1e-2), np.full(2, 1e-2)]
    pick = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for k in pick.permutation(len(flat)):
            at, row, y = flat[k]
            p, pairs = field.expected(np.bincount(row, field.weight[at], len(y)))
            real = np.zeros((2, 2))
            np.add.at(real, (y[:-1], y[1:]), 1)
            grads = [np.bincount(at, (y - p)[row], len(names)) - PRIOR * field.weight, real - pairs, np.array([p[0] - y[0], y[0] - p[0]])]
            for w, g, s in zip((field.weight, field.step, field.begin), grads, seen):
                s += g**2
                w += RATE * g / np.sqrt(s)
    return field


def main_text(html: str, field: Field) -> str:
    found = blocks(html)
    labels = field.viterbi(field.scores(block_features(found)).tolist())
    return " ".join(b.text for b, y in zip(found, labels) if y)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    text: the blocks tagged as the article, in page order, joined by one space; white space inside a block is one
    space, character references are decoded. Null or empty html, and pages without an article, give the empty text.
    Null page_id and url stay null; repeated rows give a row each. Other columns are ignored; an empty table gives an
    empty result.
    """
    field = trained()
    shared = pages.sparkSession.sparkContext.broadcast(field)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for part in portions(batches, "html"):
            out = [main_text(h.decode("utf-8", "replace"), own) for h in texts(part.column("html"))]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"], pages["html"]).mapInArrow(run, "page_id long, url string, text string, n_chars long")
