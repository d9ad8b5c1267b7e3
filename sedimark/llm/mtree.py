"""Exact top-k by inner product with an M-tree whose root page routes to chunks.

The root page holds one routing vector for each chunk: at most ``PIVOTS`` vectors, picked by a hash of their ids, own the
vectors nearest to them, and what one owns is cut into chunks of bounded size. Each chunk is an M-tree of its own: pages of
routing vectors with covering radii and their distances to the parent's routing vector, down to leaf pages of vectors
with theirs. For a query q and a routing vector c, every vector x below has  q.x <= q.c + |q| r  (r: covering radius),
and by the stored distance d to the parent p alone  q.x <= q.p + |q| (d + r), which often saves computing q.c. Pages are
taken best bound first, several at once after the first ones, until no bound reaches the k-th score found.

A query first goes to the chunk of the best bound and searches it best first; then, with the k-th score found there, it
goes to the chunks whose bound reaches it, where queries with such a floor take each page together. A chunk's tree and the queries that come for it are rows of one partition, the tree first, so queries stream
past it one batch at a time, and each gives at most k rows a chunk, which are then ranked over all chunks.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimark.llm.common import written

K, EVERY, PAGE, FANOUT = 5, 50, 64, 16
#: Pages taken together at most: each query begins with one, and doubles.
BATCH = 64
#: Vectors of a chunk at least, where there are partitions enough, and at most; chunks at most; vectors that route to chunks.
LEAST, MOST, CHUNKS, PIVOTS = 4096, 1 << 16, 20_000, 1024
_LONG = 2**63 - 1
_EXACT = 2.0**52


def quantised(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 x) of each component, zeros after the end of shorter vectors; objects where 64 bits can't hold sums."""
    rows = [np.floor(256 * np.array(v, np.float64)) for v in column.to_pylist()]
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    if out.size and float(np.abs(out).max()) ** 2 * width >= _EXACT:
        return np.array([[int(x) for x in r] for r in out], object).reshape(out.shape)
    return out


def _to_bytes(vectors: np.ndarray) -> list[bytes]:
    """Each vector as 32-bit or 64-bit numbers, or as text where they are larger; the first byte says which."""
    if vectors.dtype == object:
        return [b"t" + ",".join(map(str, v)).encode() for v in vectors]
    if np.abs(vectors).max(initial=0) < 2**31:
        return [b"i" + v.tobytes() for v in vectors.astype("<i4")]
    return [b"d" + v.tobytes() for v in vectors.astype("<f8")]


def _from_bytes(blobs: list[bytes], width: int) -> np.ndarray:
    kinds = {b[:1] for b in blobs}
    if b"t" in kinds or not kinds:
        out = [[int(x) for x in b[1:].split(b",") if x] if b[:1] == b"t" else [int(x) for x in _from_bytes([b], width)[0]] for b in blobs]
        return np.array(out, object).reshape(len(blobs), width) if blobs else np.zeros((0, width))
    if kinds == {b"i"}:
        return np.frombuffer(b"".join(b[1:] for b in blobs), "<i4").reshape(len(blobs), width).astype(np.float64)
    out = [np.frombuffer(b, "<i4" if b[:1] == b"i" else "<f8", offset=1) for b in blobs]
    return np.array(out, np.float64).reshape(len(blobs), width)


class Tree:
    """An M-tree over vectors with whole components; nodes are numbered, 0 is the root.

    The vectors of a leaf lie together, far from its routing vector first, so that a bound cuts them at one place.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, fanout: int = FANOUT):
        self.ids, self.vectors, self.page, self.fanout = ids, vectors, page, fanout
        self.routing = np.zeros((0, vectors.shape[1]))
        self.radius, self.parent_distance = np.zeros(0), np.zeros(0)
        self.children: list[np.ndarray] = []
        self.leaf = np.zeros((0, 2), np.int64)  # of a leaf: its rows
        self.distance = np.zeros(0)  # of each row: its distance to its leaf's routing vector, negated; rising in a leaf
        if len(ids) and vectors.dtype != object:
            self._pick = np.random.default_rng(1)
            self._order, self._far_order, self._nodes, self._placed = [], [], [], 0
            self._node(np.arange(len(ids)), 0, None)
            order = np.concatenate(self._order)
            centre, self.radius, self.parent_distance, self.children, leaf = (list(x) for x in zip(*self._nodes))
            self.routing, self.radius, self.parent_distance = vectors[centre], np.array(self.radius), np.array(self.parent_distance)
            self.leaf, self.distance = np.array(leaf, np.int64), -np.concatenate(self._far_order)
            self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
            del self._order, self._far_order, self._nodes, self._placed, self._pick

    def _far(self, centre: int, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.vectors[rows] - self.vectors[centre]) ** 2).sum(1))

    def _node(self, rows: np.ndarray, centre: int, parent: int | None) -> int:
        far = self._far(centre, rows)
        me = len(self._nodes)
        up = 0.0 if parent is None else float(self._far(parent, np.array([centre]))[0])
        self._nodes.append([centre, float(far.max()), up, np.zeros(0, np.int64), (0, 0)])
        if len(rows) <= self.page:
            order = np.argsort(-far, kind="stable")
            self._order.append(rows[order])
            self._far_order.append(far[order])
            self._nodes[me][4] = (self._placed, self._placed + len(rows))
            self._placed += len(rows)
            return me
        if not far.max():  # copies of one vector: pages of equal size
            parts = [(p, int(p[0])) for p in np.array_split(rows, min(self.fanout, -(-len(rows) // self.page)))]
        else:
            pivots = self._pick.choice(rows, min(self.fanout, len(rows)), replace=False)
            near = np.argmin([self._far(int(p), rows) for p in pivots], 0)
            parts = [(rows[near == k], int(p)) for k, p in enumerate(pivots) if (near == k).any()]
            if len(parts) == 1:  # all nearest to one pivot: split by distance
                by = rows[np.argsort(self._far(parts[0][1], rows), kind="stable")]
                parts = [(x, int(x[0])) for x in np.array_split(by, 2)]
        self._nodes[me][3] = np.array([self._node(x, c, centre) for x, c in parts])
        return me

    def dump(self) -> bytes:
        """The tree as bytes, without pickled objects."""
        out = io.BytesIO()
        if self.vectors.dtype == object:
            np.savez_compressed(out, ids=self.ids, text=np.frombuffer("\n".join(",".join(map(str, v)) for v in self.vectors).encode(), np.uint8), width=self.vectors.shape[1])
        else:
            small = np.abs(self.vectors).max(initial=0) < 2**31
            kids = np.concatenate(self.children) if self.children else np.zeros(0, np.int64)
            np.savez(
                out, ids=self.ids, vectors=self.vectors.astype(np.int32) if small else self.vectors, routing=self.routing, radius=self.radius, parent_distance=self.parent_distance,
                kids=kids, cut=np.cumsum([0, *map(len, self.children)]), leaf=self.leaf, distance=self.distance,
            )
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Tree:
        with np.load(io.BytesIO(blob)) as x:
            if "text" in x:
                rows = x["text"].tobytes().decode().split("\n")
                return cls(x["ids"], np.array([[int(v) for v in r.split(",") if v] for r in rows], object).reshape(len(x["ids"]), int(x["width"])))
            out = cls(np.zeros(0, np.int64), np.zeros((0, 0)))
            out.ids, out.vectors, out.routing, out.radius = x["ids"], x["vectors"].astype(np.float64), x["routing"], x["radius"]
            out.parent_distance, out.leaf, out.distance = x["parent_distance"], x["leaf"], x["distance"]
            kids, cut = x["kids"], x["cut"]
            out.children = [kids[i:j] for i, j in zip(cut[:-1], cut[1:])]
            return out

    def top(self, query: np.ndarray, own: int, k: int, floor: float = -np.inf) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, id) for a query, ties to smaller ids, without rows of id ``own`` and with no need of scores
        under ``floor``; and how many products it took."""
        if not len(self.ids):
            return [], 0
        if self.vectors.dtype == object or query.dtype == object:
            scores = self.vectors.astype(object) @ query.astype(object)
            return sorted(((int(s), int(i)) for s, i in zip(scores, self.ids) if i != own), key=lambda x: (-x[0], x[1]))[:k], len(self.ids)
        norm = float(np.sqrt(query @ query)) * (1 + 1e-9) + 1e-9  # so that rounding never cuts a bound short
        dot = float(self.routing[0] @ query)
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        queue, taken, most = [(-(dot + norm * self.radius[0]), 0, dot)], 1, 1
        while queue and -queue[0][0] >= floor:
            pages: list[tuple[int, int]] = []
            for _ in range(min(most, len(queue))):
                if -queue[0][0] < floor:
                    break
                _, node, dot = heapq.heappop(queue)
                kids = self.children[node]
                if not len(kids):
                    first, last = self.leaf[node].tolist()
                    if floor > -np.inf:
                        last = first + int(np.searchsorted(self.distance[first:last], (dot - floor) / norm, "right"))
                    if first < last:
                        pages.append((first, last))
                    continue
                kids = kids[dot + norm * (self.parent_distance[kids] + self.radius[kids]) >= floor]
                below = self.routing[kids] @ query
                taken += len(kids)
                reach = below + norm * self.radius[kids]
                for child in np.flatnonzero(reach >= floor).tolist():
                    heapq.heappush(queue, (-float(reach[child]), int(kids[child]), float(below[child])))
            most = min(2 * most, BATCH)
            if not pages:
                continue
            at = np.concatenate([np.arange(*p) for p in pages])
            scores = self.vectors[at] @ query
            taken += len(at)
            good = np.flatnonzero(scores >= floor)
            good = good[self.ids[at[good]] != own]  # an id may hold several vectors
            if len(good) > 2 * k:  # only what can be among the k best, ties included
                least = np.partition(scores[good], len(good) - k)[len(good) - k]
                good = good[scores[good] >= least]
            for s, i in zip(scores[good].tolist(), self.ids[at[good]].tolist()):
                item = (int(s), -i)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                floor = max(floor, best[0][0])
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1])), taken

    def sweep(self, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray) -> list[list[tuple[int, int]]]:
        """top() for queries that have floors already, page by page: a page is read once for all queries whose bound reaches it."""
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        if not len(self.ids):
            return best
        floors = floors.copy()
        norm = np.sqrt((queries**2).sum(1)) * (1 + 1e-9) + 1e-9
        stack = [(0, np.arange(len(queries)), queries @ self.routing[0])]
        while stack:
            node, some, dots = stack.pop()
            kids = self.children[node]
            keep = dots + norm[some] * self.radius[node] >= floors[some]  # floors have risen since
            some, dots = some[keep], dots[keep]
            if not len(some):
                continue
            for child in kids.tolist():
                near = dots + norm[some] * (self.parent_distance[child] + self.radius[child]) >= floors[some]
                if near.any():
                    stack.append((child, some[near], queries[some[near]] @ self.routing[child]))
            if not len(kids):
                first, last = self.leaf[node].tolist()
                scores = self.vectors[first:last] @ queries[some].T
                row, col = np.nonzero((scores >= floors[some]) & (self.ids[first:last, None] != own[some]))
                for s, i, q in zip(scores[row, col].tolist(), self.ids[first + row].tolist(), some[col].tolist()):
                    held = best[q]
                    if len(held) < k:
                        heapq.heappush(held, (int(s), -i))
                    elif (int(s), -i) > held[0]:
                        heapq.heapreplace(held, (int(s), -i))
                    if len(held) == k:
                        floors[q] = max(floors[q], held[0][0])
        return [sorted(((s, -i) for s, i in held), key=lambda x: (-x[0], x[1])) for held in best]


class Root:
    """The root page: (chunk, centre, radius) of every chunk, at most ``CHUNKS`` and the pieces of ``PIVOTS`` cells."""

    def __init__(self, chunks: list[int], centres: np.ndarray, radii: list[float]):
        self.chunks, self.centres, self.radii = np.array(chunks), centres, np.array(radii)

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """The largest inner product that each chunk can hold; infinite where numbers are too large for bounds."""
        if query.dtype == object:
            return np.full(len(self.chunks), np.inf)
        norm = float(np.sqrt(query @ query)) * (1 + 1e-9) + 1e-9
        return self.centres @ query + norm * self.radii


_ROW = "chunk int, split int, kind int, vec_id long, vec binary, floor double, blob binary"
_FOUND = "vec_id long, vec binary, chunk int, floor double, found array<struct<vec_id: long, exact: string>>"


def _meet(trees: DataFrame, asked: DataFrame, splits: int, width: int, k: int) -> DataFrame:
    """What queries (chunk, vec_id, vec, floor) find in their chunks; each tree goes to ``splits`` partitions, a query to one."""
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("vec_id", "long"), ("vec", "binary"), ("floor", "double"))]
    left = trees.select("chunk", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"), F.lit(0).alias("kind"), *nothing, "blob")
    deal = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(splits)).cast("int").alias("split")
    right = asked.select("chunk", deal, F.lit(1).alias("kind"), "vec_id", "vec", "floor", F.lit(None).cast("binary").alias("blob"))
    rows = left.unionByName(right).repartition("chunk", "split").sortWithinPartitions("chunk", "split", "kind")

    def answers(tree: Tree, ids: np.ndarray, vecs: list[bytes], floors: np.ndarray) -> list[list[tuple[int, int]]]:
        queries = _from_bytes(vecs, width)
        plain = queries.dtype != object and tree.vectors.dtype != object
        out: list = [None] * len(ids)
        ready = np.flatnonzero(np.isfinite(floors)) if plain else np.zeros(0, np.int64)
        for at, found in zip(ready.tolist(), tree.sweep(queries[ready], ids[ready], k, floors[ready]) if len(ready) else ()):
            out[at] = found
        for at in np.setdiff1d(np.arange(len(ids)), ready).tolist():
            out[at] = tree.top(_from_bytes(vecs[at : at + 1], width)[0], int(ids[at]), k, floors[at])[0]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree: Tree | None = None
        for batch in batches:
            kind, chunk = batch.column("kind").to_numpy(), batch.column("chunk").to_numpy()
            out: list[tuple] = []
            cut = np.r_[0, np.flatnonzero((kind[1:] != kind[:-1]) | (chunk[1:] != chunk[:-1])) + 1, len(kind)]
            for first, last in zip(cut[:-1].tolist(), cut[1:].tolist()):
                own = batch.slice(first, last - first)
                if not kind[first]:
                    tree = Tree.load(own.column("blob")[0].as_py())
                    continue
                ids, vecs, floors = own.column("vec_id").to_numpy(), own.column("vec").to_pylist(), own.column("floor").to_numpy()
                for i, vec, floor, found in zip(ids.tolist(), vecs, floors.tolist(), answers(tree, ids, vecs, floors)):
                    kth = float(found[-1][0]) if len(found) == k and abs(found[-1][0]) < _EXACT else -np.inf
                    out.append((i, vec, int(chunk[first]), max(floor, kth), [{"vec_id": v, "exact": str(s)} for s, v in found]))
            pair = pa.struct([("vec_id", pa.int64()), ("exact", pa.string())])
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.float64(), pa.list_(pair))
            columns = [pa.array([o[c] for o in out], t) for c, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vec", "chunk", "floor", "found"])

    return rows.mapInArrow(run, _FOUND)


def _cells(rows: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """(cell, deal, vec_id, vec): each vector with the pivot nearest to it; ``deal`` spreads a cell, equal rows too, over pieces."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)  # at most PIVOTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        square = (own**2).sum(1)
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                part = batch.slice(k, 1024)
                vectors = quantised(part.column("embedding"), width)
                cell = np.zeros(len(vectors), np.int32) if vectors.dtype == object else np.argmin(square - 2 * vectors @ own.T, 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cell), part.column("vec_id"), pa.array(_to_bytes(vectors), pa.binary())], ["cell", "vec_id", "vec"])

    found = rows.mapInArrow(run, "cell int, vec_id long, vec binary")
    return found.select("cell", F.xxhash64("vec_id", "vec", F.spark_partition_id()).alias("deal"), "vec_id", "vec")


def search(embeddings: DataFrame, k: int = K, every: int = EVERY, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best rows by inner product of floor(256 x), all if fewer.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows with another id. Ties go to
    the smaller vec_id. Rows without vec_id, and vectors that are null, or hold null, NaN or infinite components, take
    no part; an empty vector scores 0, and a shorter vector counts as followed by zeros. Every row counts, repeated ones
    too: rows that repeat a candidate are candidates each, and rows that share a query's id are queries each, whose
    results are ranked together. Scores beyond 64 bits are ranked exactly and given as the largest or smallest long.
    Other columns are ignored; an empty table gives an empty result. ``least`` and ``most``: vectors of a chunk.
    """
    spark = embeddings.sparkSession
    good = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select(embeddings["vec_id"].cast("long").alias("vec_id"), embeddings["embedding"].cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(least, -(-n // parts)) if n < parts * most else max(most, -(-n // CHUNKS))
    wanted = min(PIVOTS, max(1, -(-n // size)))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(wanted).toArrow()
    pivots = quantised(picked.column("embedding").combine_chunks(), width)
    pivots = np.zeros((1, width)) if pivots.dtype == object or not len(pivots) else np.unique(pivots, axis=0)
    held = written(_cells(rows, pivots, width), "cells")

    count = {r["cell"]: r["n"] for r in held.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # one row for each pivot
    pieces = [-(-count.get(c, 0) // size) for c in range(len(pivots))]
    before = np.cumsum([0, *pieces])[:-1].tolist()
    at = lambda values: F.element_at(F.lit(values).cast("array<int>"), F.col("cell") + 1)
    dealt = held.withColumn("chunk", (at(before) + F.pmod("deal", F.greatest(at(pieces), F.lit(1)))).cast("int"))

    def build(key, table):  # noqa: ANN001, ANN202
        vectors = _from_bytes(table.column("vec").to_pylist(), width)
        tree = Tree(table.column("vec_id").to_numpy(), vectors)
        plain = tree.vectors.dtype != object
        centre = np.ascontiguousarray(tree.routing[0] if plain else np.zeros(width)).tobytes()
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([centre], pa.binary()), pa.array([float(tree.radius[0]) if plain else None], pa.float64()), pa.array([tree.dump()], pa.binary())], ["chunk", "centre", "radius", "blob"])

    trees = written(dealt.select("chunk", "vec_id", "vec").groupBy("chunk").applyInArrow(build, "chunk int, centre binary, radius double, blob binary"), "trees")
    page = sorted((r["chunk"], r["centre"], r["radius"]) for r in trees.select("chunk", "centre", F.coalesce("radius", F.lit(float("inf"))).alias("radius")).collect())
    root = spark.sparkContext.broadcast(Root([p[0] for p in page], np.array([np.frombuffer(p[1]) for p in page]).reshape(len(page), width), [p[2] for p in page]))
    splits = max(1, -(-parts // max(1, len(page))))

    def route(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = root.value
            for batch in batches:
                out: list[list] = [[], [], [], []]
                done = [None] * batch.num_rows if first else batch.column("chunk").to_pylist()
                floors = [-np.inf] * batch.num_rows if first else batch.column("floor").to_pylist()
                for i, vec, seen, floor in zip(batch.column("vec_id").to_pylist(), batch.column("vec").to_pylist(), done, floors):
                    bounds = own.bounds(_from_bytes([vec], width)[0])
                    to = [int(own.chunks[bounds.argmax()])] if first else [c for c in own.chunks[~(bounds < floor)].tolist() if c != seen]
                    for column, values in zip(out, (to, [i] * len(to), [vec] * len(to), [floor] * len(to))):
                        column += values
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int64(), pa.binary(), pa.float64()))], ["chunk", "vec_id", "vec", "floor"])

        return run

    asks = "chunk int, vec_id long, vec binary, floor double"
    nearest = held.where(F.col("vec_id") % every == 0).select("vec_id", "vec").mapInArrow(route(True), asks)
    nearest = written(_meet(trees, nearest, splits, width, k), "nearest")
    rest = nearest.select("vec_id", "vec", "chunk", "floor").mapInArrow(route(False), asks)
    found = nearest.unionByName(_meet(trees, rest, splits, width, k))
    found = found.select(F.col("vec_id").alias("query_id"), F.explode("found").alias("f")).select("query_id", "f.vec_id", "f.exact")
    # exact order for any size of score: by the number as a decimal, or by its digits where that has too few
    score = F.expr("coalesce(try_cast(exact AS bigint), CASE WHEN exact LIKE '-%' THEN -9223372036854775807 - 1 ELSE 9223372036854775807 END)")
    digits = F.when(F.col("exact").startswith("-"), -F.length("exact")).otherwise(F.length("exact"))
    found = found.select("query_id", "vec_id", score.alias("score"), digits.alias("digits"), "exact")
    far = F.when(F.abs(F.col("digits")) >= 19, F.col("digits")).otherwise(0)
    text = F.when(F.col("score") == _LONG, F.col("exact"))
    under = F.when(F.col("score") < -_LONG, F.col("exact"))
    order = [F.desc("score"), far.desc(), text.desc_nulls_last(), under.asc_nulls_last(), F.col("vec_id")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
