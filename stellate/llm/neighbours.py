"""Nearest neighbours by a block matrix join of int8 tiles with exact verification.

Method. Candidates and queries are dealt to blocks, and every pair of a query block and a
candidate block is one tile. In a tile both sides are quantised to int8, each vector by its
own scale, and the length of what the rounding left is kept. One integer matrix product
gives the distances between the quantised vectors; by the triangle inequality the true
distance differs by at most the two lengths left. A pair whose lower bound is above the
query's k-th smallest upper bound cannot be among the k nearest. All other pairs are
recomputed from the original components in double precision and go through one heap of k for
each query; the tiles' heaps are merged by a heap again. Nothing is approximated in the end:
the bounds are proven, so the recall is 1.

Scale. The query set is the stated part of all rows and meets every row, so the product is
what there is to do; the blocks keep what moves far below it. A candidate travels once for
each query block, a query once for each candidate block. Blocks are bounded by bytes, and a
tile returns at most k rows a query. Blocks are dealt by a hash of the row, so no vector and
no id makes a block large. Copies of one vector in a block are compared once, and only the
k + 1 smallest ids of them can be among the k nearest of any query.

Edge cases. Vectors that are null, empty, zero, or hold a null or non-finite component take
no part, and neither do rows without an id. Vectors of different lengths have no distance
and are never paired. A row that repeats both id and vector counts once; a row that repeats
an id with another vector is a row of its own, as a query and as a candidate. No row is a
candidate of its own id. Equal distances go to the smaller id. Other columns are ignored; an
empty table, or one without queries, gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import text_input

#: Bytes of original components in a block of candidates and of queries.
CANDIDATE_BYTES, QUERY_BYTES = 48 << 20, 16 << 20
#: Blocks of candidates that a small table is dealt to. A tile returns up to k rows a query, so
#: their number follows the data, not the session's partitions.
LEAST_BLOCKS = 24
#: Pairs of a tile worked on at once, and survivors recomputed at once.
TILE_PAIRS, RECOMPUTED = 1 << 20, 1 << 16
#: Dimensions of which an int8 product is exact in float32: 127 * 127 * 1,024 < 2 ** 24.
EXACT_DIMS = 1024
#: Relative slack of squared distances, far above what double arithmetic rounds away.
SLACK = 1e-12


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


class Quantised:
    """int8 vectors, their scales, and the lengths of what the rounding left."""

    def __init__(self, vectors: np.ndarray):
        top = np.abs(vectors).max(axis=1)
        self.scale = np.where(top / 127 > 0, top / 127, 1.0)
        self.codes = np.rint(vectors / self.scale[:, None]).astype(np.int8)
        close = self.codes * self.scale[:, None]
        self.left = np.linalg.norm(vectors - close, axis=1)
        self.square = np.einsum("ij,ij->i", close, close)


def int8_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int8 matrices, exact: float32 sums of products stay below 2 ** 24."""
    out = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, i : i + EXACT_DIMS].astype(np.float32) @ b[:, i : i + EXACT_DIMS].astype(np.float32).T
    return out


def bounds(a: Quantised, b: Quantised, rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances of a part of a tile."""
    product = int8_product(a.codes[rows], b.codes[columns])
    product *= a.scale[rows, None] * b.scale[None, columns]
    size = a.square[rows, None] + b.square[None, columns]
    centre = np.sqrt(np.maximum(size - 2 * product, 0))
    reach = a.left[rows, None] + b.left[None, columns] + np.sqrt(SLACK * size)
    return centre - reach, centre + reach


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of matching rows in double precision, summed in order of the components."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        step = a[:, j] - b[:, j]
        total += step * step
    return np.sqrt(total)


class Heaps:
    """The k nearest seen so far of each query, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n)]

    def push(self, query: int, distance: float, other: int) -> None:
        heap, item = self.heaps[query], (-distance, -other)
        if len(heap) < self.k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)

    def worst(self, rows: slice) -> np.ndarray:
        """The k-th distance of each query so far."""
        return np.array([-h[0][0] if len(h) == self.k else np.inf for h in self.heaps[rows]])


def distinct_rows(ids: np.ndarray, vectors: np.ndarray, copies: int | None) -> np.ndarray:
    """Places of the rows without repeats; of a vector only the ``copies`` smallest ids."""
    raw = np.ascontiguousarray(vectors + 0.0)  # one zero
    _, kind = np.unique(raw.view(np.dtype((np.void, raw.shape[1] * raw.itemsize))).ravel(), return_inverse=True)
    order = np.lexsort((ids, kind))
    kind_, ids_ = kind[order], ids[order]
    fresh = np.append(True, (kind_[1:] != kind_[:-1]) | (ids_[1:] != ids_[:-1]))
    order, kind_ = order[fresh], kind_[fresh]
    if copies is None:
        return order
    first = np.flatnonzero(np.append(True, kind_[1:] != kind_[:-1]))
    place = np.arange(len(kind_)) - np.repeat(first, np.diff(np.append(first, len(kind_))))
    return order[place < copies]


def nearest_in_tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """For every query its k nearest of the tile, as ``(distance, id)`` in order."""
    a, b = Quantised(queries), Quantised(vectors)
    heaps = Heaps(len(queries), k)
    wide = max(1, min(len(vectors), TILE_PAIRS // 64))
    high = max(1, TILE_PAIRS // wide)
    for i in range(0, len(queries), high):
        rows = slice(i, i + high)
        worst = np.full(len(query_ids[rows]), np.inf)
        for j in range(0, len(vectors), wide):
            columns = slice(j, j + wide)
            low, up = bounds(a, b, rows, columns)
            own = query_ids[rows, None] == ids[None, columns]
            up[own] = np.inf
            if up.shape[1] >= k:
                worst = np.minimum(worst, np.partition(up, k - 1, axis=1)[:, k - 1])
            at, other = np.nonzero(~(low > worst[:, None]) & ~own)
            for s in range(0, len(at), RECOMPUTED):
                x, y = at[s : s + RECOMPUTED] + i, other[s : s + RECOMPUTED] + j
                for q, d, n in zip(x.tolist(), distances(queries[x], vectors[y]).tolist(), ids[y].tolist(), strict=True):
                    heaps.push(q, d, n)
            worst = np.minimum(worst, heaps.worst(rows))
    return [sorted((-d, -n) for d, n in h) for h in heaps.heaps]


def _by_length(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, prints, vectors)`` of a block by the length of the vectors."""
    table = table.combine_chunks()
    out = {}
    if not table.num_rows:
        return out
    column = table.column("vector").combine_chunks()
    ids, prints = table.column("id").to_numpy(), table.column("print").to_numpy()
    lengths = column.value_lengths().to_numpy()
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = column.flatten().to_numpy()
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        out[d] = ids[rows], prints[rows], flat[offsets[rows][:, None] + np.arange(d)].astype(np.float64)
    return out


def _tile(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        asked, there = _by_length(queries), _by_length(candidates)
        found: list[tuple[np.ndarray, ...]] = []
        for d in asked.keys() & there.keys():
            (query_ids, prints, left), (ids, _, right) = asked[d], there[d]
            rows, kept = distinct_rows(query_ids, left, None), distinct_rows(ids, right, k + 1)
            near = nearest_in_tile(query_ids[rows], left[rows], ids[kept], right[kept], k)
            counts = [len(x) for x in near]
            score, other = np.array([p for x in near for p in x]).reshape(-1, 2).T[0], [n for x in near for _, n in x]
            found.append((np.repeat(query_ids[rows], counts), np.repeat(prints[rows], counts), np.array(other, np.int64), score))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.float64)]
        return pa.table(dict(zip(("query_id", "print", "vec_id", "score"), columns, strict=True)))

    return run


def _merge(k: int):
    """Merge the tiles' answers of each query, rows of a query in a row, by one heap of k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, Heaps(1, k)
        rows: list[tuple] = []

        def close() -> None:
            if query is not None:
                rows.extend((query[0], rank, n, d) for rank, (d, n) in enumerate(sorted((-d, -n) for d, n in heap.heaps[0]), 1))

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            types = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query_id", "rank", "vec_id", "score"])
            rows.clear()
            return out

        for batch in batches:
            for q, p, n, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (q, p) != query:
                    close()
                    query, heap = (q, p), Heaps(1, k)
                heap.push(0, d, n)
            yield flush()
        close()
        yield flush()

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    candidate_bytes: int = CANDIDATE_BYTES,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest rows of every row
    that ``is_query`` names, by Euclidean distance."""
    vector = F.col(vector_column)
    kind = vectors.schema[vector_column].dataType.simpleString()
    width = 4 if kind == "array<float>" else 8
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    size = F.coalesce(F.size(vector), F.lit(0))
    totals = vectors.agg(F.sum(size), F.sum(F.when(is_query, size)), F.count(F.when(is_query, 1))).first()
    blocks = max(LEAST_BLOCKS, -(-int(totals[0] or 0) * width // candidate_bytes))
    query_blocks = max(1, -(-int(totals[1] or 0) * width // query_bytes))

    rows = vectors.where(F.col(id_column).isNotNull() & usable(vector))
    rows = rows.select(F.col(id_column).cast("long").alias("id"), vector.cast(kind).alias("vector"), is_query.alias("asked"))
    rows = rows.withColumn("print", F.xxhash64("id", "vector"))
    dealt = lambda n, seed: F.pmod(F.xxhash64("print", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("id", "print", "vector", dealt(blocks, 1).alias("block"), every(query_blocks).alias("query_block"))
    queries = rows.where("asked").select("id", "print", "vector", dealt(query_blocks, 2).alias("query_block"), every(blocks).alias("block"))

    tile = ["query_block", "block"]
    tiles = text_input(queries, "*").groupBy(*tile).cogroup(candidates.groupBy(*tile))
    found = tiles.applyInArrow(_tile(k), "query_id bigint, print bigint, vec_id bigint, score double")
    merged = found.repartition("query_id").sortWithinPartitions("query_id", "print")
    return merged.mapInArrow(_merge(k), "query_id bigint, rank int, vec_id bigint, score double")
