"""Approximate nearest neighbours by a forest of sorted hash strings.

Each tree hashes a vector to a string of BITS random-hyperplane bits and keeps a shard's strings in a
sorted array, where the strings that share a prefix are neighbours. A query descends every tree to its
longest matching prefix, then all trees ascend together, a bit at a time, until the ranges of equal
prefixes hold enough different candidates, a number that grows more slowly than the shard. Candidates are ranked by exact distance. Every row is indexed, in the
shard of the task that reads it; shards answer alone and their best answers are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEAREST, TREES, BITS = 10, 256, 24
#: Ascent ends when a query has FACTOR * n ** POWER different candidates, n being the vectors of the shard. Hash strings of
#: independent vectors, the worst case, need a power of that size; vectors in clusters would do with less.
FACTOR, POWER = 1.9, 0.8
#: Vectors of a shard; bytes of queries that are broadcast at once; trees that ascend between two counts.
SHARD, BLOCK_BYTES, STEP = 65536, 16 << 20, 8
SEED = 20


def clean_vectors(column: pa.Array | pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row numbers and double-precision vectors by dimension, without null, zero and non-finite ones."""
    by: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.values.cast(pa.float64())
    values, missing = flat.to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False)
    offsets, valid = column.offsets.to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)
    for i in np.flatnonzero(valid):
        a, b = offsets[i], offsets[i + 1]
        v = values[a:b]
        if b > a and not missing[a:b].any() and np.isfinite(v).all() and v.any():
            rows, vectors = by.setdefault(int(b - a), ([], []))
            rows.append(int(i))
            vectors.append(v)
    return {d: (np.array(r), np.array(v)) for d, (r, v) in by.items()}


def wanted(n: int) -> int:
    """Different candidates at which the ascent among n vectors ends."""
    return min(n, int(np.ceil(FACTOR * n**POWER)))


class Forest:
    """Sorted arrays of hash strings of a shard's vectors, all of one dimension."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES):
        self.vectors, self.trees = vectors, trees
        self.centre = vectors.mean(axis=0)
        self.planes = np.random.default_rng(SEED).standard_normal((trees, vectors.shape[1], BITS)).astype(np.float32)
        hashed = self.strings(vectors)
        self.order = np.empty(hashed.shape, np.int32)
        for t in range(trees):
            self.order[t] = np.argsort(hashed[t], kind="stable")
            hashed[t] = hashed[t][self.order[t]]
        self.sorted = hashed

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """(trees, vectors) hash strings, their first bit the highest."""
        centred = (vectors - self.centre).astype(np.float32)
        out = np.zeros((self.trees, len(vectors)), np.uint32)
        for t, planes in enumerate(self.planes):
            for bit in (centred @ planes > 0).T:
                out[t] = out[t] << np.uint32(1) | bit
        return out

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(prefix length, tree, query) first and end of the strings that start like each query's, for every length."""
        hashed = self.strings(queries)
        low, high = (np.zeros((BITS + 1, self.trees, len(queries)), np.int32) for _ in range(2))
        for t in range(self.trees):
            for length in range(BITS + 1):
                rest = np.uint32(BITS - length)
                first = hashed[t] >> rest << rest
                low[length, t] = np.searchsorted(self.sorted[t], first, "left")
                high[length, t] = np.searchsorted(self.sorted[t], first | np.uint32((1 << (BITS - length)) - 1), "right")
        return low, high

    def candidates(self, queries: np.ndarray, enough: int | None = None) -> Iterator[np.ndarray]:
        """Of each query the rows under its longest prefixes: all trees at one length, and tree by tree a bit shorter until there are enough."""
        n = len(self.vectors)
        enough = wanted(n) if enough is None else min(enough, n)
        low, high = self.ranges(queries)
        held = (high - low).sum(axis=1, dtype=np.int64)  # (length, query), repeats included
        for q in range(len(queries)):
            found, count = np.zeros(n, bool), 0
            # at lengths whose ranges are too small, repeats included, no count is needed
            for length in range(int(np.flatnonzero(held[:, q] >= enough)[-1]), -1, -1):
                for at in range(0, self.trees, STEP):
                    for t in range(at, min(at + STEP, self.trees)):
                        found[self.order[t, low[length, t, q] : high[length, t, q]]] = True
                    count = np.count_nonzero(found)
                    if count >= enough:
                        break
                if count >= enough:
                    break
            yield np.flatnonzero(found)


def nearest(distance: np.ndarray, ids: np.ndarray, k: int = NEAREST) -> np.ndarray:
    """Positions of the k least distances, ties to the smaller id."""
    if len(distance) > 4 * k:
        near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    else:
        near = np.arange(len(distance))
    return near[np.lexsort((ids[near], distance[near]))][:k]


def _answers(blocks: dict[int, tuple[np.ndarray, np.ndarray]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def close(dim: int) -> None:
            ids, vectors = (np.concatenate(x) for x in zip(*held.pop(dim), strict=True))
            for at in range(0, len(ids), SHARD):
                mine, part = ids[at : at + SHARD], vectors[at : at + SHARD]
                forest, (query_ids, queries) = Forest(part), blocks[dim]
                for start in range(0, len(queries), 256):
                    for j, rows in enumerate(forest.candidates(queries[start : start + 256]), start):
                        rows = rows[mine[rows] != query_ids[j]]
                        if not len(rows):
                            continue
                        d = np.sqrt(((part[rows] - queries[j]) ** 2).sum(axis=1))
                        top = nearest(d, mine[rows], k)
                        d, found = d[top], mine[rows][top]
                        if (dim, j) in best:
                            d, found = np.concatenate([best[dim, j][0], d]), np.concatenate([best[dim, j][1], found])
                            top = nearest(d, found, k)
                            d, found = d[top], found[top]
                        best[dim, j] = (d, found)

        for batch in batches:
            all_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for dim, (rows, vectors) in clean_vectors(batch.column(1)).items():
                if dim in blocks:
                    held.setdefault(dim, []).append((all_ids[rows].astype(np.int64), vectors))
                    if sum(len(i) for i, _ in held[dim]) >= SHARD:
                        close(dim)
        for dim in list(held):
            close(dim)
        if best:
            ids = np.concatenate([np.full(len(d), blocks[dim][0][j]) for (dim, j), (d, _) in best.items()])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate([f for _, f in best.values()]), pa.int64()), pa.array(np.concatenate([d for d, _ in best.values()]), pa.float64())], names=["query_id", "vec_id", "score"])

    return run


def search(base: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """The k nearest of base (vec_id, embedding) to each of queries, as (query_id, rank, vec_id, score).

    score: Euclidean distance in double precision; ties go to the smaller vec_id. Vectors that are null or
    zero or hold nulls, NaN or infinities take no part, nor do null ids; vectors of different dimensions
    are never compared. Rows with a query's own id are not its candidates. Every other row is a candidate of
    its own, so that an id that several rows of base have can stand at several ranks. Repeated queries of one
    id and vector count once; different vectors under one query id share one ranking, of the rows nearest to
    any of them. Empty base or queries give no rows; extra columns are not looked at. Queries go in blocks of
    BLOCK_BYTES, each against all of base.
    """
    spark = base.sparkSession
    wanted = queries.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").dropDuplicates(["vec_id", "embedding"])
    rows = base.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    size = wanted.agg(F.sum(8 * F.size("embedding"))).first()[0] or 0
    blocks = int(-(-size // BLOCK_BYTES)) or 1
    answers = None
    for b in range(blocks):
        got = wanted.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        ids = got.column("vec_id").to_numpy()
        held = spark.sparkContext.broadcast({dim: (ids[at], vectors) for dim, (at, vectors) in clean_vectors(got.column("embedding")).items()} if len(ids) else {})
        part = rows.mapInArrow(lambda batches, held=held: _answers(held.value, k)(batches), "query_id long, vec_id long, score double")
        answers = part if answers is None else answers.unionByName(part)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return answers.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def all_queries(embeddings: DataFrame, divisor: int = 100, k: int = NEAREST) -> DataFrame:
    """The stated query set, rows whose vec_id the divisor divides, against every row."""
    return search(embeddings, embeddings.where(F.col("vec_id") % divisor == 0), k)
