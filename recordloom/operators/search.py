"""Exact searches of a query side in a pool that never shuffle pairs: cosines of term vectors, Jaccard similarities of sets.

Queries are dealt to blocks and pool rows to shards; every block meets every shard in one task, which searches
it by inverted lists. Bounds leave out only what cannot reach a result, so results depend on neither dealing nor order.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scores are compared by this many digits; bounds are loosened by SLACK.
DIGITS, SLACK = 10, 1e-9
#: Tasks of a small search at least, and the most terms of a shard or block of vectors or of sets.
TASKS, VECTOR_TERMS, SET_TERMS = 16, 2_000_000, 6_000_000
#: Words that are told apart by their rank among the frequent ones; others by 63 bits of a hash.
FREQUENT = 1 << 16


def trimmed(search: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """search of a cell; a worker gives free memory, its former tasks' too, back before and after each."""

    def trim() -> None:
        pa.default_memory_pool().release_unused()
        if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc alone has it
            give_back(0)

    def freed(left: pa.Table, right: pa.Table) -> pa.Table:
        trim()
        try:
            return search(left, right)
        finally:
            trim()

    return freed


def cells_of(part: Column, shards: int, others: int, block: bool) -> Column:
    """The cells of a block (with each of ``others`` shards) or of a shard (with each of ``others`` blocks), as an array."""
    return F.transform(F.sequence(F.lit(0), F.lit(others - 1)), (lambda s: part * shards + s) if block else (lambda b: b * shards + part))


def cells(queries: DataFrame, pool: DataFrame, shards: int, blocks: int, q: str, p: str, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """search(block of queries, shard of the pool) for all of both."""
    block, shard = F.pmod(F.xxhash64(q), F.lit(blocks)), F.pmod(F.xxhash64(p), F.lit(shards))
    left = queries.withColumn("__cell", F.explode(cells_of(block, shards, shards, True)))
    pool = pool.select(*(F.col(c).alias(c) for c in pool.columns))  # both sides may come from one table
    right = pool.withColumn("__cell", F.explode(cells_of(shard, shards, blocks, False)))
    return left.groupBy("__cell").cogroup(right.groupBy("__cell")).applyInArrow(trimmed(search), schema)


def grid(n_q: int, n_p: int, most: int) -> tuple[int, int]:
    """(shards, blocks) of n_p and n_q terms: cells of at most about ``most`` terms of a side, TASKS at least, and few terms sent: more than 4 shards cost more than they save.

    Every shard gets all queries and every block the whole pool.
    """
    least = max(1, -(-n_p // most))
    blocks = lambda shards: max(1, -(-n_q // most), -(-TASKS // shards))
    shards = min(range(least, max(least, math.isqrt(TASKS)) + 1), key=lambda s: (s * n_q + blocks(s) * n_p, s))
    return shards, blocks(shards)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start .. start + length - 1 of every range, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of at least one value."""
    return np.add.reduceat(values, np.cumsum(lengths) - lengths)


# --- cosine ---------------------------------------------------------------------------------------------------------


def _vectors(ids: np.ndarray, terms: np.ndarray, weights: np.ndarray, order: np.ndarray):
    """(ids, offsets, terms, weights, norms of what follows) of rows, each with its terms from rare to frequent."""
    rows, at = np.unique(ids, return_inverse=True)
    by = np.lexsort((order[terms], at))
    terms, weights = terms[by], weights[by]
    ends = np.cumsum(np.bincount(at, minlength=len(rows)))
    squares = np.concatenate(([0.0], np.cumsum(weights * weights)))
    rest = np.sqrt(np.maximum(squares[ends][at[by]] - squares[:-1], 0.0) + SLACK)
    return rows, np.concatenate(([0], ends)), terms, weights, rest


def best_cosines(queries: pa.Table, pool: pa.Table, k: int, least: float, apart: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its k best pool rows of ``least`` or more, ties to smaller ids, by vectors of weights above 0. apart: not the row of its own id.

    Terms go from rare to frequent, and their products are added up for all rows at once. The k-th best sum so far
    bounds the result from below, and a row's sum and the norms of what either vector has left bound its score from
    above. Once no other row can enter, those that still can are scored whole, unless the lists that are left hold less.
    """
    codes = pa.chunked_array([*pool["term"].chunks, *queries["term"].chunks], pool["term"].type).combine_chunks().dictionary_encode()
    codes = codes.indices.to_numpy(zero_copy_only=False)
    n = pool.num_rows
    size = int(codes.max()) + 1
    frequency = np.bincount(codes[:n], minlength=size)
    order = np.empty(size, np.int64)
    order[np.argsort(frequency, kind="stable")] = np.arange(size)
    ids, at, terms, weights, _ = _vectors(pool["p"].to_numpy(), codes[:n], pool["w"].to_numpy(), order)
    lengths = np.diff(at)
    rows = np.repeat(np.arange(len(ids)), lengths)
    by = np.argsort(terms, kind="stable")
    lists, values = rows[by], weights[by]
    starts = np.cumsum(frequency) - frequency
    # terms of one level hold up to twice as many rows as others of it; behind: norms of what rows have above a level
    level = np.frexp(np.maximum(frequency, 1))[1]
    levels = int(level.max()) + 1
    behind = np.bincount(level[terms] * len(ids) + rows, weights * weights, levels * len(ids)).reshape(levels, -1)
    behind = np.sqrt(np.maximum(behind.sum(0) - np.cumsum(behind, 0), 0.0) + SLACK)
    known = frequency[codes[n:]] > 0  # a term that no row has adds nothing
    asked = _vectors(queries["q"].to_numpy()[known], codes[n:][known], queries["w"].to_numpy()[known], order)
    own = dict(zip(ids.tolist(), range(len(ids)), strict=True)) if apart else {}
    dense = np.zeros(size)

    def whole(rows: np.ndarray) -> np.ndarray:
        cells_ = _ranges(at[rows], lengths[rows])
        return np.round(_sums(dense[terms[cells_]] * weights[cells_], lengths[rows]), DIGITS)

    for i, q in enumerate(asked[0].tolist()):
        mine = slice(asked[1][i], asked[1][i + 1])
        t, w, left = asked[2][mine], asked[3][mine], asked[4][mine]
        sizes, high = frequency[t], level[t]
        ends = np.append(np.flatnonzero(high[1:] != high[:-1]) + 1, len(t))
        spent = np.cumsum(sizes)
        total, start, bound, sums = int(spent[-1]), 0, least, np.zeros(len(ids))
        for end in ends.tolist():
            done = int(spent[start - 1]) if start else 0
            if end < len(t) and spent[end - 1] - done < max(1024, done):
                continue  # few enough to go with the next level
            part = slice(start, end)
            cells_ = _ranges(starts[t[part]], sizes[part])
            sums += np.bincount(lists[cells_], np.repeat(w[part], sizes[part]) * values[cells_], len(ids))
            if q in own:
                sums[own[q]] = 0.0
            start, touched = end, np.flatnonzero(sums)
            if len(touched) > k:
                bound = max(bound, float(np.partition(sums[touched], -k)[-k]))
            rest = float(left[end]) if end < len(t) else 0.0
            if rest and rest >= bound - SLACK:
                continue
            touched = touched[sums[touched] + rest * behind[high[end - 1]][touched] >= bound - SLACK]
            if int(lengths[touched].sum()) <= total - int(spent[end - 1]):
                break
        if not len(touched):
            continue
        dense[t] = w
        if len(touched) > 2 * k:  # the k best so far raise the bound for the others
            best = np.argpartition(sums[touched], -k)[-k:]
            first = whole(touched[best])
            others = np.delete(touched, best)
            others = others[sums[others] + rest * behind[high[end - 1]][others] >= max(bound, float(first.min())) - SLACK]
            row, score = np.concatenate([touched[best], others]), np.concatenate([first, whole(others)]) if len(others) else first
        else:
            row, score = touched, whole(touched)
        dense[t] = 0.0
        good = score >= least
        row, score = row[good], score[good]
        if len(row):
            top = np.lexsort((ids[row], -score))[:k]
            yield q, ids[row[top]], score[top]


def _by_term(table: pa.Table, key: str) -> pa.Table:
    """(key, term, w) of vectors, which may be packed in rows (key, terms, ws)."""
    if "terms" not in table.column_names:
        return table
    lengths = pc.list_value_length(table["terms"]).to_numpy()
    return pa.table({key: np.repeat(table[key].to_numpy(), lengths), "term": pc.list_flatten(table["terms"]), "w": pc.list_flatten(table["ws"])})


def cosine_search(queries: DataFrame, pool: DataFrame, k: int, least: float = 0.0, apart: bool = False) -> DataFrame:
    """(q, p, score): the k best by cosine of at least ``least``, ties to the lower p, of unit vectors that are kept tables: (q, term, w) and (p, term, w), or (q, terms, ws) and (p, terms, ws)."""
    packed = "terms" in pool.columns
    n_terms = lambda df: df.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first().n if packed else df.count()
    shards, blocks = grid(n_terms(queries), n_terms(pool), VECTOR_TERMS)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = list(best_cosines(_by_term(left, "q"), _by_term(right, "p"), k, least, apart)) if left.num_rows and right.num_rows else []
        q = np.repeat(np.array([x[0] for x in parts], np.int64), [len(x[1]) for x in parts])
        p, score = (np.concatenate([x[i] for x in parts]) if parts else np.zeros(0) for i in (1, 2))
        return pa.table({"q": q, "p": p.astype(np.int64), "score": score.astype(float)})

    vector = ["terms", "ws"] if packed else ["term", F.col("w").cast("double").alias("w")]
    columns = lambda df, key: df.select(F.col(key).cast("long").alias(key), *vector)
    found = cells(columns(queries, "q"), columns(pool, "p"), shards, blocks, "q", "p", search, "q long, p long, score double")
    if shards == 1:
        return found
    order = Window.partitionBy("q").orderBy(F.desc("score"), "p")
    return found.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= k).drop("__rank")


# --- Jaccard --------------------------------------------------------------------------------------------------------


def encoded(hashed: DataFrame) -> DataFrame:
    """(..., rare, common) of rows (..., h) that are a kept table: the distinct words of h as bytes, from rare to frequent.

    h holds hashes of 63 bits. The most frequent words (of a list of FREQUENT) become their rank in two bytes, others
    stay in eight. Any order gives the same result; only how long the lists are that a search reads depends on it.
    """
    counts = hashed.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    ranked = np.array([r.h for r in counts.orderBy(F.desc("n"), "h").limit(FREQUENT).collect()][::-1], np.int64)
    by = np.argsort(ranked)
    table = hashed.sparkSession.sparkContext.broadcast((ranked[by], by))
    others = [c for c in hashed.columns if c != "h"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, ranks = table.value
        for batch in batches:
            column = batch.column("h")
            flat = column.flatten().to_numpy()
            place = np.minimum(np.searchsorted(values, flat), max(len(values) - 1, 0))
            common = values[place] == flat if len(values) else np.zeros(len(flat), bool)
            rank = ranks[place] if len(values) else place
            rare, often, start = [], [], 0
            for n in column.value_lengths().to_pylist():
                one = slice(start, start + n)
                rare.append(np.sort(flat[one][~common[one]]).astype("<i8").tobytes())
                often.append(np.sort(rank[one][common[one]]).astype("<u2").tobytes())
                start += n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(rare, pa.binary()), pa.array(often, pa.binary())], names=[*others, "rare", "common"])

    kinds = dict(hashed.dtypes)
    return hashed.select(*others, "h").mapInArrow(encode, ", ".join(f"{c} {kinds[c]}" for c in others) + ", rare binary, common binary")


def _firsts(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which words are among the first ones of their set, for all sets one after another: a byte a word, where places take eight."""
    return np.repeat(np.tile([True, False], len(n)), np.column_stack((first, n - first)).ravel())


class _Sets:
    """The distinct sets of a table, with the ids of the rows that hold each."""

    def __init__(self, table: pa.Table):
        classes: dict[tuple[bytes, bytes], int] = {}
        at = np.array([classes.setdefault(x, len(classes)) for x in zip(table["rare"].to_pylist(), table["common"].to_pylist(), strict=True)], np.int64)
        self.members = table["id"].to_numpy()[np.argsort(at, kind="stable")]
        self.n_members = np.bincount(at, minlength=len(classes))
        self.first = np.cumsum(self.n_members) - self.n_members
        self.rare = np.frombuffer(b"".join(r for r, _ in classes), "<i8")
        self.common = np.frombuffer(b"".join(c for _, c in classes), "<u2")
        self.n_rare = np.array([len(r) // 8 for r, _ in classes], np.int64)
        self.n_common = np.array([len(c) // 2 for _, c in classes], np.int64)
        self.n = self.n_rare + self.n_common
        self.at = np.cumsum(self.n) - self.n

    def words(self, rare: np.ndarray) -> np.ndarray:
        """All words as numbers that rise from rare to frequent: places in the sorted rare words of the pool (-1: none), then ranks."""
        out = np.empty(int(self.n.sum()), np.int32)
        places = np.minimum(np.searchsorted(rare, self.rare), max(len(rare) - 1, 0))
        first = _firsts(self.n_rare, self.n)
        out[first] = np.where(rare[places] == self.rare, places, -1) if len(rare) else -1
        often = self.common.astype(np.int32)
        often += len(rare)
        out[~first] = often
        return out


def similar_sets(queries: pa.Table, pool: pa.Table, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ids (arrays of equal length) whose sets have a Jaccard similarity of ``least`` or more.

    Similar sets share a word among the first (1 - least) of their words, and one; of the set whose prefix ends
    first, all shared words lie in both prefixes or behind its prefix, which bounds what they can share.
    """
    a, b = _Sets(queries), _Sets(pool)
    rare = np.unique(b.rare)
    qw, pw = a.words(rare), b.words(rare)
    prefix = lambda n: n - np.ceil(least * n - SLACK).astype(np.int64) + 1
    pa_, pb = prefix(a.n), prefix(b.n)
    holders = np.repeat(np.arange(len(b.n), dtype=np.int32), pb)
    size = len(rare) + FREQUENT
    heads = pw[_firsts(pb, b.n)]
    lists = holders[np.argsort(heads, kind="stable")]
    del holders
    counts = np.bincount(heads, minlength=size)
    starts = np.cumsum(counts) - counts
    last = pw[b.at + pb - 1]
    flags = np.zeros(size + 1, bool)
    for i in range(len(a.n)):
        n = int(a.n[i])
        mine = qw[a.at[i] : a.at[i] + n]
        head = mine[: pa_[i]]
        head = head[head >= 0]
        touched = lists[_ranges(starts[head], counts[head])]
        if not len(touched):
            continue
        if len(touched) * 8 > len(b.n):
            shared = np.bincount(touched, minlength=len(b.n))
            found = np.nonzero(shared)[0]
            shared = shared[found]
        else:
            found, shared = np.unique(touched, return_counts=True)
        m = b.n[found]
        end = mine[pa_[i] - 1]
        # where a word that the pool has not ends this prefix, either rest may hold the others
        behind = np.where(last[found] < end, m - pb[found], n - pa_[i]) if end >= 0 else np.maximum(m - pb[found], n - pa_[i])
        good = (m >= least * n) & (n >= least * m) & (shared + behind >= least / (1 + least) * (n + m) - SLACK)
        found, m = found[good], m[good]
        if not len(found):
            continue
        flags[mine] = True
        flags[-1] = False
        same = _sums(flags[pw[_ranges(b.at[found], m)]].astype(np.int32), m)
        flags[mine] = False
        found = found[same >= least * (n + m - same)]
        match = b.members[_ranges(b.first[found], b.n_members[found])]
        if len(match):
            ids = a.members[a.first[i] : a.first[i] + a.n_members[i]]
            yield np.repeat(ids, len(match)), np.tile(match, len(ids))


def jaccard_pairs(queries: DataFrame, pool: DataFrame, least: float) -> DataFrame:
    """(q, p): ids of rows whose encoded sets (id, rare, common) are that similar; the tables are kept ones."""
    terms = F.sum(F.length("rare") / 8 + F.length("common") / 2).cast("long")
    n_q, n_p = (df.agg(F.coalesce(terms, F.lit(0)).alias("n")).first().n for df in (queries, pool))
    shards, blocks = max(8, -(-n_p // SET_TERMS)), max(4, -(-n_q // SET_TERMS))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = list(similar_sets(left, right, least)) if left.num_rows and right.num_rows else []
        q, p = (np.concatenate([x[i] for x in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
        return pa.table({"q": q, "p": p})

    rows = lambda df: df.select("id", "rare", "common")
    return cells(rows(queries), rows(pool), shards, blocks, "id", "id", search, "q long, p long")
