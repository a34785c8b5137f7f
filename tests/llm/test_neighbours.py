from __future__ import annotations

import numpy as np
import pytest

from recordloom.llm import neighbours
from recordloom.llm.queries import queries


def exact(rows, divisor=100, k=10):
    kept = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for i, q in kept:
        if i % divisor == 0:
            near = sorted((float(np.sqrt(((v - q) ** 2).sum())), j) for j, v in kept if j != i and len(v) == len(q))
            out[i] = near[:k]
    return out


def test_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.1"
    got = queries()["op6_nearest_neighbours"](spark, sf).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, vectors = exact(rows), {i: np.array(v, float) for i, v in rows}
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert by.keys() == want.keys()
    hits = 0
    for q, found in by.items():
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in found] == sorted((r.score, r.vec_id) for r in found)
        assert all(abs(r.score - np.sqrt(((vectors[r.vec_id] - vectors[q]) ** 2).sum())) < 1e-12 for r in found)
        hits += len({r.vec_id for r in found} & {j for _, j in want[q]})
    assert hits >= 0.9 * 10 * len(want)


def test_ascent_is_synchronous():
    """All trees at one prefix length; the first ones, in steps, at a length one bit shorter."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 8))
    forest = neighbours.Forest(x, trees=16)
    hashed, asked = forest.strings(x), forest.strings(x[:20])
    for q, rows in enumerate(forest.candidates(x[:20], enough=150)):
        common = np.zeros((16, 500), int)
        for length in range(1, neighbours.BITS + 1):
            shift = np.uint32(neighbours.BITS - length)
            common += hashed >> shift == (asked[:, q] >> shift)[:, None]
        options = [{*np.flatnonzero((common >= np.where(np.arange(16) < upto, length, length + 1)[:, None]).any(axis=0))} for length in range(neighbours.BITS, -1, -1) for upto in (8, 16)]
        assert {*rows.tolist()} == next(o for o in options if len(o) >= 150)


@pytest.mark.parametrize(("n", "most"), [(2000, 0.45), (10_000, 0.35), (50_000, 0.25)])
def test_share_that_is_scanned_falls_and_recall_holds(n, most):
    """Independent directions, the hardest case: no cluster helps the hash strings."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    asked = x[:: n // 40][:40]
    scanned, hits = [], 0
    for q, rows in zip(asked, neighbours.Forest(x).candidates(asked), strict=True):
        d = ((x - q) ** 2).sum(axis=1)
        scanned.append(len(rows) / n)
        hits += len({*np.argsort(d)[1:11]} & {*rows})
    assert np.mean(scanned) < most and hits >= 0.9 * 10 * len(asked)


def test_two_vectors_of_one_query_share_a_ranking(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 9.0]), (1, [1.0, 1.0]), (2, [0.0, 8.0]), (3, [1.0, -1.0])], "vec_id long, embedding array<double>")
    got = [(r["rank"], r.vec_id, r.score) for r in neighbours.all_queries(df).orderBy("rank").collect()]
    assert got[:3] == [(1, 1, 1.0), (2, 2, 1.0), (3, 3, 1.0)]


def test_odd_rows(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (100, [3.0, 4.0]), (200, [nan, 1.0]), (300, []), (400, [1.0, 1.0, 1.0]), (None, [1.0, 2.0]), (7, [inf, 0.0]), (500, None), (8, [9.0, 9.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, query_id string, score int")
    for bytes_ in (16 << 20, 16):
        monkeypatch.setattr(neighbours, "BLOCK_BYTES", bytes_)
        got = neighbours.all_queries(df).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 2), (0, 3, 2), (0, 4, 100), (0, 5, 8), (100, 1, 0), (100, 2, 0), (100, 3, 1), (100, 4, 2), (100, 5, 2), (100, 6, 8)]
        assert all(type(r.score) is float for r in got)
    assert neighbours.all_queries(df.limit(0)).count() == 0
