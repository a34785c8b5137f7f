from __future__ import annotations

import math
import random

import pytest

from recordloom.operators import pairs as P


def grams(text, least, most):
    padded = [f" {w} " for w in text.split()]
    return [w[i : i + n] for w in padded for n in range(least, most + 1) if n == least or len(w) >= n for i in range(max(len(w) - n, 0) + 1)]


@pytest.mark.parametrize("most_terms", [P.VECTOR_TERMS, 300])
def test_cosines_of_pairs_against_brute_force(spark, monkeypatch, most_terms):
    """One cell size and many small cells; repeated words, empty and null texts, pool rows that are not there."""
    monkeypatch.setattr(P, "VECTOR_TERMS", most_terms)
    rng = random.Random(3)
    words = ["ab", "abc", "oak", "oaks", "mill", "milling", "x", "überoak", "zzz"]
    text = lambda: " ".join(rng.choices(words, k=rng.randint(1, 5)))
    asked = [(i, text(), text()) for i in range(12)] + [(12, "", None), (13, "oak oak oak", "x")]
    pool = [(i, text(), text()) for i in range(40)] + [(40, None, ""), (41, "oak", "x x")]
    queries, rows = (spark.createDataFrame(r, f"{k} long, name_core string, addr_norm string") for k, r in (("q", asked), ("p", pool)))
    chosen = sorted({(rng.randrange(14), rng.randrange(42)) for _ in range(200)} | {(12, 40), (13, 41), (0, 99)})
    texts = {"a": ("name_core", 2, 5), "b": ("addr_norm", 2, 4)}
    got = {(r.q, r.p): (r.a, r.b) for r in P.pair_cosines(spark.createDataFrame(chosen, "q long, p long"), queries, rows, texts).collect()}
    assert sorted(got) == chosen and got[0, 99] == got[12, 40] == (0.0, 0.0)
    for i, (_, least, most) in enumerate(texts.values(), 1):
        every = [grams(r[i] or "", least, most) for r in (*asked, *pool)]
        df = {g: sum(g in h for h in map(set, every)) for g in set().union(*every)}

        def vector(tokens):
            raw = {g: (1 + math.log(tokens.count(g))) * (math.log((1 + len(every)) / (1 + df[g])) + 1) for g in set(tokens) if df[g] <= 0.995 * len(every)}  # noqa: B023
            norm = math.sqrt(sum(x * x for x in raw.values()))
            return {g: x / norm for g, x in raw.items()}

        vectors = list(map(vector, every))
        for q, p in chosen:
            want = sum(x * vectors[14 + p].get(g, 0.0) for g, x in vectors[q].items()) if p < 42 else 0.0
            assert abs(got[q, p][i - 1] - want) < 1e-9


def test_features_start_from_kept_cosines(spark, tiny):
    """The plan of all features has no n-grams and few exchanges: one of cosines and features together takes the driver's memory."""
    from recordloom import queries as core

    plan = core.queries()["pair_features"](spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and plan.count("Join") <= 2 and plan.count("Aggregate") == 0
