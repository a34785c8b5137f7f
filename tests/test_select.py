from __future__ import annotations

import random

import pytest

from recordloom.functions import constants as C
from recordloom.operators import select as S

B = C.SCALE_BITS


def build(spark, rows):
    """(query, pool, mask) in ranked order."""
    seen, out = {}, []
    for q, p, m in rows:
        out.append((q, p, m, seen.get(q, 0)))
        seen[q] = seen.get(q, 0) + 1
    return spark.createDataFrame(out, "q long, p long, mask int, rank int")


def kept(spark, rows, **options):
    found = {}
    for r in S.select(build(spark, rows), S.Selection(**options)).collect():
        found.setdefault(r.q, set()).add(r.p)
    return found


NAME, ADDR, SN, COUNTRY = 4, 8, 16, 32


@pytest.mark.parametrize(
    ("rows", "options", "want"),
    [
        ([(0, 10, 1), (0, 11, 4), (0, 12, 8), (0, 13, 12), (0, 14, 32)], {"cap": 3}, {0: {10, 11, 12}}),
        ([(0, 10, 4), (0, 11, 4), (1, 20, 4)], {"cap": 1}, {0: {10}, 1: {20}}),
        ([(0, 10, 4), (0, 11, 4), (0, 12, 4), (0, 20, 8), (0, 21, 8), (1, 30, 4), (1, 31, 4), (1, 32, 4)], {"cap": 0, "quotas": {"name_token": 1, "address_token": 1}, "always": ()}, {0: {10, 20}, 1: {30}}),
        ([(0, 10, 4), (0, 11, 4), (0, 12, 4), (0, 20, 2)], {"cap": 0, "quotas": {"name_token": 1}}, {0: {10, 20}}),
        ([(0, 10, 4), (0, 11, 4), (0, 12, 4), (0, 20, 8), (0, 21, 8), (0, 22, 8)], {"cap": 3, "quotas": {"name_token": 2, "address_token": 2}}, {0: {10, 11}}),
        ([(0, 10, 4), (0, 11, 4), (0, 12, 4), (0, 20, 8), (0, 21, 8), (0, 22, 8)], {"cap": 3, "quotas": {"name_token": 2, "address_token": 2}, "mode": "union"}, {0: {10, 11, 20}}),
        ([(0, 10, 32), (0, 11, 36), (0, 12, 4), (0, 13, 4)], {"cap": 2, "exclude_only": ("country_token",)}, {0: {11, 12}}),
        ([(0, 10, 32), (0, 11, 32)], {"cap": 1, "exclude_only": ("country_token",)}, {0: {10, 11}}),
        ([(0, 10, 32), (0, 11, 4), (0, 12, 4), (0, 13, 4), (0, 20, 8), (0, 21, 8), (0, 22, 8)], {"cap": 10, "quotas": {"name_token": 1, "address_token": 1}, "exclude_only": ("country_token",), "mode": "union"}, {0: {11, 20}}),
        ([(0, 10, 4), (0, 11, 4)], {"cap": 1, "quotas": {"address_token": 3}}, {0: {10}}),
        ([], {"cap": 1, "quotas": {"address_token": 3}}, {}),
    ],
)
def test_cases(spark, rows, options, want):
    assert kept(spark, rows, **options) == want


def slow(rows, cap, quotas, exclude, mode):
    """The rules in plain loops over ranked rows."""
    ex = sum(B[s] for s in exclude)
    base = [not (m & ex and not m & ~ex) for _, _, m in rows]
    if not any(base):
        return {(q, p) for q, p, _ in rows}
    used, ok = {}, []
    for q, _, m in rows:
        good = bool(m & 3) if quotas else True
        for s, n in quotas.items():
            if m & B[s]:
                used[q, s] = used.get((q, s), 0) + 1
                good |= used[q, s] <= n
        ok.append(good)
    if quotas and not any(ok):
        ok = [True] * len(rows)
    out, left, rank = set(), {}, {}
    for (q, p, _), b, good in zip(rows, base, ok, strict=True):
        r = rank.get(q, 0)
        rank[q] = r + 1
        if b and good:
            k = left.get(q, 0)
            left[q] = k + 1
            survivors = mode == "union" or (not quotas and not all(base))
            if (k if survivors else r) < cap:
                out.add((q, p))
    return out


def test_random_selections(spark):
    rng = random.Random(2)
    for trial in range(6):
        rows = sorted(((rng.randrange(4), i, rng.choice([1, 2, 4, 8, 16, 32, 12, 36, 40])) for i in range(60)), key=lambda r: r[0])
        quotas = {} if trial % 3 == 0 else {"name_token": 3, "address_token": 2, "sorted_neighbourhood": 1}
        exclude = ("country_token",) if trial % 2 else ()
        if not quotas and not exclude:
            exclude = ("country_token", "exact_normalized")
        for mode in ("rank", "union"):
            got = kept(spark, rows, cap=7, quotas=quotas, exclude_only=exclude, mode=mode)
            assert {(q, p) for q, ps in got.items() for p in ps} == slow(rows, 7, quotas, exclude, mode)


def test_unions_and_caps(spark):
    schema = "q long, p long, score double"
    found = {"exact_core": spark.createDataFrame([(0, 1, 1.0)], schema), "name_token": spark.createDataFrame([(0, 1, 0.4), (0, 2, 0.9), (1, 5, 0.1)], schema), "country_token": spark.createDataFrame([(0, 9, 1.0)], schema)}
    rows = {(r.q, r.p): (r.mask, r.rule_score, r.content_score, r["rank"]) for r in S.ranked(S.union_scale(found)).collect()}
    assert rows == {(0, 1): (6, 100.0, 1.0, 0), (0, 2): (4, 10.0, 0.9, 1), (0, 9): (32, 1.0, 1.0, 2), (1, 5): (4, 10.0, 0.1, 0)}
    assert S.capped_scale(S.union_scale(found), 1, 1).count() == 2 and S.capped_scale(S.union_scale(found), 0).count() == 4
    legacy = S.union_legacy({"token_name": found["name_token"], "exact_core": found["exact_core"]})
    assert {(r.q, r.p, r.mask, r.score) for r in S.capped_legacy(legacy, 1, 1).collect()} == {(0, 1, 6, 1.0), (1, 5, 4, 0.1)}


YIELDS = [("exact_normalized", 0, 0), ("exact_core", 37, 1707), ("name_token", 88, 2000), ("sorted_neighbourhood", 9, 817), ("address_token", 807, 2831), ("country_token", 0, 0)]


def test_measured_quotas(spark):
    row = S.measured_quotas(spark.createDataFrame(YIELDS, "strategy string, exclusive long, recovered long"), 100).first()
    # worth 293.05, 388, 131.55 and 1231.65 of 2044.25
    assert [row[f"__q_{s}"] for s in ("exact_core", "name_token", "sorted_neighbourhood", "address_token")] == [14, 19, 6, 60]
    assert row["__q_country_token"] is None and row["__drop"] == B["exact_normalized"] | B["country_token"]
    assert len(S.CONFIGURATIONS) == 21 and S.CONFIGURATIONS["I2"].quotas == {"name_token": 20, "address_token": 150, "sorted_neighbourhood": 20}


def test_both_quota_sets_see_the_whole_query_set(spark):
    """Query 0 has country hits alone: over all queries something is left, so its rows go."""
    rows = [(0, 1, 32), (0, 2, 32), (1, 3, 4), (1, 4, 1), (2, 5, 4)]
    base = S.Selection("", 10, {"name_token": 1}, ("country_token",), "union")
    exact = S.Selection("", 10, {"name_token": 1}, ("country_token",), "union")
    got = {(r.q, r.p) for r in S.select_adaptive(build(spark, rows), base, exact).collect()}
    assert got == {(1, 3), (1, 4), (2, 5)}


def test_adaptive_against_loops(spark):
    rng = random.Random(5)
    quotas = {"exact_core": 14, "name_token": 19, "sorted_neighbourhood": 6, "address_token": 60}
    moved = quotas | {"address_token": 101, "name_token": 4}
    yields = spark.createDataFrame(YIELDS, "strategy string, exclusive long, recovered long")
    for mode in ("rank", "union"):
        rows = sorted(((rng.randrange(3), i, rng.choice([4, 8, 16, 32, 12, 36, 33] + [2] * (i % 7 == 0))) for i in range(400)), key=lambda r: r[0])
        rows = [r for r in rows if r[0] != 2 or not r[2] & 3]  # query 2 has no exact hit
        found = S.adaptive(build(spark, rows), yields, 100, mode, "kept").where("kept")
        rest, hit = (slow(rows, 100, q, ("exact_normalized", "country_token"), mode) for q in (quotas, moved))
        exact = {q for q, _, m in rows if m & 3}
        assert {(r.q, r.p) for r in found.collect()} == {x for x in rest if x[0] not in exact} | {x for x in hit if x[0] in exact}


def test_adaptive_without_yields(spark):
    yields = spark.createDataFrame([(s, 0, 0) for s, *_ in YIELDS], "strategy string, exclusive long, recovered long")
    assert S.adaptive(build(spark, [(0, 1, 4), (0, 2, 32)]), yields, 5, "union", "kept").where("kept").count() == 2
    assert S.adaptive(build(spark, []), yields, 5, "union", "kept").count() == 0


def test_shares_of_a_pair_add_up_in_the_union(spark):
    """Rows (q, p, share) are summed per strategy, scores of others are compared with the sums."""
    shares = spark.createDataFrame([(1, 2, 0.25), (1, 2, 0.5), (1, 3, 0.0)], "q long, p long, share double")
    more = spark.createDataFrame([(1, 2, 0.5), (1, 2, 0.5)], "q long, p long, share double")
    exact = spark.createDataFrame([(1, 2, 0.8), (2, 2, 1.0)], "q long, p long, score double")
    found = S.union_scale({"name_token": shares, "address_token": more, "exact_core": exact})
    bits = S.C.SCALE_BITS
    got = {(r.q, r.p): (r.mask, r.content_score) for r in found.collect()}
    assert got == {(1, 2): (bits["name_token"] | bits["address_token"] | bits["exact_core"], 1.0), (1, 3): (bits["name_token"], 0.0), (2, 2): (bits["exact_core"], 1.0)}
    assert {r.content_score for r in S.union_scale({"name_token": shares}).collect()} == {0.75, 0.0}
