from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordloom.config import Config
from recordloom.functions import constants as C
from recordloom.operators import features as X
from recordloom.operators import retrieval as R
from recordloom.plans import experiment, linkage, metrics, recall
from recordloom.sources import synthetic, tables, truth
from recordloom.sources.adapter import normalised
from recordloom.sources.workspace import kept


def positions(df):
    return df.withColumn("pos", F.regexp_extract("entity_id", r"-(\d+)$", 1).cast("long"))


@pytest.fixture(scope="module")
def world(spark):
    s1, s2, s3, wide = synthetic.frames(spark, synthetic.build(50, 40, 3))
    pool = positions(tables.pool_of(s2, s3)).withColumn("pos", F.col("pos") + F.when(F.col("source") == "S3", 100_000).otherwise(0))
    queries, pool = linkage.sides_of(kept(normalised(positions(s1)), "q"), kept(normalised(pool), "p"))
    universe = wide.select(F.col("source1_id").alias("entity"))
    return queries, pool, kept(truth.parse(wide), "t"), universe


def by_pair(df):
    return {(r.q, r.p): r.score for r in df.select("q", "p", "score").collect()}


def test_token_cosine_against_plain_python(spark, world):
    queries, pool, *_ = world
    tokens = lambda t: [w for w in t.split() if len(w) >= 2 and w.isascii()]
    docs = {r.p: tokens(r.name_core) for r in pool.collect()}
    n, df = len(docs), Counter(t for ws in docs.values() for t in set(ws))
    idf = {t: math.log((1 + n) / (1 + d)) + 1 for t, d in df.items() if d <= 0.7 * n}

    def unit(ws):
        w = {t: k * idf[t] for t, k in Counter(ws).items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1
        return {t: x / norm for t, x in w.items()}

    vectors = {p: unit(ws) for p, ws in docs.items()}
    got = by_pair(R.token_name(queries, pool, 10, 0.3))
    for r in queries.collect():
        q = unit(tokens(r.name_core))
        scores = sorted(((-round(s, 10), p) for p, v in vectors.items() if (s := sum(x * v.get(t, 0) for t, x in q.items())) > 0))[:10]
        want = {(r.q, p): -s for s, p in scores if -s >= 0.3}
        found = {k: v for k, v in got.items() if k[0] == r.q}
        assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_neighbours_share_prefix_bytes(world):
    queries, pool, *_ = world
    rows = sorted((r.name_core.encode(), r.p) for r in pool.collect() if r.name_core)
    got = {(r.q, r.p) for r in R.neighbours(queries, pool, window=4).collect()}
    want = {(r.q, p) for r in queries.collect() if r.name_core for k, p in [x for x in rows if x[0][:6] == r.name_core.encode()[:6]][:5]}
    assert got == want


def test_budget_keeps_the_rarest_term(world):
    queries, pool, *_ = world
    index = R.name_index(pool)
    for budget in (0, 10**9):
        chosen = {}
        for r in index.chosen(queries, budget).collect():
            chosen.setdefault(r.q, []).append(r.term)
        assert all(len(t) == 1 if budget == 0 else len(t) <= 3 for t in chosen.values())
    assert all(0 <= s <= math.sqrt(2) for s in by_pair(index.gather(queries, 3000)).values())


def test_generation_to_decision(spark, world, tmp_path):
    queries, pool, pairs, universe = world
    config = Config.load(overrides={"models.candidates": "logistic_regression", "models.n_splits": 2, "models.max_iter": 20})
    cands = kept(linkage.legacy_candidates(queries, pool, config), "c")
    assert cands.groupBy("q").count().agg(F.max("count")).first()[0] <= 400 and cands.where("mask = 0").count() == 0
    rows = kept(linkage.featured(cands, queries, pool), "f")
    assert [c for c in rows.columns if c in X.FEATURES] == list(X.FEATURES)
    told = kept(X.labelled(rows.withColumnRenamed("entity", "s1_id"), pairs.withColumnRenamed("entity", "s1_id")).withColumnRenamed("s1_id", "entity"), "l")
    found = recall.candidate_recall(pairs, linkage.with_ids(cands, queries, pool), pool.select(F.col("entity_id").alias("match_id"), "source"), C.LEGACY_BITS)
    assert found.where("kind = 'overall'").first().recall > 0.8
    model, threshold, validation = linkage.train(told, pairs, universe, config)
    assert validation.winner == "logistic_regression" and validation.points[validation.winner]["f05"] > 0.3 and len(linkage.importances(model)) == 62
    linkage.save_bundle(spark, model, threshold, f"file://{tmp_path}/bundle")
    again, same = linkage.load_bundle(spark, f"file://{tmp_path}/bundle")
    assert same == threshold
    out = kept(linkage.infer(again, threshold, queries, pool, config), "o").where("matched")
    assert metrics.macro(out, pairs, universe).first().f05 > 0.3


def test_experiment_agrees_with_real_caps(world):
    queries, pool, pairs, _ = world
    ranked = kept(linkage.with_ids(linkage.scale_candidates(queries, pool, cap=0), queries, pool), "r")
    known = pool.select(F.col("entity_id").alias("match_id"))
    from recordloom.operators.select import CONFIGURATIONS, Selection, select

    rows = {r.name: r for r in experiment.measured(ranked, pairs, known, [Selection("cap_5", 5), Selection("cap_20", 20), CONFIGURATIONS["G2"]]).collect()}
    assert rows["cap_5"].pair_recall <= rows["cap_20"].pair_recall and rows["cap_20"].pair_recall > 0.5
    real = {(r.q, r.p) for r in linkage.scale_candidates(queries, pool, cap=20).collect()}
    assert real == {(r.q, r.p) for r in select(ranked, Selection("", 20)).collect()}
    told = {r.name: r for r in experiment.measured(ranked, pairs, known, [Selection("cap_50", 50)], {"D2": (50, "union")}).collect()}
    assert told["D2"].cap == 50 and 0 < told["D2"].candidates <= told["cap_50"].candidates and told["D2"].pair_recall > 0.5


def test_features_of_empty_values(spark):
    blank = dict.fromkeys(("business_name", "name_norm", "name_core", "addr_norm", "country_norm", "pincode", "house_number", "city", "state"), "")
    one = {"q": 1, **blank}, {"q": 2, **blank, "business_name": "a", "name_norm": "ab 12", "name_core": "ab 12", "country_norm": "us"}
    queries = spark.createDataFrame([tuple(r.values()) for r in one], list(one[0]))
    pool = queries.withColumnRenamed("q", "p")
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "q long, p long")
    rows = {(r.q, r.p): r for r in X.checked(X.pair_features(pairs, queries, pool)).collect()}
    assert rows[1, 1].name_both_missing == 1 and rows[1, 1].name_levenshtein_similarity == 0 and rows[1, 2].country_missing == 1
    same = rows[2, 2]
    assert same.name_exact_match == same.name_jaccard == same.name_numeric_match == same.name_token_set_ratio == 1 and abs(same.name_tfidf_cosine - 1) < 1e-9


def test_stream_writes_what_a_batch_generates(spark, world, tmp_path):
    from recordloom.streaming import candidates

    queries, pool, *_ = world
    raw = queries.withColumnRenamed("q", "pos").select("pos", "entity_id", "business_name", "business_address", "country")
    raw.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(raw.schema).parquet(f"{tmp_path}/in")
    seen = []
    candidates.generate(stream, pool, f"{tmp_path}/out", f"{tmp_path}/check", on_batch=lambda n, df: seen.append(df.count()), once=True).awaitTermination()
    want = linkage.scale_candidates(queries, pool).count()
    assert sum(seen) == spark.read.parquet(f"{tmp_path}/out").count() == want


def test_placed_truth_meets_candidates_as_ids_do(spark, tiny):
    """Truth pairs with positions give the same recall as candidates with ids, and the candidates are dealt without ids."""
    from recordloom import queries as core

    queries, pool = core.both(spark, tiny)
    ids, rows = core.candidates(spark, tiny), core.full_union(spark, tiny)
    pairs, placed = core.truth_of(spark, tiny), core.placed_truth(spark, tiny)
    known = placed.join(queries.select("q", F.col("entity_id").alias("entity")), ["q", "entity"]).join(pool.select("p", F.col("entity_id").alias("match_id")), ["p", "match_id"])
    assert placed.count() == pairs.count() == known.count() > 0
    for f in (recall.attribution, recall.rank_diagnostics, recall.missing_pairs):
        assert sorted(map(str, f(pairs, ids).collect())) == sorted(map(str, f(placed, rows).collect()))
    universe = core.universe_of(spark, tiny)
    assert recall.candidate_stats(ids, universe).collect() == recall.candidate_stats(recall.counted(rows, queries), universe).collect()
    plan = core.queries()["rank_diagnostics"](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "entity_id" not in plan


def test_check_of_features_keeps_plans_small_and_fails_on_any_that_is_not_finite(spark, tiny):
    from recordloom import queries as core

    pairs, queries, pool = core.feature_pairs(spark, tiny)
    rows = X.pair_features(pairs, queries, pool)
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(X.checked(rows)) < 1.1 * size(rows)
    good = dict.fromkeys(X.FEATURES, 0.5)
    schema = "q long, " + ", ".join(f"{c} double" for c in X.FEATURES)
    frame = lambda **other: spark.createDataFrame([(1, *good.values()), (2, *(good | other).values())], schema)
    assert X.checked(frame()).count() == 2
    for value in (None, float("nan"), float("inf")):
        with pytest.raises(Exception, match="not finite: name_jaccard,city_match"):
            X.checked(frame(name_jaccard=value, city_match=value)).collect()
