from __future__ import annotations

import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from recordloom.functions import text as T
from recordloom.functions.text import ascii_tokens, hashed_words, plain_words, strip_accents
from recordloom.operators import retrieval as R
from recordloom.operators import search
from recordloom.operators import select as S
from recordloom.sources import adapter
from recordloom.sources.workspace import kept
from pyspark.sql import functions as F


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_plain_words_as_in_columns(spark):
    texts = ["Ünïcode KK ſt ﬁ İstanbul Éáb", "", "a" * 300 + " b c", "ＡＢ１ ½ ①x", " ".join(f"w{i}" for i in range(50)), "Straße ΑΣ ŁÓDŹ \U0001d400z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    want = {r.id: r.w for r in df.select("id", ascii_tokens(strip_accents(F.lower("text"))).alias("w")).collect()}
    for i, t in enumerate(texts):
        assert plain_words(t) == want[i]
        assert plain_words(t, 16) == want[i][:16]


def test_words_of_truth_are_hashed_without_strings(monkeypatch):
    """Only words of over 12 characters are hashed as strings; others are told apart exactly, whatever they are folded from."""
    rng = random.Random(3)
    odd = [chr(i) for i in range(0x250)] + [chr(c) for c in range(0x300, 0x320)] + [*"abz09 AZ" * 40, "ᴬ", "\U0001d400", "Ａ", "①", "Σ", "한", "\uffff"]
    texts = ["Ünïcode KK ſt ﬁ İstanbul Éáb e\u0301a", "", None, "!!", "a A aa 0 00 0a", "\0a\0", "z" * 12 + " " + "Z" * 13 + " " + "z" * 13 + "0", *("".join(rng.choices(odd, k=rng.randint(0, 60))) for _ in range(500)), ""]
    words = sorted({w for t in texts if t for w in plain_words(t)})
    hashed, whole = [], T.pd.util.hash_array
    monkeypatch.setattr(T.pd.util, "hash_array", lambda values, **more: hashed.extend(values) or whole(values, **more))
    ones, codes = T.word_hashes(words)
    assert (ones == 1).all() and len(set(codes.tolist())) == len(words) > 500 and codes.min() >= 0
    assert sorted(hashed) == [w for w in words if len(w) > 12] and len(hashed) >= 2
    known = dict(zip(words, codes.tolist(), strict=True))
    counts, codes = T.word_hashes(texts)
    ends = counts.cumsum().tolist()
    for text, n, end in zip(texts, counts.tolist(), ends, strict=True):
        assert codes[end - n : end].tolist() == sorted({known[w] for w in plain_words(text or "")})
    assert [len(x) for x in T.word_hashes([])] == [0, 0]


@pytest.mark.parametrize("seed", range(3))
def test_similar_sets_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(search, "FREQUENT", 30)
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    base = [rng.sample(words, rng.randint(1, 25)) for _ in range(25)]
    texts = []
    for i in range(240):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words) if rng.random() < 0.7 else f"only{i}"
        texts.append(" ".join(text))
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", None, "!!"])], "id long, text string")
    sets = kept(search.encoded(kept(hashed_words(df, "text"), "h")), "s")
    got = [tuple(r) for r in search.jaccard_pairs(sets.where("id % 3 = 0"), sets.where("id % 3 > 0"), 0.6).collect()]
    each = [set(t.split()) for t in texts]
    want = {(i, j) for i in range(0, 240, 3) for j in range(240) if j % 3 and jaccard(each[i], each[j]) >= 0.6}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50


def test_words_of_a_cell_take_few_bytes():
    """A cell numbers its words without an eight-byte place of each."""
    rng = np.random.default_rng(1)
    rare = [np.unique(rng.integers(0, 1 << 40, rng.integers(0, 20))) for _ in range(2000)]
    common = [np.unique(rng.integers(0, search.FREQUENT, rng.integers(1, 400))) for _ in range(2000)]
    sets = search._Sets(pa.table({"id": np.arange(2000), "rare": [r.astype("<i8").tobytes() for r in rare], "common": [c.astype("<u2").tobytes() for c in common]}))
    known = np.unique(sets.rare)[::2]
    tracemalloc.start()
    words = sets.words(known)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    place = {x: i for i, x in enumerate(known.tolist())}
    assert words.tolist() == [x for r, c in zip(rare, common, strict=True) for x in ([place.get(w, -1) for w in r.tolist()] + [w + len(known) for w in c.tolist()])]
    assert peak <= 16 * len(words)


@pytest.mark.parametrize(("k", "least", "apart"), [(3, 0.0, True), (5, 0.3, False), (1000, 0.2, False), (2, 0.0, False)])
def test_cosines_against_brute_force(spark, k, least, apart, monkeypatch):
    monkeypatch.setattr(search, "VECTOR_TERMS", 300)
    rng = random.Random(k)
    vectors = {}
    for i in range(150):
        raw = {f"t{min(int(rng.expovariate(0.15)), 40)}": rng.choice((1.0, 2.0, 2.5)) for _ in range(rng.randint(1, 6))}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        vectors[i] = {t: x / norm for t, x in raw.items()}
    rows = [(i, t, w) for i, v in vectors.items() for t, w in v.items()]
    queries = kept(spark.createDataFrame(rows + [(999, "unknown", 1.0)], "q long, term string, w double"), "q")
    pool = kept(spark.createDataFrame(rows, "p long, term string, w double"), "p")
    got = {}
    for r in search.cosine_search(queries, pool, k, least, apart).collect():
        got.setdefault(r.q, {})[r.p] = r.score
    for q, v in vectors.items():
        scores = sorted((-round(s, 10), p) for p, o in vectors.items() if (s := sum(x * o.get(t, 0.0) for t, x in v.items())) > 0 and not (apart and p == q))
        want = {p: -s for s, p in scores[:k] if -s >= least}
        assert got.get(q, {}).keys() == want.keys() and all(abs(got[q][p] - want[p]) < 1e-9 for p in want)
    assert 999 not in got


def test_a_frequent_word_alone_makes_no_pairs_to_score():
    """Rows that share only a word that cannot reach the threshold are never scored, so work is less than the square."""
    n = 2000
    ids = np.repeat(np.arange(n), 2)
    terms = [t for i in range(n) for t in (f"rare{i}", "the")]
    weights = np.tile([0.98, math.sqrt(1 - 0.98**2)], n)
    left = pa.table({"q": ids, "term": terms, "w": weights})
    right = pa.table({"p": ids, "term": terms, "w": weights})
    scored = []
    whole = search._sums
    try:
        search._sums = lambda values, lengths: scored.append(len(lengths)) or whole(values, lengths)
        found = [(q, p.tolist()) for q, p, _ in search.best_cosines(left, right, 150, 0.3, False)]
    finally:
        search._sums = whole
    assert found == [(i, [i]) for i in range(n)] and sum(scored) == n


def test_truth_of_repeated_texts(spark, tmp_path):
    """Many copies of one text, null and empty texts, ids that repeat: every row counts for itself."""
    rows = [(i, "one two three four", "en") for i in range(90)] + [(90, None, "en"), (91, "", "en"), (0, "one two three four", "en"), (93, "other words", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in adapter.truth_pairs(spark, str(tmp_path)).collect()]
    assert len(got) == 31 * 60 and len(set(got)) == 30 * 60


def test_pairs_of_the_union_are_dealt_once(spark):
    """A gather and the ranked union deal pairs by query alone, not by pair."""
    queries = spark.createDataFrame([(0, "red oak"), (1, "oak mill")], "q long, name_core string")
    pool = spark.createDataFrame([(0, "oak mill"), (1, "red oak"), (2, "oak")], "p long, name_core string")
    found = R.name_index(pool).gather(queries, 3000)
    ranked = S.ranked(S.union_scale({"name_token": found}))
    for df in (found, ranked):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\(q#\d+L, p#", plan) and "REPARTITION_BY_COL" in plan
    assert ranked.where("rank = 0").count() == 2


@pytest.mark.parametrize(("n_q", "n_p"), [(100_000, 200_000), (1_700_000, 3_400_000), (17_000_000, 34_000_000), (0, 0), (0, 9), (9, 0), (5_000_000, 10), (10, 5_000_000)])
def test_grids_send_little_and_bound_their_cells(n_q, n_p):
    shards, blocks = search.grid(n_q, n_p, search.VECTOR_TERMS)
    assert shards * blocks >= search.TASKS and n_p <= shards * search.VECTOR_TERMS and n_q <= blocks * search.VECTOR_TERMS
    sent, one = shards * n_q + blocks * n_p, n_q + search.TASKS * n_p
    assert sent <= one or max(n_q, n_p) > search.VECTOR_TERMS
    if (n_q, n_p) == (100_000, 200_000):
        assert sent <= one / 2


def test_character_vectors_are_one_row_a_record(spark, monkeypatch):
    """N-grams meet their idfs by word and are searched packed; scores as by brute force, repeated words and unknown n-grams included."""
    rng = random.Random(5)
    words = ["ab", "abc", "oak", "oaks", "mill", "milling", "x", "überoak"]
    pool = [" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(60)] + ["", "oak oak oak"]
    asked = ["oak oak mill", "zzz", "abc unknown", "", *pool[:10]]

    def grams(text):
        padded = [f" {w} " for w in text.split()]
        return [w[i : i + n] for w in padded for n in range(2, 6) if n == 2 or len(w) >= n for i in range(max(len(w) - n, 0) + 1)]

    held = [set(grams(t)) for t in pool]
    df = {g: sum(g in h for h in held) for g in set().union(*held)}

    def vector(text):
        tokens = grams(text)
        raw = {g: (1 + math.log(tokens.count(g))) * (math.log((1 + len(pool)) / (1 + df[g])) + 1) for g in set(tokens) if 0 < df.get(g, 0) <= 0.995 * len(pool)}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {g: x / norm for g, x in raw.items()}

    tables = []
    whole = R.cosine_search
    monkeypatch.setattr(R, "cosine_search", lambda a, b, *rest: tables.extend((a, b)) or whole(a, b, *rest))
    sides = [spark.createDataFrame(list(enumerate(texts)), f"{key} long, name_core string") for key, texts in (("q", asked), ("p", pool))]
    got = {}
    for r in R.char_name(*sides, k=7).collect():
        got.setdefault(r.q, {})[r.p] = r.score
    vectors = [vector(t) for t in pool]
    for q, text in enumerate(asked):
        v = vector(text)
        scores = sorted((-round(s, 10), p) for p, o in enumerate(vectors) if (s := sum(x * o.get(g, 0.0) for g, x in v.items())) > 0)
        want = {p: -s for s, p in scores[:7] if -s >= 0.2}
        assert got.get(q, {}).keys() == want.keys() and all(abs(got[q][p] - want[p]) < 1e-9 for p in want)
    assert [t.count() for t in tables] == [len([t for t in asked if vector(t)]), len([t for t in pool if t])]


def test_few_of_the_rows_that_share_terms_are_scored_whole():
    """Products are added up along the lists of rare terms; rows whose sums leave them no chance are not scored. Results as by brute force."""
    rng = np.random.default_rng(7)
    n, k, least = 1500, 10, 0.2
    keys = np.unique(np.repeat(np.arange(n), 25) * 3000 + np.minimum(rng.zipf(1.4, 25 * n), 3000) - 1)
    ids, terms = np.divmod(keys, 3000)
    raw = np.log(n / np.bincount(terms)[terms]) + 1
    weights = raw / np.sqrt(np.bincount(ids, raw * raw))[ids]
    dense = np.zeros((n, 3000))
    dense[ids, terms] = weights
    scores = np.round(dense @ dense.T, search.DIGITS)
    scored = []
    whole = search._sums
    try:
        search._sums = lambda values, lengths: scored.append(len(lengths)) or whole(values, lengths)
        got = {q: (p.tolist(), s) for q, p, s in search.best_cosines(pa.table({"q": ids, "term": terms, "w": weights}), pa.table({"p": ids, "term": terms, "w": weights}), k, least, False)}
    finally:
        search._sums = whole
    for q in range(n):
        want = [p for p in np.lexsort((np.arange(n), -scores[q]))[:k].tolist() if scores[q, p] >= least]
        assert got[q][0] == want and np.allclose(got[q][1], scores[q, want], atol=1e-9)
    assert sum(scored) < 0.03 * n * n
