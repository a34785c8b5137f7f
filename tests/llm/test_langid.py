from __future__ import annotations

import itertools
import zlib

import numpy as np

from recordloom.llm import langid
from recordloom.llm.queries import queries

SF = "/root/testdata/sf0.01"


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(7)
    scores = rng.normal(size=(30, 3)) * 4
    index = [rng.integers(0, 30, n) for n in (7, 6, 6, 3, 1, 0)]

    def total(x, path):
        return sum(scores[w, s] for w, s in zip(x, path, strict=True)) - 2.5 * sum(a != b for a, b in itertools.pairwise(path))

    for x, path in zip(index, langid.viterbi(index, scores, 2.5), strict=True):
        assert np.isclose(total(x, path), max(total(x, p) for p in itertools.product(range(3), repeat=len(x))))


def test_grams_depend_on_the_word_alone():
    words = ["the", "é", "straße", "a"]
    at, of = langid.grams(words)
    for i, w in enumerate(words):
        alone, _ = langid.grams([w])
        assert sorted(at[of == i]) == sorted(alone)
        assert len(alone) == sum(max(0, len(w) + 2 - n + 1) for n in (2, 3, 4)) + 1


def corpus(spark):
    rows = []
    for i in range(60):
        rows.append((i, "the house and the garden with that thing over there", "en"))
        rows.append((100 + i, "das haus und der garten mit dem ding und schön über", "de"))
        rows.append((200 + i, "дом и сад и эта вещь там", "ru"))
    return rows


def test_spans_of_mixed_text(spark):
    df = spark.createDataFrame(corpus(spark), "doc_id long, text string, lang string")
    model = langid.learnt(df)
    mixed = "the house and the garden with that " + "das haus und der garten " + "дом и сад " * 9
    got = langid.identify(spark.createDataFrame([(1, mixed)], "id long, text string"), model).first()
    assert [s.lang for s in got.spans] == ["en", "de", "ru"] and [s.first for s in got.spans] == [0, 7, 12] and got.lang_pred == "ru"


def test_scripts_narrow(spark):
    model = langid.learnt(spark.createDataFrame(corpus(spark), "doc_id long, text string, lang string"))
    assert [model.langs[i] for i in model.scripts["cyrillic"]] == ["ru"] and sorted(model.langs[i] for i in model.scripts["latin"]) == ["de", "en"]
    model.learn(["жжж", "日本"])
    assert (model.scores[model.words["жжж"]].argmax(), model.scores[model.words["日本"]].tolist()) == (2, [0, 0, 0])


def test_odd_rows(spark):
    rows = [*corpus(spark), (None, "das haus", "de"), (900, None, "en"), (901, "", None), (902, "12 ² --", "en"), (903, "the house " * 20000, None), (903, "the house " * 20000, None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, score int, id string")
    got = langid.predict(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[900] == by[901] == by[902] == ("und", 0.0) and by[903][0] == "en" and by[None][0] == "de"
    assert langid.predict(df.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.predict(df.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}


def test_held_out_accuracy(spark):
    got = queries()["op9_language_id"](spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(held) >= 0.98 * len(held)
