from __future__ import annotations

import numpy as np
import pytest

from recordloom.llm import quality, toxicity
from recordloom.llm.queries import queries

SF = "/root/testdata/sf0.01"


def test_density_differences_match_plain_gaussians():
    rng = np.random.default_rng(5)
    y = (np.arange(400) % 3 > 0).astype(int)
    x = rng.normal(size=(400, 4)) + y[:, None] * [2, 0, 1, 0]
    m = quality._gaussians(x, y, (0.2, 0.1))
    z = (x - x.mean(0)) / (x.std(0) + 1e-6)
    pooled = sum((y == k).sum() * np.cov(z[y == k].T, bias=True) for k in (0, 1)) / 400
    log = []
    for k in (0, 1):
        s = 0.7 * np.cov(z[y == k].T, bias=True) + 0.2 * pooled + 0.1 * np.diag(np.diag(pooled)) + 1e-3 * np.eye(4)
        d = z - z[y == k].mean(0)
        log.append(np.log((y == k).mean()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    assert np.allclose(m.difference(x), log[1] - log[0])


@pytest.mark.parametrize(("name", "label", "held", "least"), [("op1_quality_classifier", "quality", (5, 0), 0.95), ("op5_toxicity", "toxic", (3, 1), 0.93)])
def test_held_out_accuracy(spark, name, label, held, least):
    import zlib

    rows = queries()[name](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % held[0] == held[1]) and 0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(a == b for a, b in out) >= least * len(out)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_and_labels(spark, module):
    texts = [None, "", "word", "long text here " * 30000, "idiot scum idiot scum", "idiot scum idiot scum"]
    docs = spark.createDataFrame([(i if i != 2 else None, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, score int, label string")
    few = spark.createDataFrame([(0, None, None), (None, 1, 1), (1, 1, 1), (1, 0, 0), (4, 0, 1)], "doc_id long, quality int, toxic int")
    for labels in (few, few.limit(0)):
        got = module.score(docs, labels)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        rows = got.collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert module.score(docs.limit(0), few).count() == 0
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    many = spark.createDataFrame([(i, "IDIOT!! " * 9 + str(i) if i % 2 else "some calm words " + "abc"[i % 3]) for i in range(60)], "doc_id long, text string")
    rows = module.score(many, labels).collect()
    assert all((r.score > 0.7) == (r.doc_id % 2 == 1) for r in rows)


def test_accepted_keeps_rows_and_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in quality.score(docs, labels).where("predicted = 1").collect()}


def synthetic(n, toxic, rng):
    """Votes of a toxic voter and its copy, two more toxic ones and a clean one that abstain at random."""
    y = rng.random(n) < toxic
    fire = lambda p, q: np.where(y, rng.random(n) < p, rng.random(n) < q)
    a, b, c, clean = fire(0.7, 0.05), fire(0.6, 0.03), fire(0.5, 0.1), fire(0.08, 0.8)
    return y, np.stack([a, a, b, c, clean], axis=1).astype(float), np.array([1, 1, 1, 1, -1.0])


@pytest.mark.parametrize("toxic", [0.1, 0.3])
def test_label_model_finds_accuracies_without_labels(toxic):
    y, votes, polarity = synthetic(8000, toxic, np.random.default_rng(6))
    model = toxicity.label_model(votes, polarity)
    assert np.allclose(model.fires[1], [0.7, 0.7, 0.6, 0.5, 0.08], atol=0.08) and np.allclose(model.fires[0], [0.05, 0.05, 0.03, 0.1, 0.8], atol=0.04)
    assert abs(model.prior - toxic) < 0.04
    assert model.weight[0] < 0.65 and model.weight[1] < 0.65 and model.weight[2] > 0.8 and model.weight[4] > 0.8
    found = model.posterior(votes) > 0.5
    assert (found == y).mean() > 0.94


def test_dependence_has_both_signs():
    y, votes, _ = synthetic(4000, 0.3, np.random.default_rng(7))
    votes = np.concatenate([votes, 1 - votes[:, :1]], axis=1)  # a voter that never votes with the first
    q = y.astype(float)
    fires = np.stack([votes[~y].mean(axis=0), votes[y].mean(axis=0)])
    c = toxicity.dependence(votes, q, fires)
    assert c[0, 1] > 0.99 and c[0, 5] < -0.99 and abs(c[0, 2]) < 0.1


def test_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").collect()}
    rows = [(r.predicted, truth[r.doc_id]) for r in queries()["op5_toxicity"](spark, sf).where("held_out").collect() if r.doc_id in truth]
    caught = sum(p and t for p, t in rows)
    assert caught >= 0.9 * sum(t for _, t in rows) and caught >= 0.95 * sum(p for p, _ in rows)
