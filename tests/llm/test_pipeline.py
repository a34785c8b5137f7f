from __future__ import annotations

import corpus_pipeline
import public_tokenizers
import test_decontaminate
import test_packing
import test_simhash
from tokenizers import Tokenizer

from recordloom.llm import quality


def without_passages(docs):
    """Brute force of the third stage on (doc_id, text)."""
    from collections import Counter

    raws = [t.encode() for _, t in docs]
    counts = Counter(r[i : i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for (d, _), r in zip(docs, raws, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if counts[r[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        text = bytes(b for b, g in zip(r, gone, strict=True) if not g).decode("utf-8", "ignore")
        if text or not any(gone):
            out.append((d, text))
    return out


def test_stages_against_brute_force(spark, tiny):
    documents, labels = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "labels"))
    docs = {r.doc_id: r.text for r in documents.collect()}
    good = {r.doc_id for r in quality.score(documents, labels).where("predicted = 1").collect()}
    kept = [(d, t) for d, t in sorted(docs.items()) if d in good]
    top = test_simhash.slow_components([(d, test_simhash.slow_fingerprint(t)) for d, t in kept])
    kept = without_passages([(d, t) for d, t in kept if top[d] == d])
    items = [tuple(r) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {r[0] for r in test_decontaminate.slow(kept, items) if r[5]}
    kept = [(d, t) for d, t in kept if d not in dirty]
    assert 0 < len(kept) < len(good) < len(docs)
    rows = corpus_pipeline.run(spark, tiny).collect()
    test_packing.whole(rows, kept, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_stages_keep_columns_and_take_odd_rows(spark, tiny):
    documents = spark.read.parquet(f"{tiny}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, "", "en", None, 0), (900002, "plain words here", None, "s", 16)] * 2, documents.schema)
    for docs in (documents.limit(40).unionByName(odd), documents.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, tiny)
            assert out.columns == documents.columns and [f.dataType for f in out.schema] == [f.dataType for f in documents.schema], name
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, tiny).collect()


def test_one_copy_of_repeated_and_unnamed_rows_survives(spark, tiny):
    schema = spark.read.parquet(f"{tiny}/documents.parquet").schema
    text = lambda k: " ".join(f"word{k}x{i}" for i in range(80))
    ids = [(1, "a"), (1, "a"), (None, "b"), (None, "b"), (None, "c"), (4, "c"), (5, "d"), (5, "e"), (6, "e"), (None, "f"), (7, "g"), (7, "g"), (8, "g")]
    docs = spark.createDataFrame([(i, text(k), "en", "s", len(text(k))) for i, k in ids], schema)
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, tiny)
    want = [(1, "a"), (None, "b"), (4, "c"), (5, "d"), (5, "e"), (None, "f"), (7, "g")]
    assert sorted((str(r.doc_id), r.text) for r in docs.collect()) == sorted((str(i), text(k)) for i, k in want)
