from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from recordloom.llm import suffix_dedup
from recordloom.llm.queries import queries


def slow(docs):
    raws = [(t or "").encode() for _, t in docs]
    counts = Counter(hash(r[i : i + 200]) for r in raws for i in range(len(r) - 199))
    out = []
    for (d, _), r in zip(docs, raws, strict=True):
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if counts[hash(r[i : i + 200])] > 1:
                gone[i : i + 200] = b"\1" * 200
        spans = bytes(gone).replace(b"\0", b" ").split()
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((d, len(r), sum(gone), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def same(df, docs):
    assert sorted(str(tuple(r)[:5]) for r in df.collect()) == slow(docs)


def texts(rng):
    passage = "".join(rng.choice("abcdé fgh\n") for _ in range(900))
    out = []
    for i in range(60):
        a = rng.randrange(600)
        b = a + rng.choice([150, 199, 200, 201, 300])
        own = lambda: "".join(rng.choice("ijklm nop") for _ in range(rng.randrange(400)))
        out.append((i, own() + passage[a:b] + own()))
    return out


@pytest.mark.parametrize(("hot", "block"), [(None, 1024), (3, 1024), (None, 2), (None, 5)])
def test_passages_in_many_texts(spark, hot, block, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    docs = texts(random.Random(12))
    same(suffix_dedup.removed(spark.createDataFrame(docs, "doc_id long, text string"), hot=hot), docs)


def test_odd_rows(spark):
    rng = random.Random(13)
    once = "".join(rng.choice("qwertyuiop as") for _ in range(5000))
    docs = [(1, None), (2, ""), (3, "x" * 199), (4, "y" * 5000), (5, once), (6, once + "!"), (7, "ab" * 90 + once[:210] + "é" * 300), (8, "same"), (8, "same"), (9, once[1000:1500]), (9, once[1000:1500]), (None, once[:400]), (None, "z" * 230), (None, None), (10, "".join(rng.choice("gfdsa") for _ in range(150000)))]
    df = spark.createDataFrame([(*d, 5, 1, "s") for d in docs], "doc_id long, text string, id int, mark int, parts string")
    same(suffix_dedup.removed(df), docs)
    assert suffix_dedup.removed(df.limit(0)).count() == 0
    kept = suffix_dedup.without_repeats(df.withColumnRenamed("id", "n_chars"))
    assert kept.columns == ["doc_id", "text", "n_chars", "mark", "parts"] and kept.schema == df.withColumnRenamed("id", "n_chars").schema
    left = {}
    for r in kept.collect():
        left.setdefault(r.doc_id, []).append((r.text, r.n_chars))
    assert left[1] == [(None, 5)] and left[2] == [("", 5)] and left[None][-1] == (None, 5)
    assert left[6] == [("!", 1)] and left[8] == [("same", 5)] * 2 and 9 not in left and 4 not in left and left[7][0][0] == "ab" * 90


def test_long_texts_are_hashed_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 700)
    docs = texts(random.Random(14))
    docs.append((99, "".join(t for _, t in docs)))
    same(suffix_dedup.removed(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_whole_table_against_brute_force(spark, tiny):
    got = queries()["op3_suffix_array_dedup"](spark, tiny)
    same(got, [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()])
