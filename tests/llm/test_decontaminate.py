from __future__ import annotations

import hashlib
import random
import re

from recordloom.llm import decontaminate
from recordloom.llm.queries import queries

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def slow(docs, items):
    out = []
    for d, t in docs:
        ws, hit, named = words(t), set(), set()
        for name, text in items:
            iw = words(text)
            n = min(13, len(iw))
            wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for i in range(len(ws) - n + 1 if n else 0):
                if tuple(ws[i : i + n]) in wins:
                    hit.update(range(i, i + n))
                    named.add("" if name is None else str(name))
        out.append((d, len(ws), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(ws)))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame([(*x, 1, "y") for x in docs], "doc_id long, text string, item_id int, n_hit string")
    b = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, doc_id int")
    return d, b, decontaminate.search(d, b)


def key(r):
    return str(tuple(r)[:6])


def test_random_texts_against_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    vocabulary = ["a", "b", "C", "dé", "ß9", "É"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", "_"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 5, 12, 13, 14, 40, 60]))) for i in range(12)]
    docs = [(i, text(rng.randint(0, 60)) + rng.choice(items)[1] + text(rng.randint(0, 300))) for i in range(40)]
    docs += [(100 + i, " ".join(words(items[-1][1])[3:20])) for i in range(3)]
    for limit in (4 << 20, 60):  # one block and several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", limit)
        _, _, got = run(spark, docs, items)
        assert sorted(map(key, got.collect())) == sorted(map(key, slow(docs, items)))
    long_only = [(i, t) for i, t in items if len(words(t)) >= 13]
    _, _, got = run(spark, docs, long_only)
    assert sorted(map(key, got.collect())) == sorted(map(key, slow(docs, long_only)))


def test_longest_match_and_odd_rows(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    items = [(7, passage), (8, "Short one"), (None, passage), (9, None), (10, "--"), (7, passage)]
    docs = [(1, None), (2, ""), (3, "x " * 50000 + passage + " y" * 700), (4, f"z {passage[:60]}"), (None, "a short ONE b"), (5, passage), (5, passage), (6, " ".join(passage.split()[:12]))]
    d, b, got = run(spark, docs, items)
    rows = got.collect()
    assert sorted(map(key, rows)) == sorted(map(key, slow(docs, items)))
    assert {r.doc_id: r.longest_match for r in rows} == {1: 0, 2: 0, 3: 30, 4: 17, None: 2, 5: 30, 6: 12}
    assert next(r for r in rows if r.doc_id == 5)["items"] == ["", "7"]
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6]
    assert decontaminate.search(d, b.limit(0)).where("contaminated").count() == 0
    assert decontaminate.search(d.limit(0), b).count() == 0


def longest(docs, items, least=4):
    """Per document and word the longest run that some item holds, and the places where it starts."""
    out = {}
    for d, t in docs:
        ws, best = words(t), {}
        for name, text in items:
            iw = words(text)
            for p in range(len(ws)):
                for j in range(len(iw)):
                    n = 0
                    while p + n < len(ws) and j + n < len(iw) and ws[p + n] == iw[j + n]:
                        n += 1
                    if n >= least or (n and n == len(iw)):
                        if n > best.get(p, (0,))[0]:
                            best[p] = (n, set())
                        if n == best[p][0]:
                            best[p][1].add((name, j))
        out[d] = best
    return out


def test_longest_matches_against_brute_force(spark, monkeypatch):
    """Items side by side and overlapping, matches of under 13 words, texts that repeat themselves."""
    rng = random.Random(4)
    w = [f"w{i}" for i in range(80)]
    items = [(0, " ".join(w[:13])), (1, " ".join(w[13:26])), (2, " ".join(w[30:45])), (3, " ".join(w[40:60])), (4, " ".join(w[50:80])), (5, "x " * 30), (6, "two words"), (7, " ".join(rng.choice("pq") for _ in range(40)))]
    docs = [
        (1, " ".join(w[:26])), (2, " ".join(w[38:55])), (3, "z " + " ".join(w[55:67]) + " z"), (4, "x " * 70), (5, "two words two Words three"), (6, " ".join(w[31:34])),
        (7, " ".join(w[31:35])), (8, " ".join(rng.choice("pq") for _ in range(90))), (9, " ".join(w[60:80] + w[50:80])), (10, None),
    ]
    want = longest(docs, items)
    for limit in (4 << 20, 40):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", limit)
        d, b, got = run(spark, docs, items)
        rows = got.collect()
        assert sorted(map(key, rows)) == sorted(map(key, slow(docs, items)))
        assert {r.doc_id: r.longest_match for r in rows} == {d: max((n for n, _ in best.values()), default=0) for d, best in want.items()}
        for r in rows:
            best = {p: (n, at) for p, (n, at) in want[r.doc_id].items() if n >= 4}
            if limit > 40:
                assert {(m.word, m.words) for m in r.matches} == {(p, n) for p, (n, _) in best.items() if best.get(p - 1, (0,))[0] != n + 1}
                assert all((int(m["item"]), m.item_word) in best[m.word][1] for m in r.matches)
        kept = {r.doc_id for r in decontaminate.clean(d, b).collect()}
        assert kept == {r.doc_id for r in rows if not r.contaminated}
    assert [r.longest_match for r in sorted(rows, key=lambda r: r.doc_id)][:3] == [13, 15, 12]


def test_words_of_equal_hashes_are_told_apart(spark, monkeypatch):
    value = decontaminate.VALUE.copy()
    value[ord("x")] = value[ord("c")]  # words that differ in these letters now collide
    monkeypatch.setattr(decontaminate, "VALUE", value)
    shard = decontaminate.Shard([b"aa bb cc dd ee", b"aa bb xx dd ee ff", b"AA bb cc dd"])
    got = shard.found(decontaminate.index([("i", b"aa bb cc dd")]))
    assert [sorted(s) for s in got.items] == [["i"], [], ["i"]] and got.words.max() == 4


def test_whole_table_against_brute_force(spark, tiny):
    got = queries()["op2_benchmark_decontamination"](spark, tiny).collect()
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{tiny}/{t}.parquet").select(c, "text").collect()] for t, c in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted(map(key, got)) == sorted(map(key, slow(docs, items)))
