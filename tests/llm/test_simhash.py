from __future__ import annotations

import random

import numpy as np
import xxhash

from recordloom.llm import simhash


def slow_fingerprint(text):
    words = []
    for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in range(9, 14)}).split(" "):
        if w:
            words.append(w)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    label = list(range(len(fps)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
                a, b = top(i), top(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(fps):
        least[top(i)] = min(d, least.get(top(i), d))
    return {d: least[top(i)] for i, (d, _) in enumerate(fps)}


def test_fingerprint_matches_plain_counting():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "One", "one two", "A\x0bb C d\x1ce", "é É\xa0ü x", "ja " * 600]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 900))) for _ in range(30)]
    for t in texts:
        assert simhash.fingerprint(None if t is None else t.encode()) == slow_fingerprint(t)


def test_bit_slices_count_distances():
    rng = np.random.default_rng(2)
    lanes = rng.integers(0, 1 << 63, 192, dtype=np.uint64)
    probes = np.concatenate([lanes[:40], lanes[40:80] ^ np.uint64(5), lanes[80:90] ^ np.uint64(7), rng.integers(0, 1 << 63, 9, dtype=np.uint64)])
    for radius in (0, 1, 2, 3, 6):
        hit = simhash.near(probes, lanes.reshape(-1, 64), radius)
        for i, p in enumerate(probes):
            for j, x in enumerate(lanes):
                assert bool(hit[i, j // 64] >> np.uint64(j % 64) & np.uint64(1)) == ((int(p) ^ int(x)).bit_count() <= radius)


def test_links_reach_what_brute_force_reaches(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = set(centres)
    while len(fps) < 900:
        f = rng.choice(centres[:3])
        for _ in range(rng.randint(0, 6)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    rows = [(i, f) for i, f in enumerate(sorted(fps))]
    want = slow_components(rows)
    signed = [(f - (1 << 64) if f >> 63 else f,) for _, f in rows]
    for block in (1024, 16):
        edges = simhash.links(spark.createDataFrame(signed, "fp long"), block=block)
        got = {r.node: r.root for r in simhash.components(edges).collect()}
        groups = {}
        for (i, _), (s,) in zip(rows, signed, strict=True):
            groups.setdefault(got.get(s, s), set()).add(i)
        expected = {}
        for i, c in want.items():
            expected.setdefault(c, set()).add(i)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_odd_rows(spark):
    long = "ab cd ef " * 40000
    rows = [(5, None), (9, ""), (3, "Same words here now"), (3, "Same words here now"), (2, "same  WORDS\there now"), (None, "same words here now"), (None, "alone in the world"), (7, long), (8, long + "x")]
    df = spark.createDataFrame([(i, t, "e", 1) for i, t in rows], "doc_id long, text string, fp string, component_id int")
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "fingerprint", "component_id"}
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.component_id)
    assert by[5] == by[9] == {5} and by[2] == by[3] == {2} and by[None] == {2, None} and by[8] == by[7]
    assert {r.fingerprint for r in got if r.doc_id in (5, 9)} == {"0" * 16}
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "5", "7", "None", "None"]


def test_whole_table_against_brute_force(spark, tiny):
    from recordloom.llm.queries import queries

    got = queries()["op7_simhash_near_dedup"](spark, tiny).collect()
    docs = spark.read.parquet(f"{tiny}/documents.parquet").collect()
    want = slow_components([(d.doc_id, slow_fingerprint(d.text)) for d in docs])
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.fingerprint for r in got} == {d.doc_id: f"{slow_fingerprint(d.text):016x}" for d in docs}
