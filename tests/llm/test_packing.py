from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from recordloom.llm import packing
from recordloom.llm.queries import queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(rows, docs, tokenizer, length=packing.LENGTH):
    """Every contract of the result; gives the number of sequences and of tokens."""
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for d, t in docs}
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == ids.keys()
    for d, pieces in by.items():
        pieces.sort(key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert sum(p.length for p in pieces) == len(ids[d]) and all(p.length == length for p in pieces[1:])
        at = 0
        for p in pieces:
            assert p.start == at and p.ids_crc32 == zlib.crc32(np.array(ids[d][at : at + p.length], "<u4").tobytes())
            at += p.length
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= length
    return len(sequences), sum(map(len, ids.values()))


def test_words_join_to_the_tokenizers_ids():
    encode, plain = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(4)
    texts = ["", " ", "  a", "it's 've ''s 'S", "x<|endoftext|>y", "a\x1cb \x1f c", "½ ² x² Ⅷ", "naïve déjà_vu __a1b2 ...\n\n  \t end  ", "日本語 中文 ١٢٣ é 🙂🙂", "   x\u0085y"]
    texts += ["".join(rng.choice("ab 1.'s\n\t_é²日½ ") for _ in range(rng.randint(1, 60))) for _ in range(400)]
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(encode(t), "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids


def test_very_long_whitespace_runs(spark):
    plain = Tokenizer.from_file(PATH)
    docs = [(1, " " * 2_000_000), (2, "a" + "\n" * 1_500_000 + "b"), (3, " " * packing.RUN + "x"), (4, "short text")]
    whole(packing.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect(), docs, plain)
    assert not packing.runs_long(docs[2][1]) and packing.runs_long(docs[1][1])


def test_the_fullest_closes_first():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 2, 9, 8)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0)]
    assert bins.left() == {0: 8, 3: 8}  # 2 was the fullest when 8 came
    assert bins.place(1) == (3, 8) and bins.place(10) == (4, 0) and bins.left() == {0: 8}  # now 3 was


def test_odd_rows(spark):
    long = "word " * 30000
    docs = [(1, None), (2, ""), (3, long), (4, "short text"), (5, "x" * 300), (None, "no id")]
    df = spark.createDataFrame([(d, t, 3, "s") for d, t in docs], "doc_id long, text string, piece int, bin string")
    rows = packing.pack(df, PATH).collect()
    whole(rows, docs, Tokenizer.from_file(PATH))
    assert packing.pack(df.limit(0), PATH).count() == 0
    assert packing.pack(df.unionAll(df), PATH).count() == 2 * len(rows)


def test_whole_table_packs_tightly(spark, tiny):
    rows = queries()["op4_best_fit_packing"](spark, tiny).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    sequences, tokens = whole(rows, docs, Tokenizer.from_file(PATH))
    assert sequences <= 1.01 * tokens / packing.LENGTH + 1
