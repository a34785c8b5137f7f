from __future__ import annotations

import random
from collections import Counter

import numpy as np

from recordloom.llm import suffixes


def slow(parts):
    counts = Counter(p[i : i + 200] for p in parts for i in range(len(p) - 199))
    return [[counts[p[i : i + 200]] > 1 for i in range(max(0, len(p) - 199))] for p in parts]


def cases(rng):
    for alphabet in (b"ab", b"abcdefgh \n", bytes(range(256)), b"\0\xff", b"a"):
        base = bytes(rng.choice(alphabet) for _ in range(1500))
        parts = [base]
        for _ in range(12):
            a, b = sorted(rng.randrange(len(base)) for _ in range(2))
            part = bytearray(bytes(rng.choice(alphabet) for _ in range(rng.randrange(50))) + base[a:b] + bytes(rng.choice(alphabet) for _ in range(rng.randrange(50))))
            if part and rng.random() < 0.5:
                part[rng.randrange(len(part))] = rng.choice(alphabet)
            parts.append(bytes(part))
        yield parts
    yield [b"", b"x" * 199, b"x" * 200, b"y" * 700, b"zy" * 200 + b"a", b"ba" * 150, b"\xff" * 300, b"\0" * 300]
    yield []


def test_two_stage_order_is_that_of_plain_sorting():
    rng = random.Random(10)
    for parts in cases(rng):
        raw = b"".join(parts)
        text = np.zeros((len(raw) + suffixes.PAD + 7) // 8 * 8, np.uint8)
        text[: len(raw)] = np.frombuffer(raw, np.uint8)
        wanted = np.zeros(len(text), bool)
        wanted[: len(raw)] = np.random.default_rng(1).random(len(raw)) < 0.7
        order = suffixes.two_stage(text, wanted, suffixes.words(text))
        padded = text.tobytes()
        assert sorted(order.tolist()) == np.flatnonzero(wanted).tolist()
        keys = [padded[i : i + 200] for i in order]
        assert keys == sorted(keys)
        prefixes = suffixes.common_prefixes(order, suffixes.words(text))
        for a, b, n in zip(keys, keys[1:], prefixes, strict=False):
            assert n == next((k for k in range(0, 200, 8) if a[k : k + 8] != b[k : k + 8]), 200)


def test_repeats_match_counting():
    rng = random.Random(11)
    for parts in cases(rng):
        assert [f.tolist() for f in suffixes.repeated(parts)] == slow(parts)
