"""String similarities on columns.

Arrow UDFs for what has no built-in: they see pairs that joins and windows have left. indel_native is the
same ratio as a column expression, to check them with.
"""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of bits at a time."""
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(a):
        places[c] |= 1 << i
    full = state = (1 << len(a)) - 1
    for c in b:
        match = state & places.get(c, 0)
        state = ((state + match) | (state - match)) & full
    return len(a) - state.bit_count()


def indel(a: str, b: str) -> float:
    """Shared subsequence over both lengths; 0 if either is empty."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else 2.0 * common_subsequence(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """The best Indel ratio among the shared words, and those with either side's rest."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and not (only_x and only_y):
        return 1.0
    base = " ".join(both)
    left, right = " ".join([*both, *only_x]), " ".join([*both, *only_y])
    ratios = [indel(left, right)]
    if both:
        ratios += [indel(base, left), indel(base, right)]
    return max(ratios)


def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro, raised by a common prefix of up to four characters where it is over 0.7."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, hits = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == c:
                taken[j] = True
                hits.append(c)
                break
    m = len(hits)
    if not m:
        return 0.0
    swapped = sum(x != y for x, y in zip(hits, (c for c, t in zip(b, taken, strict=True) if t), strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    if jaro > 0.7:
        prefix = 0
        for x, y in zip(a[:4], b[:4], strict=False):
            if x != y:
                break
            prefix += 1
        jaro += prefix * weight * (1 - jaro)
    return jaro


def _pairwise(function):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a.fillna(""), b.fillna(""), strict=True):
            if pair not in known:
                known[pair] = function(*pair)
            out.append(known[pair])
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(run, DoubleType())


indel_ratio, token_sort_ratio, token_set_ratio, jaro_winkler_similarity = map(_pairwise, (indel, token_sort, token_set, jaro_winkler))


def indel_native(a: Column, b: Column) -> Column:
    """The Indel ratio by dynamic programming over arrays, without Python."""
    left, right = F.split(a, ""), F.split(b, "")
    zero = F.transform(F.sequence(F.lit(0), F.size(right)), lambda _: F.lit(0))

    def row(above: Column, c: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(right)),
            F.array(F.lit(0)),
            lambda done, j: F.concat(done, F.array(F.when(F.get(right, j - 1) == c, F.get(above, j - 1) + 1).otherwise(F.greatest(F.get(above, j), F.get(done, j - 1))))),
        )

    table = F.aggregate(left, zero, row)
    return F.when((a == "") | (b == ""), 0.0).otherwise(2.0 * F.element_at(table, -1) / (F.length(a) + F.length(b)))
