"""Quality by a regularised quadratic discriminant over transformed document statistics.

Each class has a Gaussian whose covariance is shrunk towards the pooled one and its diagonal. A score
is the difference of the two log densities, from Mahalanobis distances by Cholesky factors that are
computed once, put on a probability scale by a logistic fit on folds that the Gaussians did not see.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, map_texts, remainder, utf8
from .labelled import FIT_ROWS, labelled_texts

FOLDS, THRESHOLD = 5, 0.3
#: Shrinkage towards (pooled covariance, its diagonal), of which the fit takes the best.
GRID = [(a, b) for a in (0.05, 0.2, 0.5) for b in (0.02, 0.1, 0.3)]
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#$%&*@^~<>{}[]\\/_=+")] = True
CLASSES = np.zeros((256, 8), np.int64)
for _c in range(256):
    CLASSES[_c] = [
        65 <= _c <= 90,
        97 <= _c <= 122,
        48 <= _c <= 57,
        _c in b" \t\n\r\x0b\x0c",
        _c == 33 or _c == 63,
        SYMBOLS[_c],
        _c == 124,
        _c in b".,;:",
    ]
N_STATISTICS = 20


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a whole text: log counts and log odds of shares. An empty text has those of nothing."""
    raw = text or b""
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digits, spaces, shouts, symbols, bars, stops = (float(x) for x in histogram @ CLASSES)
    words = raw.split()
    n, size = len(words), len(raw)
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = histogram[histogram > 0] / max(size, 1)

    def odds(part: float, of: float) -> float:
        p = min(max(part / max(of, 1.0), 0.0), 1.0)
        return float(np.log((p + 0.002) / (1.002 - p)))

    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        odds(upper, upper + lower),
        odds(digits, size),
        odds(spaces, size),
        odds(shouts, n),
        odds(symbols, n),
        odds(bars, n),
        odds(stops, n),
        odds(len(counts), n),
        odds(max(counts.values(), default=0), n),
        odds(sum(map(operator.eq, words, words[1:])), n),
        odds(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(n / max(len(lines), 1))),
        odds(sum(map(bytes.istitle, words)), n),
        odds(sum(map(bytes.isalpha, words)), n),
        odds(sum(w[-1] in b"#$%&*@^~!?" for w in words), n),
        float(-(share * np.log(share)).sum()),
    ]


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and constants of both classes, and the logistic scale."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]
    slope: float = 1.0
    shift: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        log = [c - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return np.clip(log[1] - log[0], -200, 200)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.shift, -30, 30)))


def _gaussians(x: np.ndarray, y: np.ndarray, shrink: tuple[float, float]) -> Discriminant:
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - centre) / scale, -8, 8)
    parts = [z[y == k] for k in (0, 1)]
    own = [np.cov(p, rowvar=False, bias=True) if len(p) > 1 else np.zeros((z.shape[1],) * 2) for p in parts]
    pooled = sum(len(p) * s for p, s in zip(parts, own, strict=True)) / len(z)
    a, b = shrink
    means, factors, constants = [], [], []
    for p, s in zip(parts, own, strict=True):
        cov = (1 - a - b) * s + a * pooled + b * np.diag(np.diag(pooled)) + 1e-3 * np.eye(len(pooled))
        low = np.linalg.cholesky(cov)
        means.append(p.mean(axis=0))
        factors.append(np.linalg.inv(low))
        constants.append(float(np.log(len(p) / len(z)) - np.log(np.diag(low)).sum()))
    return Discriminant(centre, scale, means, factors, constants)


def logistic(d: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic fit on one variable, lightly regularised."""
    x, w = np.stack([d, np.ones_like(d)], axis=1), np.array([0.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(2) * 1e-3
        step = np.linalg.solve(h, x.T @ (p - y) + 1e-3 * w)
        w = w - np.clip(step, -1, 1)
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(x: np.ndarray, y: np.ndarray) -> Discriminant | float:
    """The discriminant with the shrinkage of the least held-out log loss; without two rows of both classes, the share of label 1."""
    if min((y == 0).sum(), (y == 1).sum()) < max(2, FOLDS):
        return float((y.sum() + 0.5) / (len(y) + 1))
    order = np.lexsort((x[:, 1], x[:, 0], y))  # the same folds whatever the order of rows
    x, y = x[order], y[order]
    fold = np.arange(len(y)) % FOLDS
    best = None
    for shrink in GRID:
        d = np.zeros(len(y))
        for k in range(FOLDS):
            d[fold == k] = _gaussians(x[fold != k], y[fold != k], shrink).difference(x[fold == k])
        slope, shift = logistic(d, y)
        p = np.clip(1 / (1 + np.exp(-np.clip(slope * d + shift, -30, 30))), 1e-9, 1 - 1e-9)
        loss = float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())
        if best is None or loss < best[0] - 1e-9:
            best = (loss, shrink, slope, shift)
    model = _gaussians(x, y, best[1])
    model.slope, model.shift = best[2], best[3]
    return model


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t) for t in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["label", "x"])


def learnt(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Discriminant | float:
    """Fit on up to ``rows`` labelled documents whose id's crc32 leaves a remainder other than 0 by 5."""
    sample = labelled_texts(docs, labels, "quality", remainder(F.col("doc_id"), 5) != 0, rows)
    got = map_texts(sample, _measure, "label int, x array<double>").toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, N_STATISTICS)
    return fit(x, (got.column("label").to_numpy() > 0).astype(np.int64))


def _scores(model: Discriminant | float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in utf8(batch.column(1))], np.float64).reshape(-1, N_STATISTICS)
            found = np.full(len(x), model) if isinstance(model, float) else model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["id", "score"])

    return score


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs, from its whole text alone.

    Null and empty texts get the score of an empty text; long texts are measured whole; null ids are scored
    and not held out unless the empty text's remainder is 0; repeated rows and equal texts give equal results.
    With fewer than five labels of either class the score is the share of label 1 (one half without any). An
    empty table gives no rows; other columns are not looked at.
    """
    model = learnt(docs, labels, rows)
    scored = map_texts(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), _scores(model), "id long, score double")
    return scored.select(F.col("id").alias("doc_id"), (remainder(F.col("id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows of docs whose text the classifier does not reject, with all their columns; a map over docs, without a shuffle.

    Scores are those of score(), so nulls, empty and long texts, repeated rows, few labels and empty tables are
    as there: rows that share a text stay or go together.
    """
    model = learnt(docs, labels, rows)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .common import slices

        for batch in slices(batches, at):
            x = np.array([statistics(t) for t in utf8(batch.column(at))], np.float64).reshape(-1, N_STATISTICS)
            found = np.full(len(x), model) if isinstance(model, float) else model.score(x)
            yield batch.filter(pa.array(found >= THRESHOLD))

    return docs.mapInArrow(lean(keep), docs.schema)
