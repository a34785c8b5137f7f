"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are lexicon entries and patterns. Each votes for its own class, toxic or clean, or abstains. The
label model estimates from the votes alone, by EM, how often each voter votes on either class and how
voters depend on each other beyond the class, pair by pair; its posterior lets dependent voters share
their weight. A logistic classifier over how often each voter fires is then trained on the posteriors.
Given labels choose the entries that vote and tell which voters to distrust; they are no votes.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, remainder
from .labelled import FIT_ROWS, labelled_texts

THRESHOLD = 0.7
#: Entries mined from labelled texts: word starts of these lengths and whole words, of this precision, which chance gives with this probability.
STEMS, CHANCE, LEAST_PRECISION = (4, 5, 6, 8), 1e-5, 0.75
#: Shrinkage of the voters' correlations towards none.
SHRINK = 0.1
WORD = re.compile(r"[^\W\d_]+")
#: Insults that a general lexicon lists.
LEXICON = (
    "idiot idiots stupid moron morons loser losers pathetic worthless scum trash clown disgusting dumb ugly "
    "hate shut imbecile filthy vermin garbage jerk fool bastard dirtbag creep kill die"
).split()
#: Patterns over whole texts, beside the lexicon.
PATTERNS = {
    "masked": re.compile(r"\b[^\W\d_]+[*@$#]{2,}[^\W\d_]+\b"),
    "address": re.compile(r"\b(?:you|your|u)\b(?: \w+){0,3} (?:are|is|all)\b", re.I),
    "shouting": re.compile(r"(?:\b[A-Z]{3,}\b\W{1,3}){6}"),
    "marks": re.compile(r"[!?]{3,}"),
}


def entries(text: str) -> Counter[str]:
    """How often each word and word start occurs; ``start*`` marks a start of a longer word."""
    out: Counter[str] = Counter()
    for word, n in Counter(WORD.findall(text.lower())).items():
        out[word] += n
        for k in STEMS:
            if len(word) > k:
                out[word[:k] + "*"] += n
    return out


#: Entries in a text that are a vote by their number; a single one may be chance.
DENSE = (2, 4, 6)
#: Voters for the other class: fewer entries than that, no pattern, and entries in two words of a hundred at most. Short texts vote too.
CLEAN = ("silent", "calm", "sparse")


@dataclass
class Voters:
    """Lexicon entries by number, then patterns, then three that tell how many words were entries, then those of CLEAN."""

    lexicon: list[str]

    def __post_init__(self) -> None:
        self.number = {e: i for i, e in enumerate(self.lexicon)}
        self.words = {e for e in self.lexicon if e[-1] != "*"}
        self.stems = {k: {e[:-1] for e in self.lexicon if e[-1] == "*" and len(e) == k + 1} for k in STEMS}

    def __len__(self) -> int:
        return len(self.lexicon) + len(PATTERNS) + 3 + len(CLEAN)

    def polarity(self) -> np.ndarray:
        """The class that each votes for: 1 toxic, -1 clean."""
        out = np.ones(len(self))
        out[-len(CLEAN) :] = -1
        return out

    def votes(self, text: str) -> list[tuple[int, float]]:
        """(voter, how often it fires) of those that fire."""
        found: Counter[int] = Counter()
        fired = total = 0
        for word, n in Counter(WORD.findall(text.lower())).items():
            hit = False
            total += n
            if word in self.words:
                found[self.number[word]] += n
                hit = True
            for k, stems in self.stems.items():
                if word[:k] in stems and len(word) > k:
                    found[self.number[word[:k] + "*"]] += n
                    hit = True
            fired += n * hit
        out = list(found.items())
        first = len(self.lexicon)
        patterns = [(first + i, 1.0) for i, p in enumerate(PATTERNS.values()) if p.search(text)]
        first += len(PATTERNS)
        dense = [(first + i, 1.0) for i, least in enumerate(DENSE) if fired >= least]
        first += 3
        clean = (fired < DENSE[0], not patterns, 50 * fired <= total)
        return out + patterns + dense + [(first + i, 1.0) for i, vote in enumerate(clean) if vote]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for e in entries(text or ""):
                counts.setdefault(e, [0, 0])[label > 0] += 1
        kept = list(counts.items())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.string()), pa.array([v[0] for _, v in kept], pa.int64()), pa.array([v[1] for _, v in kept], pa.int64())], names=["entry", "clean", "toxic"])


def chosen(sample: DataFrame) -> list[str]:
    """Entries that vote, from the labelled texts' counts of every entry.

    Mined are those of LEAST_PRECISION that toxic texts hold more often than CHANCE allows. An entry whose start votes is left out: it fires on no other text. Of the fixed LEXICON
    those go that mostly stand in clean texts.
    """
    counts = map_texts(sample, _terms, "entry string, clean long, toxic long").groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    size = sample.agg(F.count("*").alias("n"), F.sum((F.col("label") > 0).cast("int")).alias("toxic")).first()
    share = min(max(((size.toxic or 0) + 1) / (size.n + 2), 1e-3), 0.5)
    precise = F.col("toxic") >= LEAST_PRECISION * (F.col("clean") + F.col("toxic"))
    rows = counts.where(((F.col("toxic") * math.log(share) <= math.log(CHANCE)) & precise) | F.col("entry").isin(*LEXICON)).collect()
    distrusted = {r.entry for r in rows if r.entry in LEXICON and r.clean > r.toxic}
    entries_ = ({r.entry for r in rows} | set(LEXICON)) - distrusted
    covered = lambda e: any(e[:k] + "*" in entries_ and len(e.rstrip("*")) > k for k in STEMS if e[:k] + "*" != e)
    return sorted(e for e in entries_ if not covered(e))


@dataclass
class LabelModel:
    """How often each voter fires on either class, and by what weight it counts beside those it depends on."""

    prior: float
    fires: np.ndarray  # (2, voters)
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on, off = np.log(self.fires[1] / self.fires[0]), np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        logit = np.log(self.prior / (1 - self.prior)) + votes @ (self.weight * (on - off)) + (self.weight * off).sum()
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def dependence(votes: np.ndarray, q: np.ndarray, fires: np.ndarray) -> np.ndarray:
    """Correlation of every pair of voters, of either sign, within the classes: their covariances, pooled."""
    cov = np.zeros((votes.shape[1],) * 2)
    for mass, mean in ((1 - q, fires[0]), (q, fires[1])):
        rest = votes - mean
        cov += (rest * mass[:, None]).T @ rest / len(votes)
    deviation = np.sqrt(np.diag(cov)) + 1e-6
    correlation = cov / np.outer(deviation, deviation)
    np.fill_diagonal(correlation, 1)
    return correlation


def label_model(votes: np.ndarray, polarity: np.ndarray, rounds: int = 40) -> LabelModel:
    """EM over votes (0 or 1) without any label.

    It starts from each voter's own class, which also names the classes. Weights are those by which evidence
    of equal strength with the pairs' correlations adds up: copies share one vote, and what one voter excludes
    in another makes up for what it shares with a third, up to a whole vote.
    """
    lead = votes @ np.where(polarity > 0, 1.5, -1.5) - 1.5  # silence is no sign of toxicity
    q = 1 / (1 + np.exp(-np.clip(lead, -6, 6)))
    model = None
    weight = np.ones(votes.shape[1])
    for k in range(rounds):
        mass = np.stack([1 - q, q])
        # what a voter is taken to do before it is seen: to vote for its class rather than the other
        seen = np.where(polarity > 0, np.array([[0.02], [0.2]]), np.array([[0.5], [0.1]]))
        fires = (mass @ votes + seen) / (mass.sum(axis=1, keepdims=True) + 1)
        if k % 8 == 0:
            c = (1 - SHRINK) * dependence(votes, q, fires) + SHRINK * np.eye(len(weight))
            weight = np.clip(np.linalg.solve(c, np.ones(len(weight))), 0.02, 1)
        model = LabelModel(float(np.clip(q.mean(), 1e-3, 1 - 1e-3)), np.clip(fires, 1e-5, 1 - 1e-5), weight)
        new = model.posterior(votes)
        if k % 8 != 7 and np.abs(new - q).max() < 1e-4:
            break
        q = new
    if ((model.fires[1] - model.fires[0]) * polarity).sum() < 0:  # the classes changed places
        model = LabelModel(1 - model.prior, model.fires[::-1], model.weight)
    return model


def classifier(x: np.ndarray, q: np.ndarray, ridge: float = 3e-5, rounds: int = 30) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression on soft labels, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge * len(x))
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (p - q) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    voters: Voters
    weights: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        logit = np.full(len(texts), self.weights[-1])
        for i, t in enumerate(texts):
            for v, n in self.voters.votes(t or ""):
                logit[i] += self.weights[v] * np.log2(1 + n)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def learnt(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | float:
    """Fit on up to ``rows`` labelled documents whose id's crc32 leaves a remainder other than 1 by 3."""
    sample = labelled_texts(docs, labels, "toxic", remainder(F.col("doc_id"), 3) != 1, rows)
    voters = Voters(chosen(sample))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cast = [voters.votes(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[v for v, _ in c] for c in cast], pa.list_(pa.int32())), pa.array([[float(n) for _, n in c] for c in cast], pa.list_(pa.float64()))], names=["label", "voter", "n"])

    got = map_texts(sample, vote, "label int, voter array<int>, n array<double>").toArrow()
    y = (got.column("label").to_numpy() > 0).astype(np.float64)
    if min((y == 0).sum(), (y == 1).sum()) < 2:
        return float((y.sum() + 0.5) / (len(y) + 1))
    x = np.zeros((len(y), len(voters)), np.float32)
    for i, (v, n) in enumerate(zip(got.column("voter").to_pylist(), got.column("n").to_pylist(), strict=True)):
        x[i, v] = n
    votes = (x > 0).astype(np.float32)
    return Model(voters, classifier(np.log2(1 + x), label_model(votes, voters.polarity()).posterior(votes)))


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs, from its whole text alone.

    Null and empty texts get the score of a text on which the clean voters alone fire; long texts are read whole; null ids
    are scored, held out by the empty text's remainder; repeated rows and equal texts give equal results. With
    fewer than two labels of either class, the score is the share of label 1 (one half without any). An empty
    table gives no rows; other columns are not looked at.
    """
    model = learnt(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.full(batch.num_rows, model) if isinstance(model, float) else model.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["id", "score"])

    scored = map_texts(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), run, "id long, score double")
    return scored.select(F.col("id").alias("doc_id"), (remainder(F.col("id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
