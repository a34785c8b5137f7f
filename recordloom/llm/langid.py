"""Language identification of mixed text: scripts narrow the candidates, Viterbi labels the spans.

A word's score for a language is a naive Bayes log likelihood of its character n-grams and of itself,
hashed into buckets. The script of its letters leaves only the languages that were seen in that
script. Over a text's words, Viterbi finds the labels of the highest total when every change of
language costs a penalty; a text's language is the one whose spans hold the most letters.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, remainder

#: Most documents the model is fitted on (those with the least hashes of their ids); buckets; cost of a switch; words a worker remembers.
FIT_DOCS, BUCKETS, SWITCH, CACHE = 8_000, 1 << 17, 6.0, 600_000
#: A language counts as written in a script that holds this share of its letters.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
#: First code points of ranges, and their scripts.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"),
    (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"),
    (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB13, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"),
)
STARTS, NAMES = [s for s, _ in SCRIPTS], [n for _, n in SCRIPTS]


def script(word: str) -> str:
    """The script of a word's first letter beyond ASCII, or Latin."""
    if word.isascii():
        return "latin"
    return next((s for c in word if (s := NAMES[bisect_right(STARTS, ord(c)) - 1]) != "latin"), "latin")


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word number) of every 2- to 4-gram of each word between boundaries, and of the word itself."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    of = np.cumsum(codes == 2) - 1
    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    buckets, owner = [], []
    rolled = mixed
    for n in (2, 3, 4):
        rolled = rolled[: len(codes) - n + 1] * np.uint64(0xBF58476D1CE4E5B9) + mixed[n - 1 :]
        inside = of[: len(codes) - n + 1] == of[n - 1 :]
        buckets.append(rolled[inside] + np.uint64(n))
        owner.append(of[: len(codes) - n + 1][inside])
    starts = np.flatnonzero(codes == 2)
    whole = np.add.reduceat(mixed * (np.arange(len(codes), dtype=np.uint64) - starts[of].astype(np.uint64) + np.uint64(1)) ** np.uint64(3), starts)
    buckets.append(whole * np.uint64(0x94D049BB133111EB) + np.uint64(7))
    owner.append(np.arange(len(words)))
    found = np.concatenate(buckets)
    found ^= found >> np.uint64(32)
    found = found * np.uint64(0xD6E8FEB86659FD93)
    return (found >> np.uint64(40)).astype(np.int64) % BUCKETS, np.concatenate(owner)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: bucket counts of each language; buckets below zero count letters by script."""
    for batch in batches:
        by: dict[str, Counter[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by.setdefault(lang, Counter()).update(WORD.findall((text or "").lower()))
        for lang, words in by.items():
            kept = list(words)
            n = np.fromiter(words.values(), np.float64, len(kept))
            at, of = grams(kept)
            total = np.bincount(at, n[of] if len(kept) else None, BUCKETS) if len(kept) else np.zeros(BUCKETS)
            bucket = np.flatnonzero(total)
            letters: Counter[int] = Counter()
            for w, k in words.items():
                letters[-1 - NAMES.index(script(w))] += k * len(w)
            bucket, total = np.concatenate([bucket, [*letters]]).astype(np.int64), np.concatenate([total[bucket], [*letters.values()]])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(bucket), pa.string()), pa.array(bucket), pa.array(total, pa.float64())], names=["lang", "bucket", "n"])


@dataclass
class Model:
    """Log likelihoods (buckets, languages) and the languages of each script."""

    langs: list[str]
    table: np.ndarray
    scripts: dict[str, np.ndarray]
    words: dict[str, int] = field(default_factory=dict)
    scores: np.ndarray | None = None
    letters: np.ndarray | None = None

    def learn(self, missing: list[str]) -> None:
        """Remember the scores of words not met before."""
        if self.scores is None or len(self.words) + len(missing) > CACHE:
            self.words, self.scores, self.letters = {}, np.zeros((1 << 12, len(self.langs)), np.float32), np.zeros(1 << 12, np.int32)
        at, of = grams(missing)
        sums = np.stack([np.bincount(of, self.table[at, k], len(missing)) for k in range(len(self.langs))], axis=1)
        sums /= np.sqrt(np.maximum(np.bincount(of, minlength=len(missing)), 1))[:, None]  # neighbouring n-grams repeat each other
        sums -= sums.max(axis=1, keepdims=True)
        np.maximum(sums, -20, out=sums)
        for i, w in enumerate(missing):
            if not w.isascii() or len(self.scripts["latin"]) < len(self.langs):
                allowed = self.scripts.get(script(w))
                if allowed is None or not len(allowed):
                    sums[i] = 0  # a script of no learnt language tells nothing
                elif len(allowed) < len(self.langs):
                    barred = np.ones(len(self.langs), bool)
                    barred[allowed] = False
                    sums[i] -= sums[i][allowed].max()
                    sums[i][barred] = -20
        first = len(self.words)
        while first + len(missing) > len(self.scores):
            self.scores, self.letters = (np.concatenate([x, np.zeros_like(x)]) for x in (self.scores, self.letters))
        self.scores[first : first + len(missing)] = sums
        self.letters[first : first + len(missing)] = [len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in missing]
        self.words.update(zip(missing, range(first, first + len(missing)), strict=True))

    def paths(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text: the language numbers of its words and the letters of each."""
        found = [WORD.findall((t or "").lower()) for t in texts]
        while True:
            known, missing = self.words, {}
            for ws in found:
                for w in ws:
                    if w not in known:
                        missing[w] = None
            if not missing:
                break
            if len(known) + len(missing) > CACHE and known:
                self.scores = None  # all words of these texts anew
                self.words = {}
                missing = dict.fromkeys(w for ws in found for w in ws)
            self.learn(list(missing))
        index = [np.fromiter(map(self.words.__getitem__, ws), np.int64, len(ws)) for ws in found]
        order = sorted(range(len(texts)), key=lambda i: -len(index[i]))
        labels = viterbi([index[i] for i in order], self.scores) if self.scores is not None else [np.zeros(0, np.int64) for _ in order]
        out: list = [None] * len(texts)
        for i, path in zip(order, labels, strict=True):
            out[i] = (path, self.letters[index[i]] if len(index[i]) else np.zeros(0, np.int64))
        return out


def viterbi(index: list[np.ndarray], scores: np.ndarray, penalty: float = SWITCH) -> list[np.ndarray]:
    """Best labels of several sequences, longest first: word by word, all sequences at once."""
    sizes = np.array([len(x) for x in index], np.int64)
    if not len(sizes) or not sizes[0]:
        return [np.zeros(0, np.int64) for _ in index]
    flat, starts = np.concatenate(index), np.cumsum(sizes) - sizes
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")  # sequences longer than t
    value = scores[flat[starts[: active[0]]]].astype(np.float64)
    switched, source = [None], [None]
    for t in range(1, sizes[0]):
        before = value[: active[t]]
        best = before.argmax(axis=1)
        top = before[np.arange(len(best)), best][:, None] - penalty
        change = before < top
        value[: active[t]] = np.where(change, top, before) + scores[flat[starts[: active[t]] + t]]
        switched.append(change)
        source.append(best.astype(np.int16))
    path = np.zeros(len(flat), np.int64)
    state = value.argmax(axis=1)  # every row holds the values of its own last word
    for t in range(sizes[0] - 1, -1, -1):
        n = active[t]
        path[starts[:n] + t] = state[:n]
        if t:
            rows = np.arange(n)
            state[:n] = np.where(switched[t][rows, state[:n]], source[t], state[:n])
    return [path[s : s + n] for s, n in zip(starts, sizes, strict=True)]


def learnt(docs: DataFrame, docs_limit: int = FIT_DOCS) -> Model | None:
    """Fit on up to docs_limit documents with a language whose id's crc32 leaves a remainder other than 0 by 5; None if there are none."""
    chosen = docs.where((remainder(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    ids = chosen.select(F.col("doc_id").alias("__id")).distinct().orderBy(F.xxhash64("__id"), "__id").limit(docs_limit)
    sample = chosen.join(F.broadcast(ids), F.col("doc_id") == F.col("__id")).select("lang", "text")
    got = map_texts(sample, _counts, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    if not langs:
        return None
    number = {v: k for k, v in enumerate(langs)}
    counts, scripts = np.zeros((BUCKETS, len(langs))), {}
    col = got["lang"].map(number).to_numpy()
    bucket, n = got["bucket"].to_numpy(), got["n"].to_numpy()
    counts[bucket[bucket >= 0], col[bucket >= 0]] = n[bucket >= 0]
    letters = np.zeros((len(NAMES), len(langs)))
    np.add.at(letters, (-1 - bucket[bucket < 0], col[bucket < 0]), n[bucket < 0])
    share = letters / np.maximum(letters.sum(axis=0), 1)
    for name in set(NAMES):
        scripts[name] = np.flatnonzero(share[[i for i, x in enumerate(NAMES) if x == name]].sum(axis=0) >= SCRIPT_SHARE)
    table = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS))
    return Model(langs, table.astype(np.float32), scripts)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(id, lang_pred, score, spans) of every row of docs (id, text).

    spans: maximal runs of words of one language, as (lang, first word, words). score: the share of the
    letters that lie in spans of lang_pred; 0 for ``und``, which null texts and texts without a letter get,
    and all texts if nothing was learnt. Ties go to the language that sorts first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, spans = [], [], []
            texts = batch.column(1).to_pylist()
            for path, letters in model.paths(texts) if model else [(np.zeros(0, np.int64),) * 2] * len(texts):
                held = np.bincount(path, letters, len(model.langs)) if len(path) else np.zeros(1)
                if held.sum() <= 0:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    spans.append([])
                    continue
                best = int(held.argmax())
                langs.append(model.langs[best])
                scores.append(float(held[best] / held.sum()))
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
                spans.append([{"lang": model.langs[path[a]], "first": int(a), "words": int(b - a)} for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
            kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=["id", "lang_pred", "score", "spans"])

    return map_texts(docs, run, "id long, lang_pred string, score double, spans array<struct<lang string, first int, words int>>")


def predict(docs: DataFrame, docs_limit: int = FIT_DOCS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of docs, from its whole text; learnt from docs themselves.

    Rows with a null id or language are predicted but not learnt from; null texts and texts without a letter
    are ``und`` with score 0, as are all if nothing was learnt; long texts are read whole; ties go to the
    language that sorts first; repeated rows give repeated results; an empty table gives no rows; columns
    other than doc_id, text and lang are not looked at.
    """
    told = identify(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), learnt(docs.select("doc_id", "text", "lang"), docs_limit))
    return told.select(F.col("id").alias("doc_id"), (remainder(F.col("id"), 5) == 0).alias("held_out"), "lang_pred", "score")
