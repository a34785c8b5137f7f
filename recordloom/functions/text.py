"""Normalisers of names, addresses and countries as column expressions."""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import constants as C

PLAIN = re.compile("[a-z0-9]+")
LETTERS = "0123456789abcdefghijklmnopqrstuvwxyz"
#: Characters of a word that fit in 63 bits (37**12 < 2**63), and the mark of characters that folding drops.
SHORT, GONE = 12, 255
NOT_WORD = r"[^\p{L}\p{N}_\s]+"
NOT_WORD_COMMA_HASH = r"[^\p{L}\p{N}_\s,#]+"


@functools.cache
def _folding() -> tuple[str, str]:
    """Characters whose compatibility decomposition without marks is one other character, and those; marks, which go, come last."""
    pairs, marks = [], []
    for code in range(0x80, 0x10000):
        c = chr(code)
        if unicodedata.combining(c):
            marks.append(c)
        elif not 0xAC00 <= code <= 0xD7A3 and not 0xD800 <= code <= 0xDFFF:
            base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
            if len(base) == 1 and base != c:
                pairs.append((c, base))
    return "".join(a for a, _ in pairs) + "".join(marks), "".join(b for _, b in pairs)


def strip_accents(text: Column) -> Column:
    """Accents off, inside the JVM. Characters that decompose into several (ligatures, Hangul, fractions) stay; see strip_accents_exact."""
    return F.translate(text, *_folding())


@F.pandas_udf(StringType())
def strip_accents_exact(text: pd.Series) -> pd.Series:
    """NFKD without combining marks for every character: for values that are not ASCII, best over distinct ones."""
    return text.map(lambda t: t if t is None or t.isascii() else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


@functools.cache
def _plain_table() -> dict[int, str | None]:
    source, target = _folding()
    return {ord(c): target[i] if i < len(target) else None for i, c in enumerate(source)}


def _folded(text: str) -> str:
    out = text.lower()
    return out if out.isascii() else out.translate(_plain_table()).lower()


def plain_words(text: str, most: int | None = None) -> list[str]:
    """ascii_tokens(strip_accents(lower(text))) in Python, the first ``most`` of them.

    Folding goes character by character, so the first words of a text are those of its opening, as soon as that has more.
    """
    size = len(text) if most is None else 12 * most
    while True:
        words = PLAIN.findall(_folded(text[:size]))
        if size >= len(text) or len(words) > most:
            return words[:most]
        size *= 4


@functools.cache
def first_words(most: int) -> Callable[[Column], Column]:
    """The first plain words of a text, null for null."""

    @F.pandas_udf("array<string>")
    def words(text: pd.Series) -> pd.Series:
        return text.map(lambda t: None if t is None else plain_words(t, most))

    return words


@functools.cache
def _digits() -> tuple[np.ndarray, bytes]:
    """By character up to U+FFFF, folded as in plain_words: 1 to 36 for 0-9 and a-z, 0 for what no word has, GONE for what folding drops; the same for ASCII bytes."""
    table = np.array([GONE if not (c := _folded(chr(i))) else LETTERS.find(c) + 1 for i in range(0x10000)], np.uint8)
    return table, table[:128].tobytes() + bytes(128)


def _in_digits(text: str | None) -> bytes:
    table, ascii_table = _digits()
    if not text or text.isascii():
        return (text or "").encode().translate(ascii_table)
    found = table[np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), 0xFFFF)]
    return found[found != GONE].tobytes()


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of distinct plain words of each text, their 63-bit hashes text by text).

    Words of up to SHORT characters are numbers of 63 bits to the base 37, stirred one to one, so no two of them are
    taken for one; only longer ones are hashed as strings. Words are found in all texts at once.
    """
    parts = [_in_digits(t) for t in texts]
    whole = b"\0".join([*parts, b""])
    digits = np.frombuffer(whole, np.uint8)
    inside = np.concatenate(([False], digits > 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    codes = np.zeros(len(starts), np.uint64)
    live = np.arange(len(starts))
    for i in range(SHORT):
        live = live[lengths[live] > i]
        codes[live] += digits[starts[live] + i] * np.uint64(37**i)
    mask = np.uint64((1 << 63) - 1)
    codes = (codes * np.uint64(0x9E3779B97F4A7C15)) & mask
    codes ^= codes >> np.uint64(32)
    codes = (codes * np.uint64(0xBF58476D1CE4E5B9)) & mask
    long = np.flatnonzero(lengths > SHORT)
    if len(long):
        back = b" " + LETTERS.encode() + bytes(219)
        words = [whole[s : s + n].translate(back).decode() for s, n in zip(starts[long].tolist(), lengths[long].tolist(), strict=True)]
        distinct = list(set(words))
        known = dict(zip(distinct, (pd.util.hash_array(np.array(distinct, object), categorize=False) >> np.uint64(1)).tolist(), strict=True))
        codes[long] = [known[w] for w in words]
    bounds = np.searchsorted(starts, np.cumsum([0, *(len(p) + 1 for p in parts)]))
    begins, ends = bounds[:-1], bounds[1:]
    for a, b in zip(begins.tolist(), ends.tolist(), strict=True):
        codes[a:b].sort()
    new = np.ones(len(codes), bool)
    new[1:] = codes[1:] != codes[:-1]
    new[begins[begins < ends]] = True
    before = np.concatenate(([0], np.cumsum(new)))
    return before[ends] - before[begins], codes[new].astype(np.int64)


def hashed_words(ids: DataFrame, text: str) -> DataFrame:
    """Replaces a text by h, the distinct 63-bit hashes of its plain words; null texts and those without words go."""
    others = [c for c in ids.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                counts, hashes = word_hashes(batch.column(text).to_pylist())
                out = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(hashes))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), out], names=[*others, "h"]).filter(pa.array(counts > 0))

    kinds = dict(ids.dtypes)
    return ids.select(*others, text).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in others) + ", h array<bigint>")


def present(text: Column) -> Column:
    """Null, blank and null words become empty."""
    return F.when(text.isNull() | F.lower(F.trim(text)).isin("", *C.NULL_WORDS), "").otherwise(text)


def _mapped(tokens: Column, table: dict[str, str]) -> Column:
    changes = {k: v for k, v in table.items() if k != v}
    lookup = F.create_map(*(F.lit(x) for pair in changes.items() for x in pair))
    return F.transform(tokens, lambda t: F.coalesce(F.try_element_at(lookup, t), t))


def split_words(text: Column) -> Column:
    """White-space separated tokens; none of an empty text."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def _without(tokens: Column, words: tuple[str, ...]) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*words))


def name_words(value: Column, canonical: bool = True, fold=strip_accents) -> Column:
    out = fold(F.lower(present(value)))
    for letter, other in C.NAME_LETTERS.items():
        out = F.replace(out, F.lit(letter), F.lit(other))
    tokens = split_words(F.regexp_replace(out, NOT_WORD, " "))
    return _mapped(tokens, C.LEGAL_FORMS) if canonical else tokens


def normalize_name(value: Column, core: bool = False, canonical: bool = True, fold=strip_accents) -> Column:
    """A name in lower case without accents and punctuation, legal forms folded; core: without them and joiners, unless nothing else is left."""
    tokens = name_words(value, canonical, fold)
    if core:
        kept = _without(tokens, C.CORE_STOP)
        tokens = F.when(F.size(kept) > 0, kept).otherwise(tokens)
    return F.array_join(tokens, " ")


def normalize_address(value: Column, shorten: bool = True, fold=strip_accents) -> Column:
    """An address in lower case with long words shortened; commas stand alone, once, and not at the ends."""
    out = F.regexp_replace(F.replace(F.lower(fold(present(value))), F.lit("#"), F.lit(" # ")), NOT_WORD_COMMA_HASH, " ")
    tokens = split_words(F.replace(out, F.lit(","), F.lit(" , ")))
    joined = F.array_join(_mapped(tokens, C.ADDRESS_WORDS) if shorten else tokens, " ")
    once = F.regexp_replace(joined, r"(?<!\S),(?: ,)+(?!\S)", ",")
    return F.regexp_replace(once, r"^, ?| ?,$", "")


def address_core(normalized: Column, whole_tokens: bool = False) -> Column:
    """An address without words that locate nothing. whole_tokens: of white-space tokens, so that commas stay (the store's form)."""
    tokens = split_words(normalized) if whole_tokens else ascii_tokens(normalized)
    return F.array_join(_without(tokens, C.ADDRESS_NOISE), " ")


def normalize_country(value: Column, aliases: dict[str, str] | None = None, fold=strip_accents) -> Column:
    """A country in lower case without punctuation; sentinels become empty. Any other value is kept, through aliases if given."""
    joined = F.array_join(split_words(F.regexp_replace(F.lower(fold(F.coalesce(value, F.lit("")))), NOT_WORD, " ")), " ")
    known = F.when(joined.isin(*C.MISSING_COUNTRY), "").otherwise(joined)
    if not aliases:
        return known
    lookup = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
    return F.coalesce(F.try_element_at(lookup, known), known)


def load_aliases(spark: SparkSession, path: str) -> dict[str, str]:
    """Country aliases of a JSON file of raw values, keyed by their normalised form; the file may be anywhere that Spark reads."""
    raw = json.loads("".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    if not raw:
        return {}
    keys = spark.createDataFrame(list(raw.items()), "k string, v string").select(normalize_country(F.col("k")).alias("k"), "v")
    return {r.k: r.v for r in keys.collect()}


def ascii_tokens(text: Column, least: int = 1) -> Column:
    """Runs of a-z and 0-9 of at least so many characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[a-z0-9]{{{least},}}" if least > 1 else "[a-z0-9]+"), F.lit(0))


def blocking_tokens(text: Column, drop_generic: bool = False, least: int = 2) -> Column:
    """Tokens that block in memory: runs of letters and digits of at least so many characters, without generic address words if asked."""
    tokens = F.filter(ascii_tokens(text), lambda t: F.length(t) >= least)
    return _without(tokens, C.GENERIC_ADDRESS) if drop_generic else tokens


def index_tokens(text: Column, stop: tuple[str, ...], least: int = 2) -> Column:
    """Tokens of the inverted index: white-space tokens of at least so many characters without stop words."""
    return _without(F.filter(F.split(text, " "), lambda t: F.length(t) >= least), stop)


def digit_runs(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\p{Nd}+"), F.lit(0)))


def char_ngrams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams of the characters; none of a shorter text. Characters are split once, so that a gram costs the same anywhere in a text."""

    def grams(chars: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.greatest(F.size(chars) - n, F.lit(0))), lambda i: F.concat(*(F.get(chars, i + k) for k in range(n))))

    # a one-element array carries the characters into the inner function
    held = F.transform(F.array(F.split(text, "")), grams)
    return F.when(F.length(text) >= n, F.array_distinct(F.element_at(held, 1))).otherwise(F.array().cast("array<string>"))


def word_ngrams(text: Column, least: int, most: int) -> Column:
    """n-grams inside words padded with a space on both sides, for n from least to most; a word that is no longer than n gives itself, once, and no more."""

    def windows(word: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(word) - (n - 1), F.lit(1))), lambda i: F.substring(word, i, F.lit(n)))

    def of(word: Column) -> Column:
        # the first n at which the whole word fits ends the word
        none = F.array().cast("array<string>")
        return F.concat(*(windows(word, n) if n == least else F.when(F.length(word) > n - 1, windows(word, n)).otherwise(none) for n in range(least, most + 1)))

    padded = F.transform(split_words(text), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    return F.flatten(F.transform(padded, of))


def truncated(text: Column, most: int = 512) -> Column:
    return F.substring(text, 1, most)


