"""Term statistics: document frequencies, inverse document frequencies of both generations, norms, TF-IDF."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_words, word_ngrams


def postings(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, term, tf, at): how often a row holds a term, and its first place."""
    each = df.select(key, F.posexplode(tokens).alias("at", "term"))
    return each.groupBy(key, "term").agg(F.count("*").alias("tf"), F.min("at").alias("at"))


def document_frequency(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(term, df). Tokens are made distinct in the row, so partial sums are all that is shuffled."""
    return df.select(F.explode(F.array_distinct(tokens)).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def idf_legacy(frequency: DataFrame, rows: Column, most: float = 0.7, least: int = 1) -> DataFrame:
    """(term, df, idf): ln((1 + N) / (1 + df)) + 1 for terms in least .. most * N rows, or of all terms if that leaves none."""
    kept = frequency.withColumn("inside", (F.col("df") >= least) & (F.col("df") <= most * rows))
    some = kept.agg(F.max(F.col("inside").cast("int")).alias("some"))
    kept = kept.crossJoin(F.broadcast(some)).where(F.col("inside") | (F.coalesce(F.col("some"), F.lit(0)) == 0))
    return kept.select("term", "df", (F.log((1 + rows) / (1 + F.col("df"))) + 1).alias("idf"))


def idf_scale(frequency: DataFrame, rows: Column, least: int = 2, most: int = 5000) -> DataFrame:
    """(term, df, idf): ln(1 + N / df) for terms in least .. most rows; others are not indexed."""
    return frequency.where((F.col("df") >= least) & (F.col("df") <= most)).select("term", "df", F.log(1 + rows / F.col("df")).alias("idf"))


def idf_smooth(frequency: DataFrame, rows: Column, most: float) -> DataFrame:
    """(term, df, idf): ln((1 + N) / (1 + df)) + 1 for terms in at most ``most`` * N rows."""
    return frequency.where(F.col("df") <= most * rows).select("term", "df", (F.log((1 + rows) / (1 + F.col("df"))) + 1).alias("idf"))


def weighted(terms: DataFrame, idf: DataFrame, key: str, sublinear: bool = False) -> DataFrame:
    """(key, term, w): tf-idf of unit length over the terms that have an idf."""
    tf = 1 + F.log("tf") if sublinear else F.col("tf")
    raw = terms.join(idf, "term").select(key, "term", (tf * F.col("idf")).alias("raw"))
    norm = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norm, key).select(key, "term", (F.col("raw") / F.when(F.col("norm") == 0, 1.0).otherwise(F.col("norm"))).alias("w"))


def char_tfidf(fit: DataFrame, key: str, text: Column, least: int = 2, most: int = 5, max_df: float = 0.995) -> tuple[DataFrame, DataFrame]:
    """(idf, unit vectors of fit's rows) of n-grams in words: sublinear term frequency, smooth idf, terms in more than max_df of the rows left out."""
    terms = postings(fit, key, word_ngrams(text, least, most))
    rows = fit.agg(F.count("*").alias("n_rows"))
    frequency = terms.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(rows))
    idf = idf_smooth(frequency, F.col("n_rows"), max_df)
    return idf, weighted(terms, idf, key, sublinear=True)


def word_grams(sides: dict[str, DataFrame], fit: str, text: str, least: int = 2, most: int = 5, max_df: float = 0.995) -> DataFrame:
    """(word, grams, times, idfs): the n-grams of every distinct word of the sides, by a 64-bit hash, how often the word holds each, and what char_tfidf weighs it by, fitted on the side ``fit``.

    Words are far fewer than the rows that hold them, so it is words, not the n-grams of rows, that meet idfs.
    """
    grams = word_ngrams(F.col(text), least, most)
    rows = sides[fit].agg(F.count("*").alias("n_rows"))
    idf = idf_smooth(document_frequency(sides[fit], fit, grams).crossJoin(F.broadcast(rows)), F.col("n_rows"), max_df)
    words = None
    for df in sides.values():
        part = df.select(F.explode(F.array_distinct(split_words(F.col(text)))).alias("word"))
        words = part if words is None else words.unionByName(part)
    each = words.distinct().select("word", F.explode(word_ngrams(F.col("word"), least, most)).alias("term")).groupBy("word", "term").agg(F.count("*").cast("int").alias("times"))
    held = each.join(idf, "term").groupBy("word").agg(F.collect_list(F.struct(F.xxhash64("term").alias("gram"), "times", "idf")).alias("v"))
    return held.select("word", F.col("v.gram").alias("grams"), F.col("v.times").alias("times"), F.col("v.idf").alias("idfs"))


def gram_vectors(df: DataFrame, key: str, text: str, words: DataFrame) -> DataFrame:
    """(key, terms, ws): the unit vector of char_tfidf in one row for each row of df, from the kept table of word_grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                held = batch.column("v")
                n, grams, times, idfs = held.flatten().flatten()
                lengths = grams.value_lengths().to_numpy()
                row = np.repeat(np.repeat(np.arange(len(held)), held.value_lengths().to_numpy()), lengths)
                gram, tf = grams.flatten().to_numpy(), np.repeat(n.to_numpy(), lengths) * times.flatten().to_numpy()
                by = np.lexsort((gram, row))
                row, gram = row[by], gram[by]
                first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (gram[1:] != gram[:-1]))))
                raw = (1 + np.log(np.add.reduceat(tf[by], first))) * idfs.flatten().to_numpy()[by[first]]
                row = row[first]
                norms = np.sqrt(np.bincount(row, raw * raw, len(held)))
                ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(held))))).astype(np.int32)
                vectors = [pa.ListArray.from_arrays(ends, x) for x in (gram[first], raw / norms[row])]
                yield pa.RecordBatch.from_arrays([batch.column(key), *vectors], names=[key, "terms", "ws"])

    counted = df.select(key, F.explode(split_words(F.col(text))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))
    met = counted.join(words, "word").groupBy(key).agg(F.collect_list(F.struct("n", "grams", "times", "idfs")).alias("v"))
    return met.mapInArrow(run, f"{key} {dict(met.dtypes)[key]}, terms array<bigint>, ws array<double>")
