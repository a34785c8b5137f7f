"""Joins that generate candidates, of both generations. Ties always go to the lower pool position.

A query side has (q, ...), a pool side (p, ...): positions. Results are (q, p, score).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.similarity import indel_ratio
from ..functions.text import blocking_tokens, index_tokens
from ..sources.workspace import kept
from . import terms as T
from .search import cosine_search

#: Scores are ordered by this many digits, so that the order of sums does not decide ties.
DIGITS = 10


def top_k(scored: DataFrame, k: int, by: tuple[str, ...] = ("q",)) -> DataFrame:
    """The k best rows of each query: Spark limits groups before the shuffle too."""
    order = Window.partitionBy(*by).orderBy(F.desc(F.round("score", DIGITS)), "p")
    return scored.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= k).drop("__rank")


def exact_key(queries: DataFrame, pool: DataFrame, key: str, cap: int, least: int = 2) -> DataFrame:
    """Equal keys of ``least`` characters or more, the first ``cap`` pool rows of each key: cut before the join, so that a hot key costs cap rows a query."""
    order = Window.partitionBy(key).orderBy("p")
    blocks = pool.where(F.length(key) >= least).select("p", key).withColumn("__at", F.row_number().over(order)).where(F.col("__at") <= cap).drop("__at")
    return queries.where(F.length(key) >= least).select("q", key).join(blocks, key).select("q", "p", F.lit(1.0).alias("score"))


def cosine(query_weights: DataFrame, pool_weights: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Sum of products over shared terms (and equal extra columns)."""
    both = query_weights.withColumnRenamed("w", "wq").join(pool_weights.withColumnRenamed("w", "wp"), ["term", *(extra or [])])
    return both.groupBy("q", "p").agg(F.sum(F.col("wq") * F.col("wp")).alias("score"))


class LegacyIndex:
    """In-memory generation: IDF-weighted token vectors, fitted on the pool alone."""

    def __init__(self, queries: DataFrame, pool: DataFrame, text: str, drop_generic: bool = False):
        tokens = blocking_tokens(F.col(text), drop_generic)
        rows = pool.agg(F.count("*").alias("n_rows"))
        frequency = T.document_frequency(pool, "p", tokens).crossJoin(F.broadcast(rows))
        self.idf = T.idf_legacy(frequency, F.col("n_rows"))
        self.pool = T.weighted(T.postings(pool, "p", tokens), self.idf, "p")
        self.queries = T.weighted(T.postings(queries, "q", tokens), self.idf, "q")

    def search(self, k: int, least: float = 0.0, apart: bool = False) -> DataFrame:
        """The k best by cosine, and of those the ones of ``least`` or more; apart: without the row of the query's own position."""
        return cosine_search(kept(self.queries, "asked"), kept(self.pool, "weights"), k, least, apart)


def token_name(queries: DataFrame, pool: DataFrame, k: int = 150, least: float = 0.30) -> DataFrame:
    return LegacyIndex(queries, pool, "name_core").search(k, least)


def token_address(queries: DataFrame, pool: DataFrame, k: int = 100, least: float = 0.35) -> DataFrame:
    return LegacyIndex(queries, pool, "addr_norm", drop_generic=True).search(k, least)


def char_name(queries: DataFrame, pool: DataFrame, k: int = 40, least: float = 0.20, n: tuple[int, int] = (2, 5), text: str = "name_core") -> DataFrame:
    """Cosine of character n-grams inside words, fitted on the pool. A record's vector is one row."""
    words = kept(T.word_grams({"q": queries, "p": pool}, "p", text, *n), "words")
    return cosine_search(kept(T.gram_vectors(queries, "q", text, words), "asked"), kept(T.gram_vectors(pool, "p", text, words), "weights"), k, least)


def country_aware(queries: DataFrame, pool: DataFrame, k: int = 15, least: float = 0.25, group: int = 5, fallback: int = 20) -> DataFrame:
    """Token cosine inside a country, for countries with a group of pool rows; queries of no or a small country search the whole pool.

    Rows without a country form a group like others, so queries without one do both if it is large enough.
    """
    index = LegacyIndex(queries, pool, "name_core")
    sizes = pool.groupBy("country_norm").agg(F.count("*").alias("size"))
    country = queries.select("q", "country_norm").join(sizes, "country_norm", "left").withColumn("size", F.coalesce("size", F.lit(0)))
    inside = cosine(index.queries.join(country.where(F.col("size") >= group).select("q", "country_norm"), "q"), index.pool.join(pool.select("p", "country_norm"), "p"), ["country_norm"])
    outside = cosine(index.queries.join(country.where((F.col("size") < group) | (F.col("country_norm") == "")).select("q"), "q"), index.pool)
    found = top_k(inside, k).unionByName(top_k(outside, fallback)).where(F.round("score", DIGITS) >= least)
    return found.groupBy("q", "p").agg(F.max("score").alias("score"))


class ScaleIndex:
    """Indexed generation: terms of a bounded document frequency, their postings and the pool's norms."""

    def __init__(self, pool: DataFrame, text: str, stop: tuple[str, ...], least: int = 2, most: int = 5000):
        self.tokens = lambda: index_tokens(F.col(text), stop)
        rows = pool.agg(F.count("*").alias("n_rows"))
        frequency = T.document_frequency(pool, "p", self.tokens()).crossJoin(F.broadcast(rows))
        self.terms = T.idf_scale(frequency, F.col("n_rows"), least, most)
        self.postings = T.postings(pool, "p", self.tokens()).join(self.terms, "term").select("p", "term", "tf", "df", "idf")
        self.stored_norms: DataFrame | None = None

    def norms(self) -> DataFrame:
        """(p, norm): every occurrence of a term adds its squared idf. Read, if the index was loaded."""
        if self.stored_norms is not None:
            return self.stored_norms
        return self.postings.groupBy("p").agg(F.sqrt(F.sum(F.col("tf") * F.col("idf") * F.col("idf"))).alias("norm"))

    def chosen(self, queries: DataFrame, budget: int, most_terms: int = 3) -> DataFrame:
        """(q, term, idf, qnorm): up to most_terms rarest occurrences while their postings stay within the budget; the rarest always."""
        asked = queries.select("q", F.posexplode(self.tokens()).alias("at", "term")).join(self.terms, "term")
        order = Window.partitionBy("q").orderBy("df", "at")
        ranked = asked.select(
            "q",
            "term",
            "idf",
            F.row_number().over(order).alias("rank"),
            F.sum("df").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("spent"),
            F.sqrt(F.sum(F.col("idf") * F.col("idf")).over(Window.partitionBy("q"))).alias("qnorm"),
        )
        return ranked.where((F.col("rank") <= most_terms) & ((F.col("spent") <= budget) | (F.col("rank") == 1)))

    def shares(self, queries: DataFrame, budget: int, most_terms: int = 3) -> DataFrame:
        """(q, p, share): every posting of the chosen terms, with what the term adds to the pair's score."""
        chosen = self.chosen(queries, budget, most_terms).groupBy("q", "term", "qnorm").agg(F.sum(F.col("idf") * F.col("idf")).alias("w"))
        postings = self.postings.select("p", "term").join(self.norms(), "p")
        return chosen.join(postings, "term").select("q", "p", F.coalesce(F.try_divide("w", F.col("qnorm") * F.col("norm")), F.lit(0.0)).alias("share"))

    def gather(self, queries: DataFrame, budget: int, most_terms: int = 3) -> DataFrame:
        """Postings of the chosen terms, scored: overlap of squared idfs over both norms. A repeated query word counts each time."""
        met = self.shares(queries, budget, most_terms).repartition("q")  # the one shuffle of pairs
        return met.groupBy("q", "p").agg(F.sum("share").alias("score"))


def name_index(pool: DataFrame) -> ScaleIndex:
    return ScaleIndex(pool, "name_core", C.NAME_STOP)


def address_index(pool: DataFrame) -> ScaleIndex:
    return ScaleIndex(pool, "addr_core", C.ADDRESS_STOP)


def neighbours(queries: DataFrame, pool: DataFrame, key: str = "name_core", prefix: int = 6, window: int = 50) -> DataFrame:
    """The first window + 1 pool rows, by key bytes and position, of each query's prefix bytes: (q, p, query key, pool key).

    Keys of fewer bytes than the prefix meet equal keys alone.
    """
    bytes_ = lambda: F.encode(key, "utf-8")
    start = lambda: F.hex(F.substring(bytes_(), 1, prefix))
    order = Window.partitionBy("start").orderBy(bytes_(), "p")
    blocks = pool.where(F.length(key) > 0).select("p", key, start().alias("start")).withColumn("at", F.row_number().over(order)).where(F.col("at") <= window + 1)
    asked = queries.where(F.length(key) > 0).select("q", F.col(key).alias("qkey"), start().alias("start"))
    return asked.join(blocks.select("p", F.col(key).alias("pkey"), "start"), "start").select("q", "p", "qkey", "pkey")


def sorted_neighbourhood(queries: DataFrame, pool: DataFrame, least: float = 0.55, **options) -> DataFrame:
    """Neighbours by sorted core names whose Indel ratio is ``least`` or more; the ratio is computed on what the window leaves."""
    scored = neighbours(queries, pool, **options).withColumn("score", indel_ratio("qkey", "pkey"))
    return scored.where(F.col("score") >= least).select("q", "p", "score")


def country_prior(queries: DataFrame, pool: DataFrame, k: int = 50) -> DataFrame:
    """The first k pool rows of a query's country."""
    return exact_key(queries, pool, "country_norm", k, least=1)


def resolve_ids(ids: DataFrame, rows: DataFrame) -> DataFrame:
    """(entity_id) to (entity_id, pos): the lowest position of the id, -1 if unknown."""
    known = rows.groupBy("entity_id").agg(F.min("pos").alias("pos"))
    return ids.join(known, "entity_id", "left").select("entity_id", F.coalesce("pos", F.lit(-1)).alias("pos"))


def excluding_self(scored: DataFrame, k: int) -> DataFrame:
    """Top k of a table searched against itself, without the row itself."""
    return top_k(scored.where("q <> p"), k)
