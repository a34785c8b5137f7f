"""One query per operator, over records made from the driver's tables (see sources.adapter)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Config
from .functions import similarity as SIM
from .functions import text as T
from .functions.address import components
from .operators import features as X
from .operators import retrieval as R
from .operators import select as S
from .operators import terms
from .plans import errors, experiment, linkage, metrics, profile, recall
from .sources import adapter, sinks, store, truth
from .sources.workspace import drop_kept, kept

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
#: The configured cap of candidates a query.
CAP = Config().scale.max_candidates_per_s1
RAW = ["entity_id", "business_name", "business_address", "country"]


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def r6(*names: str) -> list[Column]:
    return [F.round(n, 6).alias(n) for n in names]


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits."""
    return df.select(*(F.round(c, 6).alias(c) if kind == "double" else c for c, kind in df.dtypes))


def records(spark: SparkSession, sf: str) -> DataFrame:
    return adapter.entity_records(spark, sf)


_SHARED: dict[tuple[str, str, str], object] = {}


def shared(step: Callable) -> Callable:
    """Keeps what several queries start from while the application and its tables stay the same; forget() drops it."""

    @functools.wraps(step)
    def run(spark: SparkSession, sf: str):
        key = (spark.sparkContext.applicationId, sf, step.__name__)
        if key not in _SHARED:
            for old in [k for k in _SHARED if k[0] != key[0]]:
                del _SHARED[old]  # of a session that has ended
            _SHARED[key] = step(spark, sf)
        return _SHARED[key]

    return run


def forget() -> None:
    """Drop the shared steps and their files: after the tables have changed, or to time a query alone."""
    for frames in _SHARED.values():
        for df in frames if isinstance(frames, tuple) else (frames,):
            drop_kept(df)
    _SHARED.clear()


@shared
def both(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Normalised records of both sides: one of the two points at which a flow keeps what it has."""
    queries, pool = linkage.sides_of(*adapter.sides(spark, sf))
    return kept(queries, "queries"), kept(pool, "pool")


@shared
def truth_of(spark: SparkSession, sf: str) -> DataFrame:
    return kept(adapter.truth_pairs(spark, sf).withColumnRenamed("s1_id", "entity"), "truth")


@shared
def universe_of(spark: SparkSession, sf: str) -> DataFrame:
    return kept(records(spark, sf).where("src = 0").select(F.col("entity_id").alias("entity")), "universe")


def pairs_of(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(truth pairs, universe)."""
    return truth_of(spark, sf), universe_of(spark, sf)


@shared
def full_union(spark: SparkSession, sf: str) -> DataFrame:
    """Ranked union of all strategies of the indexed generation, uncapped: the other point that is kept."""
    return kept(linkage.scale_candidates(*both(spark, sf), cap=0), "union")


def placed_truth(spark: SparkSession, sf: str) -> DataFrame:
    """Truth pairs with positions: they meet candidates without that all of these need ids."""
    return adapter.placed(spark, sf, truth_of(spark, sf))


def candidates(spark: SparkSession, sf: str, cap: int = 0) -> DataFrame:
    """The union with the ids of both sides, up to a cap if one is given."""
    queries, pool = both(spark, sf)
    rows = full_union(spark, sf)
    return linkage.with_ids(rows.where(F.col("rank") < cap) if cap else rows, queries, pool)


def capped(spark: SparkSession, sf: str) -> DataFrame:
    """The union under the configured cap."""
    return full_union(spark, sf).where(F.col("rank") < CAP)


@shared
def exact_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Scored pairs for the metric queries: name token cosine, in hundredths so that scores tie."""
    queries, pool = both(spark, sf)
    found = linkage.with_ids(R.token_name(queries, pool), queries, pool)
    return kept(found.select("entity", "match_id", F.round("score", 2).alias("score")), "scored")


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.decided(exact_scored(spark, sf), 0.6)


# --- profiles -------------------------------------------------------------------------------------------------------


@query
def scan_profile(spark, sf):
    return rounded(profile.profile(records(spark, sf), RAW))


@query
def country_distribution(spark, sf):
    return profile.value_counts(records(spark, sf), "country", ["src"])


@query
def open_set_countries(spark, sf):
    """Countries, and names, that the pool has and source 1 has not."""
    rows = records(spark, sf)
    known, pool = rows.where("src = 0"), rows.where("src > 0")
    new = [profile.unseen(pool, known, c).select(F.lit(c).alias("column"), F.col(c).alias("value")) for c in ("country", "business_name")]
    return new[0].unionByName(new[1])


@query
def duplicate_report(spark, sf):
    rows = records(spark, sf)
    out = None
    for name, keys in (("row", RAW), ("id", ["entity_id"]), ("name", ["business_name"]), ("name_address", ["business_name", "business_address"])):
        part = profile.duplicates(rows, keys).select(F.lit(name).alias("keys"), "groups", "repeats")
        out = part if out is None else out.unionByName(part)
    return out


@query
def length_stats(spark, sf):
    return rounded(profile.length_stats(records(spark, sf), ["business_name", "business_address"]))


@query
def coverage(spark, sf):
    return rounded(profile.coverage(adapter.normalised(records(spark, sf)), ["name_norm", "addr_norm", "country_norm", "pincode", "house_number", "city", "state"]))


@query
def id_report(spark, sf):
    return profile.id_report(records(spark, sf))


@query
def id_prefixes(spark, sf):
    return profile.prefix_counts(records(spark, sf))


@query
def schema_validation(spark, sf):
    return profile.warnings(records(spark, sf))


@query
def id_collision(spark, sf):
    rows = records(spark, sf)
    return profile.shared_ids(rows.where("src = 0"), rows.where("src > 0").withColumn("entity_id", F.concat(F.lit("S1-"), (F.col("doc_id") - F.col("src")).cast("string"))))


@query
def most_common_name(spark, sf):
    return profile.most_common(records(spark, sf), "business_name")


@query
def frequent_blocks(spark, sf):
    return rounded(profile.running_share(records(spark, sf), "business_name"))


@query
def part_name_blocks(spark, sf):
    """Hot keys on another table: parts by name, with shares."""
    return rounded(profile.running_share(spark.read.parquet(f"{sf}/part.parquet"), "p_name"))


@query
def customer_nation_profile(spark, sf):
    customers, nations, regions = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "nation", "region"))
    joined = customers.join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy("r_name", "n_name").agg(F.count("*").alias("customers"))


@query
def pool_union(spark, sf):
    rows = records(spark, sf)
    s2, s3 = (rows.where(f"src = {k}").select("entity_id", "business_name", "pos") for k in (1, 2))
    return s2.withColumn("source", F.lit("S2")).unionByName(s3.withColumn("source", F.lit("S3")))


# --- normalisers ----------------------------------------------------------------------------------------------------


def texts(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", F.col("text").alias("v"))


@query
def normalize_name_norm(spark, sf):
    return texts(spark, sf).select("doc_id", T.normalize_name(F.col("v")).alias("name_norm"))


@query
def normalize_name_core(spark, sf):
    return texts(spark, sf).select("doc_id", T.normalize_name(F.col("v"), core=True).alias("name_core"))


@query
def normalize_address(spark, sf):
    return texts(spark, sf).select("doc_id", T.normalize_address(F.col("v")).alias("addr_norm"))


@query
def normalize_country(spark, sf):
    return texts(spark, sf).select("doc_id", T.normalize_country(F.when(F.col("doc_id") % 5 == 0, F.lit("N/A")).when(F.col("doc_id") % 5 == 1, F.lit(" Unknown ")).otherwise(F.concat("lang", F.lit("-É")))).alias("country_norm"))


@query
def name_tokens(spark, sf):
    core = T.normalize_name(F.col("v"), core=True)
    return texts(spark, sf).select("doc_id", F.array_join(T.ascii_tokens(core), "|").alias("name_tokens"), F.array_join(T.ascii_tokens(T.normalize_name(F.col("v"))), "|").alias("content_tokens"))


@query
def address_core(spark, sf):
    norm = T.normalize_address(F.col("v"))
    return texts(spark, sf).select("doc_id", T.address_core(norm).alias("addr_core"), T.address_core(norm, whole_tokens=True).alias("store_addr_core"))


def shaped_addresses(spark, sf):
    """Addresses of several layouts from words and keys of documents."""
    rows = records(spark, sf)
    w = lambda i: F.element_at(F.split(F.concat("business_name", F.lit(" a b c d e f")), " "), i)
    d = F.col("doc_id").cast("string")
    return rows.select(
        "doc_id",
        F.when(F.col("doc_id") % 6 == 0, F.concat(d, F.lit(" "), w(1), F.lit(" Road, "), w(2), F.lit(", "), w(3), F.lit(" "), F.lpad(d, 5, "7")))
        .when(F.col("doc_id") % 6 == 1, F.concat(F.lit("Flat "), d, F.lit(", "), w(1), F.lit(" Street, "), w(2), F.lit(", "), w(3)))
        .when(F.col("doc_id") % 6 == 2, F.concat(w(1), F.lit(" Avenue "), w(2), F.lit(" TX "), F.lpad(d, 5, "8")))
        .when(F.col("doc_id") % 6 == 3, F.concat(F.lit("near "), w(1), F.lit(", "), w(2), F.lit(", "), F.lpad(d, 6, "4")))
        .when(F.col("doc_id") % 6 == 4, F.concat(F.lit("#"), d, F.lit("/2, Plot no "), d, F.lit(", "), w(1), F.lit(", "), w(2), F.lit(", in")))
        .otherwise(F.concat(w(1), F.lit(" 12 345 678 "), w(2)))
        .alias("v"),
    )


@query
def address_components(spark, sf):
    rows = shaped_addresses(spark, sf)
    return rows.withColumn("c", components(T.normalize_address(F.col("v")))).select("doc_id", "c.*")


@query
def digit_runs(spark, sf):
    return texts(spark, sf).select("doc_id", F.array_join(F.array_sort(T.digit_runs(F.concat("v", F.lit(" "), F.col("doc_id").cast("string")))), "|").alias("runs"))


@query
def tokenize_generic(spark, sf):
    return texts(spark, sf).select("doc_id", F.array_join(T.blocking_tokens(F.concat(T.normalize_address(F.col("v")), F.lit(" near main road")), drop_generic=True), "|").alias("tokens"))


@query
def char_ngram_counts(spark, sf):
    return texts(spark, sf).select("doc_id", F.size(T.char_ngrams(T.normalize_name(F.col("v")))).alias("n_grams"), F.size(T.word_ngrams(T.normalize_name(F.col("v")), 2, 5)).alias("n_word_grams"))


# --- truth ----------------------------------------------------------------------------------------------------------


@query
def truth_pairs(spark, sf):
    return adapter.truth_pairs(spark, sf)


@query
def truth_wide_parse(spark, sf):
    pairs, universe = pairs_of(spark, sf)
    return truth.parse(truth.wide(pairs, universe))


@query
def truth_long_parse(spark, sf):
    pairs = truth_of(spark, sf)
    labelled = pairs.select(F.col("entity").alias("s1_id"), F.col("match_id").alias("target_id"), F.lit(1).alias("label"))
    return truth.parse(labelled.unionByName(labelled.select("s1_id", F.concat("target_id", F.lit("x")).alias("target_id"), F.lit(0).alias("label"))))


@query
def truth_verified(spark, sf):
    pairs, universe = pairs_of(spark, sf)
    return truth.verified(pairs, decisions(spark, sf).select("entity"))


@query
def valid_match_filter(spark, sf):
    pairs = truth_of(spark, sf)
    return truth.valid(pairs, records(spark, sf).where("src = 1"))


@query
def cardinality_histogram(spark, sf):
    return profile.cardinalities(*pairs_of(spark, sf))


@query
def cardinality_summary(spark, sf):
    return rounded(profile.cardinality_summary(*pairs_of(spark, sf)))


# --- term statistics ------------------------------------------------------------------------------------------------


@query
def term_df_legacy(spark, sf):
    _, pool = both(spark, sf)
    return terms.document_frequency(pool, "p", T.blocking_tokens(F.col("name_core")))


@query
def idf_legacy(spark, sf):
    queries, pool = both(spark, sf)
    return R.LegacyIndex(queries, pool, "name_core").idf.select("term", "df", *r6("idf"))


@query
def term_df_scale(spark, sf):
    _, pool = both(spark, sf)
    return R.name_index(pool).terms.select("term", "df")


@query
def idf_scale(spark, sf):
    _, pool = both(spark, sf)
    return R.address_index(pool).terms.select("term", "df", *r6("idf"))


@query
def doc_norms(spark, sf):
    _, pool = both(spark, sf)
    return R.name_index(pool).norms().select("p", *r6("norm"))


@query
def tfidf_weights_legacy(spark, sf):
    queries, pool = both(spark, sf)
    return R.LegacyIndex(queries, pool, "addr_norm", drop_generic=True).pool.select("p", "term", *r6("w"))


# --- candidate joins ------------------------------------------------------------------------------------------------


@query
def block_exact_normalized(spark, sf):
    return R.exact_key(*both(spark, sf), "name_norm", 200)


@query
def block_exact_core(spark, sf):
    return R.exact_key(*both(spark, sf), "name_core", 1000, least=1)


@query
def block_exact_capped(spark, sf):
    return R.exact_key(*both(spark, sf), "name_norm", 5)


@query
def block_token_name(spark, sf):
    return R.token_name(*both(spark, sf)).select("q", "p", *r6("score"))


@query
def block_address_token(spark, sf):
    return R.token_address(*both(spark, sf)).select("q", "p", *r6("score"))


@query
def block_country_aware(spark, sf):
    return R.country_aware(*both(spark, sf)).select("q", "p", *r6("score"))


@query
def block_country_topk(spark, sf):
    return R.country_prior(*both(spark, sf))


@query
def block_char_tfidf(spark, sf):
    return R.char_name(*both(spark, sf)).select("q", "p", *r6("score"))


@query
def gather_budgeted(spark, sf):
    queries, pool = both(spark, sf)
    return R.name_index(pool).gather(queries, budget=3000).select("q", "p", *r6("score"))


@query
def gather_address(spark, sf):
    queries, pool = both(spark, sf)
    return R.address_index(pool).gather(queries, budget=1500).select("q", "p", *r6("score"))


@query
def block_prefix_window(spark, sf):
    return R.neighbours(*both(spark, sf)).select("q", "p")


@query
def block_sorted_neighbourhood(spark, sf):
    return R.sorted_neighbourhood(*both(spark, sf)).select("q", "p", *r6("score"))


@query
def self_search(spark, sf):
    """Addresses of the pool searched in the pool itself, without the row."""
    _, pool = both(spark, sf)
    index = R.LegacyIndex(pool.withColumn("q", F.col("p")), pool, "name_core")
    return index.search(3, apart=True).select("q", "p", *r6("score"))


@query
def resolve_ids(spark, sf):
    rows = records(spark, sf)
    asked = rows.select(F.when(F.col("doc_id") % 4 == 0, F.concat("entity_id", F.lit("?"))).otherwise(F.col("entity_id")).alias("entity_id"))
    return R.resolve_ids(asked, rows.where("src > 0"))


@query
def gather_rows(spark, sf):
    """A row of source 2 for every document: all of them several times, in another order, and some beyond the table."""
    every = records(spark, sf)
    rows = every.where("src = 1").select(F.col("pos").alias("rowid"), "entity_id", "business_name")
    asked = every.select(F.col("doc_id").alias("at"), F.floor(F.col("doc_id") / 2).cast("long").alias("rowid"))
    return store.gather(rows, asked)


@query
def range_read(spark, sf):
    rows = records(spark, sf).where("src = 2").select(F.col("pos").alias("rowid"), "entity_id")
    return store.read_range(rows, -5, 10**9)


@query
def store_rows(spark, sf):
    return store.normalised_rows(records(spark, sf).select(*RAW))


# --- union, caps, quotas --------------------------------------------------------------------------------------------


@query
def union_legacy(spark, sf):
    queries, pool = both(spark, sf)
    return S.union_legacy(linkage.legacy_strategies(queries, pool)).select("q", "p", "mask", *r6("score"))


@query
def union_legacy_all(spark, sf):
    """The union under the configured cap."""
    return linkage.legacy_candidates(*both(spark, sf)).select("q", "p", "mask", *r6("score"))


@query
def cap_legacy(spark, sf):
    """The same union cut to ten, so that the cap bites."""
    return S.capped_legacy(S.union_legacy(linkage.legacy_strategies(*both(spark, sf))), 10, 5).select("q", "p", "mask", *r6("score"))


@query
def union_scale(spark, sf):
    """The union of all strategies under the configured cap."""
    return linkage.scale_candidates(*both(spark, sf)).select("q", "p", "mask", "rule_score", *r6("content_score"), "rank")


@query
def union_scale_all(spark, sf):
    """The union of all strategies without a cap."""
    return linkage.scale_candidates(*both(spark, sf), cap=0).select("q", "p", "mask", "rule_score", *r6("content_score"), "rank")


@query
def cap_scale(spark, sf):
    found = full_union(spark, sf).drop("rank")
    return S.capped_scale(found, 100).select("q", "p", "mask", "rule_score", *r6("content_score"))


def _selection(spark, sf, how):
    return S.select(full_union(spark, sf), how).select("q", "p", "mask", "rank")


@query
def quota_rank(spark, sf):
    return _selection(spark, sf, S.CONFIGURATIONS["C"])


@query
def quota_union(spark, sf):
    return _selection(spark, sf, S.CONFIGURATIONS["C2"])


@query
def exclude_only(spark, sf):
    return _selection(spark, sf, S.CONFIGURATIONS["E"])


@query
def quota_exclude(spark, sf):
    return _selection(spark, sf, S.CONFIGURATIONS["G2"])


@query
def adaptive_quota(spark, sf):
    """Quotas measured from the yields of the strategies (configuration D2)."""
    pairs = placed_truth(spark, sf)
    rows = full_union(spark, sf)
    cap, mode = experiment.ADAPTIVE["D2"]
    return S.adaptive(rows, recall.attribution(pairs, rows), cap, mode, "__kept").where("__kept").select("q", "p", "mask", "rank")


@query
def strategy_labels(spark, sf):
    return full_union(spark, sf).groupBy(F.array_join(S.strategy_names(F.col("mask")), "+").alias("strategies")).agg(F.count("*").alias("n"))


# --- recall ---------------------------------------------------------------------------------------------------------


@query
def candidate_stats(spark, sf):
    universe = universe_of(spark, sf)
    return rounded(recall.candidate_stats(recall.counted(full_union(spark, sf), both(spark, sf)[0]), universe))


@query
def candidate_histogram(spark, sf):
    universe = universe_of(spark, sf)
    return recall.candidate_histogram(recall.counted(full_union(spark, sf), both(spark, sf)[0]), universe)


@query
def strategy_counts(spark, sf):
    return recall.strategy_counts(full_union(spark, sf))


@query
def candidate_recall(spark, sf):
    pairs = placed_truth(spark, sf)
    pool = records(spark, sf).where("src > 0").select(F.col("entity_id").alias("match_id"), F.concat(F.lit("S"), (F.col("src") + 1).cast("string")).alias("source"))
    return rounded(recall.candidate_recall(pairs, capped(spark, sf), pool, R.C.SCALE_BITS))


@query
def scale_recall(spark, sf):
    pairs = placed_truth(spark, sf)
    """Against the pool of source 2 alone: matches in source 3 cannot be resolved."""
    known = records(spark, sf).where("src = 1").select(F.col("entity_id").alias("match_id"))
    return rounded(recall.scale_recall(pairs, full_union(spark, sf), known))


@query
def attribution(spark, sf):
    return rounded(recall.attribution(placed_truth(spark, sf), full_union(spark, sf)))


@query
def rank_diagnostics(spark, sf):
    return recall.rank_diagnostics(placed_truth(spark, sf), full_union(spark, sf))


@query
def missing_pairs(spark, sf):
    return recall.missing_pairs(placed_truth(spark, sf), capped(spark, sf))


@query
def configuration_recall(spark, sf):
    """Every named cap and quota, measured ones too, over one ranked pass."""
    pairs = placed_truth(spark, sf)
    known = records(spark, sf).where("src > 0").select(F.col("entity_id").alias("match_id"))
    return rounded(experiment.measured(full_union(spark, sf), pairs, known, list(S.CONFIGURATIONS.values()), experiment.ADAPTIVE))


@query
def frontier(spark, sf):
    """The cheapest plain cap of no less recall, for each configuration with quotas."""
    pairs = placed_truth(spark, sf)
    known = records(spark, sf).where("src > 0").select(F.col("entity_id").alias("match_id"))
    told = kept(experiment.measured(full_union(spark, sf), pairs, known, list(S.CONFIGURATIONS.values())), "configurations")
    caps = told.where(F.col("name").startswith("cap_"))
    quotas = told.where(F.col("name").isin(*(n for n, c in S.CONFIGURATIONS.items() if c.quotas)))
    return rounded(recall.frontier(caps.select("cap", F.col("candidates").alias("cap_candidates"), F.col("pair_recall").alias("cap_recall")), quotas))


# --- features -------------------------------------------------------------------------------------------------------


def feature_pairs(spark, sf):
    """All candidates under the configured cap."""
    queries, pool = both(spark, sf)
    return capped(spark, sf).select("q", "p"), queries, pool


@query
def features_native(spark, sf):
    pairs, queries, pool = feature_pairs(spark, sf)
    rows = X.native_features(X.paired(pairs, queries, pool))
    names = [c for c in X.FEATURES if c in rows.columns]
    return rounded(rows.select("q", "p", *names))


@query
def features_cosine(spark, sf):
    pairs, queries, pool = feature_pairs(spark, sf)
    return rounded(X.cosines(pairs, queries, pool))


@query
def features_combined(spark, sf):
    pairs, queries, pool = feature_pairs(spark, sf)
    rows = X.combined_features(X.native_features(X.paired(X.cosines(pairs, queries, pool), queries, pool)))
    return rounded(rows.select("q", "p", *X.COMBINED))


def name_pairs(spark, sf):
    """Name pairs of the sorted neighbourhood."""
    queries, pool = both(spark, sf)
    pairs = R.neighbours(queries, pool)
    return pairs.select("q", "p", F.col("qkey").alias("a"), F.col("pkey").alias("b"))


@query
def features_indel(spark, sf):
    """The Indel ratio by the Arrow UDF."""
    return rounded(name_pairs(spark, sf).select("q", "p", SIM.indel_ratio("a", "b").alias("ratio"), SIM.token_sort_ratio("a", "b").alias("sorted_ratio")))


@query
def features_indel_native(spark, sf):
    """The Indel ratio by column expressions."""
    return rounded(name_pairs(spark, sf).select("q", "p", SIM.indel_native(F.col("a"), F.col("b")).alias("ratio")))


@query
def features_token_set(spark, sf):
    return rounded(name_pairs(spark, sf).select("q", "p", SIM.token_set_ratio("a", "b").alias("ratio")))


@query
def features_jaro_winkler(spark, sf):
    return rounded(name_pairs(spark, sf).select("q", "p", SIM.jaro_winkler_similarity("a", "b").alias("similarity")))


@query
def pair_features(spark, sf):
    """All 62 features, checked for finite values."""
    pairs, queries, pool = feature_pairs(spark, sf)
    return X.checked(X.pair_features(kept(X.cosines(pairs, queries, pool), "cosines"), queries, pool))


@query
def pair_labels(spark, sf):
    pairs = truth_of(spark, sf)
    rows = candidates(spark, sf, CAP).select(F.col("entity").alias("s1_id"), "match_id")
    return X.labelled(rows, pairs.withColumnRenamed("entity", "s1_id"))


@query
def class_means(spark, sf):
    cands, queries, pool = feature_pairs(spark, sf)
    ids = [F.col("q").alias("s1_id"), F.col("p").alias("match_id")]  # positions tell pairs as well as ids
    told = X.labelled(cands.select(*ids, "q", "p"), placed_truth(spark, sf).select(*ids))
    rows = X.native_features(X.paired(told.select("q", "p", "label"), queries, pool))
    return rounded(errors.class_means(rows, ["name_jaccard", "address_jaccard", "country_exact_match", "name_length_ratio"]))


@query
def constant_features(spark, sf):
    cands, queries, pool = feature_pairs(spark, sf)
    rows = X.native_features(X.paired(cands, queries, pool))
    return rounded(errors.constant_features(rows, ["name_both_missing", "country_missing", "name_jaccard", "country_exact_match"]))


# --- metrics --------------------------------------------------------------------------------------------------------


@query
def f05_per_entity(spark, sf):
    return rounded(metrics.per_entity(decisions(spark, sf), *pairs_of(spark, sf)))


@query
def f05_macro(spark, sf):
    return rounded(metrics.macro(decisions(spark, sf), *pairs_of(spark, sf)))


@query
def threshold_sweep(spark, sf):
    return rounded(metrics.sweep(exact_scored(spark, sf), *pairs_of(spark, sf), metrics.grid(spark)))


@query
def breakpoint_sweep(spark, sf):
    return rounded(metrics.breakpoints(exact_scored(spark, sf), *pairs_of(spark, sf)))


@query
def breakpoint_sweep_spaced(spark, sf):
    """At 400 scores, evenly spaced among all that the union's content scores take."""
    scored = full_union(spark, sf).select(F.col("q").alias("entity"), F.col("p").alias("match_id"), F.round("content_score", 6).alias("score"))
    pairs = placed_truth(spark, sf).select(F.col("q").alias("entity"), F.col("p").alias("match_id"))
    return rounded(metrics.breakpoints(scored, pairs, both(spark, sf)[0].select(F.col("q").alias("entity"))))


@query
def best_threshold(spark, sf):
    return rounded(metrics.best(metrics.breakpoints(exact_scored(spark, sf), *pairs_of(spark, sf))))


@query
def error_buckets(spark, sf):
    return rounded(errors.error_buckets(exact_scored(spark, sf), *pairs_of(spark, sf), 0.6))


@query
def score_distribution(spark, sf):
    pairs = truth_of(spark, sf)
    return rounded(errors.score_distribution(exact_scored(spark, sf), pairs))


@query
def calibration(spark, sf):
    pairs = truth_of(spark, sf)
    return rounded(errors.calibration(exact_scored(spark, sf), pairs))


@query
def worst_entities(spark, sf):
    return rounded(errors.worst_entities(decisions(spark, sf), *pairs_of(spark, sf)))


# --- decisions and models -------------------------------------------------------------------------------------------


@query
def decide_and_emit(spark, sf):
    universe = universe_of(spark, sf)
    return sinks.matching_results(decisions(spark, sf), universe)


@query
def candidate_pairs_emit(spark, sf):
    universe = universe_of(spark, sf)
    return sinks.candidate_pairs(exact_scored(spark, sf), universe)


@query
def submission_checks(spark, sf):
    universe = universe_of(spark, sf)
    """Of results without rows for entities that match nothing, against candidates found by address, and ids of source 2 alone."""
    told = decisions(spark, sf)
    queries, pool = both(spark, sf)
    others = linkage.with_ids(R.token_address(queries, pool), queries, pool)
    return sinks.submission_problems(sinks.matching_results(told, told.select("entity")), others, universe, records(spark, sf).where("src = 1"))


@query
def entity_folds(spark, sf):
    universe = universe_of(spark, sf)
    return linkage.folds(universe, 4)


@query
def training_sample(spark, sf):
    pairs = truth_of(spark, sf)
    rows = candidates(spark, sf).select(F.col("entity").alias("s1_id"), "match_id", "q", "p", (-F.col("rank")).alias("rank_score"))
    return linkage.training_sample(X.labelled(rows, pairs.withColumnRenamed("entity", "s1_id")), 5, 0.0).select("q", "p", "label")


@query
def train_score_lr(spark, sf):
    """A logistic regression on the features of candidates, fitted and applied."""
    pairs = truth_of(spark, sf)
    cands, queries, pool = feature_pairs(spark, sf)
    rows = linkage.with_ids(X.pair_features(kept(X.cosines(cands, queries, pool), "cosines"), queries, pool), queries, pool)
    told = X.labelled(rows.withColumnRenamed("entity", "s1_id"), pairs.withColumnRenamed("entity", "s1_id")).withColumnRenamed("s1_id", "entity")
    told = kept(told, "features")
    model = linkage.estimator("logistic_regression", linkage.Models()).fit(linkage.weighted(told))
    return rounded(linkage.scored(model, told).select("entity", "match_id", "label", "score"))


@functools.cache
def queries() -> dict[str, Query]:
    return dict(REGISTRY)
