"""How much of the truth candidates hold, by strategy, source, cardinality and rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from ..operators.select import has


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


#: A pair's ids, and its positions.
PAIR, PLACES = ["entity", "match_id"], ["q", "p"]


def keys(truth: DataFrame) -> list[str]:
    """What a truth meets candidates by: positions if it has them, so that candidates need no ids."""
    return PLACES if set(PLACES) <= set(truth.columns) else PAIR


def hits(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Truth pairs (entity, match_id) with mask and rank of their candidate, null if there is none."""
    keep, by = [c for c in ("mask", "rank") if c in candidates.columns], keys(truth)
    return truth.select(*dict.fromkeys([*PAIR, *by])).dropDuplicates(by).join(candidates.select(*by, *keep), by, "left")


def candidate_recall(truth: DataFrame, candidates: DataFrame, pool: DataFrame, bits: dict[str, int] = C.LEGACY_BITS) -> DataFrame:
    """(kind, item, pairs, recovered, recall): overall, entities wholly and partly recalled, and pairs by strategy, source and cardinality of truth.

    pool: (match_id, source) tells the source of a match; matches outside it count under ``not_in_pool``.
    """
    told = hits(truth, candidates).join(pool.select("match_id", "source"), "match_id", "left").withColumn("hit", F.col("mask").isNotNull().cast("int"))
    told = told.withColumn("n_gt", F.count("*").over(Window.partitionBy("entity")))

    def part(kind: str, df: DataFrame, item: Column) -> DataFrame:
        rows = df.groupBy(item.cast("string").alias("item")).agg(F.count("*").alias("pairs"), F.sum("hit").cast("long").alias("recovered"))
        return rows.select(F.lit(kind).alias("kind"), "item", "pairs", "recovered")

    entities = told.groupBy("entity").agg(F.min("hit").alias("whole"), F.max("hit").alias("some"))
    whole = entities.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("whole"), F.lit(0)).alias("recovered"))
    partial = entities.agg(F.count("*").alias("pairs"), F.coalesce(F.sum(F.col("some") - F.col("whole")), F.lit(0)).alias("recovered"))
    by_strategy = told.agg(F.count("*").alias("pairs"), *(F.count_if(has(s, bits)).alias(s) for s in bits))
    by_strategy = by_strategy.select("pairs", F.explode(F.array(*(F.struct(F.lit(s).alias("item"), F.col(s).alias("recovered")) for s in bits))).alias("s"))
    out = [
        part("overall", told, F.lit("all")),
        whole.select(F.lit("entities").alias("kind"), F.lit("fully_recalled").alias("item"), "pairs", "recovered"),
        partial.select(F.lit("entities").alias("kind"), F.lit("partially_recalled").alias("item"), "pairs", "recovered"),
        by_strategy.select(F.lit("strategy").alias("kind"), F.col("s.item").alias("item"), "pairs", F.col("s.recovered").alias("recovered")),
        part("source", told, F.coalesce("source", F.lit("not_in_pool"))),
        part("cardinality", told, F.col("n_gt")),
    ]
    rows = out[0]
    for df in out[1:]:
        rows = rows.unionByName(df)
    return rows.select("kind", "item", F.col("pairs").cast("long").alias("pairs"), F.col("recovered").cast("long").alias("recovered"), _share(F.col("recovered").cast("double"), F.col("pairs")).alias("recall"))


def scale_recall(truth: DataFrame, candidates: DataFrame, known: DataFrame) -> DataFrame:
    """One row: shares of labelled queries with any hit, of resolvable pairs, and of queries with all their pairs.

    known: (match_id) that the pool has; other matches leave the pairs, while their queries stay.
    """
    resolved = hits(truth, candidates).join(known.select("match_id").distinct().withColumn("known", F.lit(1)), "match_id", "left")
    each = resolved.groupBy("entity").agg(F.count("known").alias("pairs"), F.count(F.when(F.col("known").isNotNull(), F.col("mask"))).alias("found"))
    sums = each.agg(F.count("*").alias("labelled"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum("found"), F.lit(0)).alias("found"), F.count_if(F.col("found") > 0).alias("any"), F.count_if((F.col("pairs") > 0) & (F.col("found") == F.col("pairs"))).alias("whole"))
    return sums.select("labelled", "pairs", "found", _share(F.col("any").cast("double"), F.col("labelled")).alias("query_recall"), _share(F.col("found").cast("double"), F.col("pairs")).alias("pair_recall"), _share(F.col("whole").cast("double"), F.col("labelled")).alias("all_pairs_recall"))


def strategy_counts(candidates: DataFrame, bits: dict[str, int] = C.SCALE_BITS) -> DataFrame:
    """(strategy, candidates): how many rows each strategy found."""
    sums = candidates.agg(*(F.count_if(has(s, bits)).alias(s) for s in bits))
    return sums.select(F.explode(F.array(*(F.struct(F.lit(s).alias("strategy"), F.col(s).alias("candidates")) for s in bits))).alias("s")).select("s.*")


def attribution(truth: DataFrame, candidates: DataFrame, bits: dict[str, int] = C.SCALE_BITS) -> DataFrame:
    """(strategy, candidates, recovered, exclusive, recall_without): exclusive pairs are found by it alone; recall without it is over the pairs that the union holds."""
    found = hits(truth, candidates)
    sums = found.agg(F.count("mask").alias("total"), *(F.count_if(has(s, bits)).alias(f"r_{s}") for s in bits), *(F.count_if(F.col("mask") == b).alias(f"x_{s}") for s, b in bits.items()))
    rows = sums.select("total", F.explode(F.array(*(F.struct(F.lit(s).alias("strategy"), F.col(f"r_{s}").alias("recovered"), F.col(f"x_{s}").alias("exclusive")) for s in bits))).alias("s")).select("total", "s.*")
    return strategy_counts(candidates, bits).join(rows, "strategy").select("strategy", "candidates", "recovered", "exclusive", _share((F.col("total") - F.col("exclusive")).cast("double"), F.col("total")).alias("recall_without"))


def rank_diagnostics(truth: DataFrame, candidates: DataFrame, caps: tuple[int, ...] = (50, 100, 200)) -> DataFrame:
    """(finder, pairs, median_rank, p90_rank, recovered_at_<cap>...): truth pairs by their sole finder, or ``several``."""
    found = hits(truth, candidates).where(F.col("mask").isNotNull())
    finder = F.lit("several")
    for s, b in C.SCALE_BITS.items():
        finder = F.when(F.col("mask") == b, s).otherwise(finder)
    return found.groupBy(finder.alias("finder")).agg(
        F.count("*").alias("pairs"),
        F.floor(F.percentile("rank", F.lit(0.5))).cast("long").alias("median_rank"),
        F.floor(F.percentile("rank", F.lit(0.9))).cast("long").alias("p90_rank"),
        *(F.count_if(F.col("rank") < c).alias(f"recovered_at_{c}") for c in caps),
    )


def frontier(caps: DataFrame, measured: DataFrame) -> DataFrame:
    """(name, candidates, pair_recall, cheapest_cap, saved): for each configuration the cheapest plain cap (cap, cap_candidates, cap_recall) of no less recall."""
    joined = measured.select("name", "candidates", "pair_recall").join(F.broadcast(caps), F.col("cap_recall") >= F.col("pair_recall"), "left")
    best = joined.groupBy("name", "candidates", "pair_recall").agg(F.min(F.struct("cap_candidates", "cap")).alias("best"))
    return best.select("name", "candidates", "pair_recall", F.col("best.cap").alias("cheapest_cap"), (1 - F.col("candidates") / F.col("best.cap_candidates")).alias("saved"))


def counted(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """(entity, n) of candidates (q, ...), counted before they meet the ids (q, entity_id)."""
    return candidates.groupBy("q").agg(F.count("*").alias("n")).join(queries.select("q", F.col("entity_id").alias("entity")), "q").select("entity", "n")


def _counts(candidates: DataFrame, universe: DataFrame) -> DataFrame:
    """(entity, n) of the whole universe, n null without candidates (entity, ...) or counts (entity, n)."""
    n = F.sum("n") if "n" in candidates.columns else F.count("*")
    return universe.select("entity").distinct().join(candidates.groupBy("entity").agg(n.alias("n")), "entity", "left")


def candidate_stats(candidates: DataFrame, universe: DataFrame) -> DataFrame:
    """One row over all queries (entity), those without candidates included: counts, mean, percentiles, zeros, maximum."""
    counts = _counts(candidates, universe).select(F.coalesce("n", F.lit(0)).alias("n"))
    return counts.agg(
        F.count("*").alias("queries"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("candidates"),
        F.avg("n").alias("mean"),
        F.percentile("n", F.lit(0.5)).alias("median"),
        F.percentile("n", F.lit(0.95)).alias("p95"),
        F.percentile("n", F.lit(0.99)).alias("p99"),
        F.max("n").alias("most"),
        F.count_if(F.col("n") == 0).alias("empty"),
    )


def candidate_histogram(candidates: DataFrame, universe: DataFrame) -> DataFrame:
    """(n_candidates, queries)."""
    counts = _counts(candidates, universe)
    return counts.groupBy(F.coalesce("n", F.lit(0)).alias("n_candidates")).agg(F.count("*").alias("queries"))


def missing_pairs(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Truth pairs that no strategy generated."""
    by = keys(truth)
    return truth.select(*dict.fromkeys([*PAIR, *by])).dropDuplicates(by).join(candidates.select(*by), by, "left_anti").select(*PAIR)
