"""What a decision got wrong: buckets of errors, score distributions, calibration, the worst entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import labelled, per_entity, truth_sizes

EDGES = (0.0, 0.1, 0.3, 0.5, 0.7, 0.9, 1.01)


def error_buckets(scored: DataFrame, truth: DataFrame, universe: DataFrame, threshold: float) -> DataFrame:
    """One row: truth pairs that blocking lost and that the model lost, false merges, singletons with predictions, and their rates.

    The model's rate is over truth pairs among the candidates, the others over truth pairs, predictions and singletons.
    """
    told = labelled(scored, truth)
    counts = told.agg(
        F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("candidate_positives"),
        F.count_if((F.col("label") == 1) & (F.col("score") < threshold)).alias("model_misses"),
        F.count_if((F.col("label") == 0) & (F.col("score") >= threshold)).alias("false_merges"),
        F.count_if(F.col("score") >= threshold).alias("predictions"),
    )
    sizes = truth_sizes(truth, universe)
    sums = sizes.agg(F.coalesce(F.sum("n_gt"), F.lit(0)).cast("long").alias("true_pairs"), F.count_if(F.col("n_gt") == 0).alias("singletons"))
    single = sizes.where("n_gt = 0").join(scored.where(F.col("score") >= threshold).select("entity").distinct(), "entity", "left_semi").agg(F.count("*").alias("singleton_violations"))
    rows = counts.crossJoin(sums).crossJoin(single).withColumn("blocking_misses", F.col("true_pairs") - F.col("candidate_positives"))
    rate = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return rows.select(
        "true_pairs", "candidate_positives", "blocking_misses", "model_misses", "false_merges", "predictions", "singletons", "singleton_violations",
        rate("blocking_misses", "true_pairs").alias("blocking_rate"), rate("model_misses", "candidate_positives").alias("model_rate"),
        rate("false_merges", "predictions").alias("false_merge_rate"), rate("singleton_violations", "singletons").alias("singleton_rate"),
    )


def score_distribution(scored: DataFrame, truth: DataFrame) -> DataFrame:
    """(label, n, mean, p10, p50, p90, p99, most) of the scores of true and other candidates."""
    at = lambda p, name: F.percentile("score", F.lit(p)).alias(name)
    return labelled(scored, truth).groupBy("label").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), at(0.1, "p10"), at(0.5, "p50"), at(0.9, "p90"), at(0.99, "p99"), F.max("score").alias("most"))


def calibration(scored: DataFrame, truth: DataFrame, edges: tuple[float, ...] = EDGES) -> DataFrame:
    """(low, high, n, positives, precision, mean_score) of half-open score buckets that hold any pair."""
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        inside = (F.col("score") >= a) & (F.col("score") < b)
        low, high = F.when(inside, a).otherwise(low), F.when(inside, b).otherwise(high)
    rows = labelled(scored, truth).withColumns({"low": low, "high": high}).where(F.col("low").isNotNull())
    return rows.groupBy("low", "high").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("positives"), F.avg(F.col("label").cast("double")).alias("precision"), F.avg("score").alias("mean_score"))


def worst_entities(predicted: DataFrame, truth: DataFrame, universe: DataFrame, n: int = 25) -> DataFrame:
    """The n entities of least F0.5; among equals those with more false merges first, then by name."""
    rows = per_entity(predicted, truth, universe).withColumn("false_merges", F.col("n_pred") - F.col("tp"))
    return rows.orderBy("f05", F.desc("false_merges"), "entity").limit(n)


def class_means(features: DataFrame, names: list[str]) -> DataFrame:
    """(label, <feature>...) means by label."""
    return features.groupBy("label").agg(*(F.avg(c).alias(c) for c in names))


def constant_features(features: DataFrame, names: list[str], least: float = 1e-9) -> DataFrame:
    """(feature, deviation) of features that hardly vary."""
    sums = features.agg(*(F.stddev_pop(c).alias(c) for c in names))
    return sums.select(F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("deviation")) for c in names))).alias("s")).select("s.*").where(F.col("deviation") < least)


def top_features(row_weights: DataFrame, n: int = 6) -> DataFrame:
    """(feature, weight): the n largest by absolute value."""
    return row_weights.orderBy(F.desc(F.abs("weight")), "feature").limit(n)
