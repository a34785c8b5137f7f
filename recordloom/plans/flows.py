"""Whole runs: from a folder of record tables to a trained bundle, and from new records to a submission."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import Config
from ..operators import features as X
from ..sources import sinks, store, tables, truth
from ..sources.adapter import normalised
from ..sources.workspace import kept
from . import linkage


def positioned(df: DataFrame) -> DataFrame:
    """Adds pos, dense per source in the order of ids: a count per hashed range of ids, never one window over all."""
    dealt = kept(df.repartitionByRange("entity_id").withColumn("__part", F.spark_partition_id()), "records")
    inside = dealt.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy("entity_id")) - 1)
    parts = dealt.groupBy("__part").agg(F.count("*").alias("n")).agg(F.array_sort(F.collect_list(F.struct("__part", "n"))).alias("parts"))
    before = F.aggregate(F.filter("parts", lambda x: x["__part"] < F.col("__part")), F.lit(0).cast("long"), lambda s, x: s + x["n"])
    return inside.crossJoin(F.broadcast(parts)).withColumn("pos", (before + F.col("__at")).cast("long")).drop("__part", "__at", "parts")


def sides(spark: SparkSession, folder: str, split: str) -> tuple[DataFrame, DataFrame]:
    """Normalised records of a split as query side (q) and pool side (p)."""
    found = tables.load_split(spark, folder, split)
    return linkage.sides_of(kept(normalised(positioned(found.source1)), "q"), kept(normalised(positioned(found.pool())), "p"))


def train(spark: SparkSession, folder: str, truth_file: str, out: str, config: Config | None = None) -> dict:
    """Fit on the split ``train`` of folder; writes the bundle, the scores of all candidates and the report under out, and gives the report."""
    config = config or Config()
    queries, pool = sides(spark, folder, "train")
    universe = queries.select(F.col("entity_id").alias("entity"))
    pairs = kept(truth.load(spark, truth_file, universe)[0], "truth")
    rows = linkage.featured(kept(linkage.legacy_candidates(queries, pool, config), "candidates"), queries, pool)
    told = X.labelled(rows.withColumnRenamed("entity", "s1_id"), pairs.withColumnRenamed("entity", "s1_id")).withColumnRenamed("s1_id", "entity")
    told = kept(told, "labelled")
    model, threshold, validation = linkage.train(told, pairs, universe, config)
    linkage.save_bundle(spark, model, threshold, out)
    sinks.write_scores(linkage.scored(model, told), f"{out}/scores")
    report = validation.report(pairs, universe, model, config.models.n_splits, config.models.seed)
    store.write_manifest(spark, out, "report", report)
    return report


def infer(spark: SparkSession, folder: str, split: str, bundle: str, out: str, config: Config | None = None) -> DataFrame:
    """Matches of a split by a bundle; writes results, candidate pairs and scores under out and gives the problems of the submission, none if all counts are 0."""
    queries, pool = sides(spark, folder, split)
    universe = queries.select(F.col("entity_id").alias("entity"))
    rows = kept(linkage.infer(*linkage.load_bundle(spark, bundle), queries, pool, config), "scored")
    results = sinks.matching_results(rows.where("matched"), universe)
    sinks.write_tsv(results, f"{out}/matching_results")
    sinks.write_tsv(sinks.candidate_pairs(rows, universe), f"{out}/candidate_pairs")
    sinks.write_scores(rows, f"{out}/scores")
    return sinks.submission_problems(results, rows, universe, pool)
