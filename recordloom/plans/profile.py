"""Profiles and checks of record tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import present

ID_FORMAT = r"^S[123]-[0-9]+$"


def _blank(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, coverage): the share of values that are not empty."""
    sums = df.agg(*(F.avg((~_blank(c)).cast("double")).alias(c) for c in columns))
    return sums.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0.0)).alias("coverage")) for c in columns))).alias("s")).select("s.*")


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_rows, nulls, null_fraction, blanks, n_distinct) in one pass."""
    sums = df.agg(F.count("*").alias("n"), *(x for c in columns for x in (F.count_if(F.col(c).isNull()).alias(f"n_{c}"), F.count_if(F.col(c).isNotNull() & _blank(c)).alias(f"b_{c}"), F.count_distinct(c).alias(f"d_{c}"))))
    each = (F.struct(F.lit(c).alias("column"), F.col("n").alias("n_rows"), F.col(f"n_{c}").alias("nulls"), F.coalesce(F.try_divide(F.col(f"n_{c}").cast("double"), F.col("n")), F.lit(0.0)).alias("null_fraction"), F.col(f"b_{c}").alias("blanks"), F.col(f"d_{c}").alias("n_distinct")) for c in columns)
    return sums.select(F.explode(F.array(*each)).alias("s")).select("s.*")


def length_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, shortest, p25, median, mean, p75, p95, p99, longest) of value lengths, nulls left out."""
    stacked = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.length(c).alias("len")) for c in columns))).alias("s")).select("s.*").where("len is not null")
    at = lambda p, name: F.percentile("len", F.lit(p)).alias(name)
    return stacked.groupBy("column").agg(F.min("len").alias("shortest"), at(0.25, "p25"), at(0.5, "median"), F.avg("len").alias("mean"), at(0.75, "p75"), at(0.95, "p95"), at(0.99, "p99"), F.max("len").alias("longest"))


def id_report(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """One row: rows in groups of repeated ids, rows after an id's first, ids of an odd format, null ids."""
    groups = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    sums = groups.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("rows_of_repeated_ids"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"), F.coalesce(F.sum(F.when(~F.col(key).rlike(ID_FORMAT), F.col("n"))), F.lit(0)).alias("odd_ids"))
    return sums.crossJoin(df.agg(F.count_if(F.col(key).isNull()).alias("null_ids")))


def prefix_counts(df: DataFrame, key: str = "entity_id") -> DataFrame:
    """(prefix, n): rows by what stands before an id's number."""
    return df.groupBy(F.regexp_extract(F.coalesce(F.col(key), F.lit("")), r"^([^-]*)-", 1).alias("prefix")).agg(F.count("*").alias("n"))


def value_counts(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or []), column).agg(F.count("*").alias("n"))


def unseen(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Values of a that b does not have."""
    return a.select(column).distinct().exceptAll(b.select(column).distinct())


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: groups of rows equal in keys, and rows beyond each group's first."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return groups.agg(F.count("*").alias("groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats"))


def most_common(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent value (the first of equals) and its count."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(1)


def warnings(df: DataFrame, required: tuple[str, ...] = ("entity_id", "business_name"), optional: tuple[str, ...] = ("business_address", "country")) -> DataFrame:
    """(check, n): null ids, ids after their first, and empty values of each column."""
    repeats = df.where(F.col("entity_id").isNotNull()).groupBy("entity_id").agg((F.count("*") - 1).alias("r")).agg(F.coalesce(F.sum("r"), F.lit(0)).alias("duplicate_ids"))
    columns = [c for c in (*required, *optional) if c in df.columns and c != "entity_id"]
    sums = df.agg(F.count_if(F.col("entity_id").isNull()).alias("null_ids"), *(F.count_if(_blank(c)).alias(f"empty_{c}") for c in columns)).crossJoin(repeats)
    return sums.select(F.explode(F.array(*(F.struct(F.lit(c).alias("check"), F.col(c).alias("n")) for c in sums.columns))).alias("s")).select("s.*")


def shared_ids(a: DataFrame, b: DataFrame, key: str = "entity_id") -> DataFrame:
    """Ids that both tables have."""
    return a.select(key).intersect(b.select(key))


def cardinalities(truth: DataFrame, universe: DataFrame) -> DataFrame:
    """(n_matches, entities), entities without matches included."""
    sizes = universe.select("entity").distinct().join(truth.select("entity", "match_id").distinct().groupBy("entity").agg(F.count("*").alias("n")), "entity", "left")
    return sizes.groupBy(F.coalesce("n", F.lit(0)).alias("n_matches")).agg(F.count("*").alias("entities"))


def cardinality_summary(truth: DataFrame, universe: DataFrame) -> DataFrame:
    """One row: entities, pairs, singletons, and quantiles of matches per entity."""
    sizes = universe.select("entity").distinct().join(truth.select("entity", "match_id").distinct().groupBy("entity").agg(F.count("*").alias("n")), "entity", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    at = lambda p, name: F.percentile("n", F.lit(p)).alias(name)
    return sizes.agg(F.count("*").alias("entities"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("pairs"), F.count_if(F.col("n") == 0).alias("singletons"), at(0.25, "p25"), at(0.5, "p50"), at(0.75, "p75"), at(0.9, "p90"), at(0.99, "p99"))


def frequent_blocks(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The n largest groups of a key with their size: where skew will come from."""
    return df.where(present(F.col(key)) != "").groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def running_share(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """frequent_blocks with the share of rows that each and all larger ones hold."""
    total = df.agg(F.count("*").alias("total"))
    return frequent_blocks(df, key, n).crossJoin(F.broadcast(total)).withColumn("share", F.sum("n").over(Window.orderBy(F.desc("n"), key)) / F.col("total")).drop("total")
