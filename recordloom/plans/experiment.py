"""Measuring selections: one uncapped, ranked pass, on which every configuration is decided at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import select as S
from . import recall

#: Configurations whose quotas are measured: name to (cap, mode).
ADAPTIVE = {"D": (100, "rank"), "D2": (100, "union")}


def measured(candidates: DataFrame, truth: DataFrame, known: DataFrame, configurations: list[S.Selection], adaptive: dict[str, tuple[int, str]] | None = None) -> DataFrame:
    """(name, cap, candidates, query_recall, pair_recall, all_pairs_recall) of each configuration over ranked candidates with ids.

    All configurations are columns of one pass over the candidates; a pair of the truth then meets its
    candidate once, by position if the truth has positions. known: (match_id) that the pool has; pairs without leave the recall of pairs.
    """
    rows = S.decided(candidates, {f"__c{i}": how for i, how in enumerate(configurations)})
    named = [(how.name, how.cap, f"__c{i}") for i, how in enumerate(configurations)]
    yields = recall.attribution(truth, candidates) if adaptive else None
    for name, (cap, mode) in (adaptive or {}).items():
        rows = S.adaptive(rows, yields, cap, mode, f"__{name}")
        named.append((name, cap, f"__{name}"))
    kept = [c for _, _, c in named]
    counts = rows.agg(*(F.count_if(c).alias(c) for c in kept))
    by = recall.keys(truth)
    pairs = truth.select(*dict.fromkeys([*recall.PAIR, *by])).distinct().join(known.select("match_id").distinct().withColumn("__known", F.lit(1)), "match_id", "left")
    met = pairs.join(rows.select(*by, *kept), by, "left")
    each = met.groupBy("entity").agg(F.count("__known").alias("__pairs"), *(F.count_if(F.col("__known").isNotNull() & F.col(c)).alias(c) for c in kept))
    sums = each.agg(
        F.count("*").alias("labelled"),
        F.sum("__pairs").alias("pairs"),
        *(x for c in kept for x in (F.sum(c).alias(f"{c}_found"), F.count_if(F.col(c) > 0).alias(f"{c}_any"), F.count_if((F.col("__pairs") > 0) & (F.col(c) == F.col("__pairs"))).alias(f"{c}_whole"))),
    )
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    told = F.array(
        *(
            F.struct(F.lit(name).alias("name"), F.lit(cap).alias("cap"), F.col(c).alias("candidates"), share(f"{c}_any", "labelled").alias("query_recall"), share(f"{c}_found", "pairs").alias("pair_recall"), share(f"{c}_whole", "labelled").alias("all_pairs_recall"))
            for name, cap, c in named
        )
    )
    return sums.crossJoin(F.broadcast(counts)).select(F.explode(told).alias("s")).select("s.*")
