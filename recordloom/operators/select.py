"""Union, ranking, caps and quotas of candidates.

Strategies are named DataFrames of (q, p, score), or of (q, p, share) whose sum over a pair's rows is its score.
A union has one row per pair: (q, p, mask, ...).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as C
from .retrieval import DIGITS

EXACT = ("exact_normalized", "exact_core")


def _stacked(found: dict[str, DataFrame], bits: dict[str, int]) -> DataFrame:
    parts = [df.select("q", "p", F.col("share" if "share" in df.columns else "score").cast("double").alias("score"), F.lit(bits[name]).alias("bit")) for name, df in found.items()]
    return reduce(DataFrame.unionByName, parts).repartition("q")  # for the pairs and for their ranks


def has(strategy: str, bits: dict[str, int] = C.SCALE_BITS) -> Column:
    return F.col("mask").bitwiseAND(bits[strategy]) != 0


def strategy_names(mask: Column, bits: dict[str, int] = C.SCALE_BITS, order: tuple[str, ...] = C.REPORT_ORDER) -> Column:
    """The names in a mask, in the order of reports."""
    return F.filter(F.array(*(F.when(mask.bitwiseAND(bits[s]) != 0, s) for s in order)), lambda s: s.isNotNull())


def union_legacy(found: dict[str, DataFrame]) -> DataFrame:
    """In-memory generation: (q, p, mask, score) with the best score of any strategy."""
    return _stacked(found, C.LEGACY_BITS).groupBy("q", "p").agg(F.bit_or("bit").alias("mask"), F.max("score").alias("score"))


def union_scale(found: dict[str, DataFrame]) -> DataFrame:
    """Indexed generation: (q, p, mask, rule_score, content_score); the rule score adds the weights of the strategies that agree."""
    summed = [C.SCALE_BITS[name] for name, df in found.items() if "share" in df.columns]
    scores = [F.max(F.when(~F.col("bit").isin(summed), F.col("score"))), F.lit(None).cast("double"), *(F.sum(F.when(F.col("bit") == b, F.col("score"))) for b in summed)]
    both = _stacked(found, C.SCALE_BITS).groupBy("q", "p").agg(F.bit_or("bit").alias("mask"), F.greatest(*scores).alias("content_score"))
    rule = sum((F.when(has(s), w).otherwise(0.0) for s, w in C.STRATEGY_WEIGHTS.items()), F.lit(0.0))
    return both.select("q", "p", "mask", rule.alias("rule_score"), "content_score")


def _legacy_order() -> list[Column]:
    return [F.desc(F.round("score", DIGITS)), F.col("p")]


def _scale_order() -> list[Column]:
    return [F.desc("rule_score"), F.desc(F.round("content_score", DIGITS)), F.col("p")]


def ranked(candidates: DataFrame) -> DataFrame:
    """Adds rank, from 0, of the indexed generation's order."""
    return candidates.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*_scale_order())) - 1)


def capped_legacy(candidates: DataFrame, cap: int | None = 400, least: int = 5) -> DataFrame:
    """The cap best of each query with more than max(cap, least) candidates; None: all."""
    if cap is None:
        return candidates
    window = Window.partitionBy("q")
    counted = candidates.withColumn("__n", F.count("*").over(window)).withColumn("__rank", F.row_number().over(window.orderBy(*_legacy_order())))
    return counted.where((F.col("__n") <= max(cap, least)) | (F.col("__rank") <= cap)).drop("__n", "__rank")


def capped_scale(candidates: DataFrame, cap: int = 100, least: int = 3) -> DataFrame:
    """The max(cap, least) best of each query; a cap of zero keeps all."""
    return candidates if cap <= 0 else ranked(candidates).where(F.col("rank") < max(cap, least)).drop("rank")


@dataclass(frozen=True)
class Selection:
    """A configuration: cap, quotas per strategy, strategies that alone do not count, and when the cap applies."""

    name: str = ""
    cap: int = 100
    quotas: dict[str, int] = field(default_factory=dict)
    exclude_only: tuple[str, ...] = ()
    mode: str = "rank"
    always: tuple[str, ...] = EXACT


def _bits(names: tuple[str, ...]) -> int:
    return sum(C.SCALE_BITS.get(n, 0) for n in set(names))


@dataclass(frozen=True)
class _Rule:
    """A selection as column expressions: quotas may be measured values of the row instead of constants."""

    cap: int
    union: bool
    quotas: dict[str, Column]
    quoted: Column
    excluded: Column
    always: tuple[str, ...]


def _rule(how: Selection) -> _Rule:
    quotas = {s: F.lit(q) for s, q in how.quotas.items() if q > 0 and s in C.SCALE_BITS}
    return _Rule(how.cap, how.mode == "union", quotas, F.lit(bool(how.quotas)), F.lit(_bits(how.exclude_only)), how.always)


def decided(candidates: DataFrame, rules: dict[str, Selection | _Rule]) -> DataFrame:
    """Adds a boolean column per rule: whether it keeps the candidate (q, rank, mask, ...). One pass decides all rules.

    Exclusion drops rows that only excluded strategies found, unless that leaves none of all queries: then
    everything stays. Quotas allow each strategy its best rows and the exact strategies all of theirs; if that
    allows none of all queries, all are allowed. The cap then goes by rank among what is left (union, or
    exclusion alone) or among all (rank). Fallbacks look at the whole query set, by one aggregated row;
    results do not depend on batches.
    """
    rules = {name: r if isinstance(r, _Rule) else _rule(r) for name, r in rules.items()}
    by_query = Window.partitionBy("q").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    every = sum(C.SCALE_BITS.values())
    columns = candidates.columns
    counted = [s for s in C.SCALE_BITS if any(s in r.quotas for r in rules.values())]
    rows = candidates.withColumns({f"__n_{s}": F.sum(has(s).cast("int")).over(by_query) for s in counted}) if counted else candidates
    flags = {}
    for name, r in rules.items():
        alone = (F.col("mask").bitwiseAND(r.excluded) != 0) & (F.col("mask").bitwiseAND(F.lit(every) - r.excluded) == 0)
        allowed = reduce(Column.__or__, (has(s) for s in r.always), F.lit(False))
        for s, quota in r.quotas.items():
            allowed = allowed | F.coalesce(has(s) & (F.col(f"__n_{s}") <= quota), F.lit(False))
        flags |= {f"__base_{name}": ~alone, f"__allowed_{name}": allowed | ~r.quoted}
    rows = rows.withColumns(flags)
    facts = rows.agg(*(f(c).alias(f"{c}_{k}") for c in flags for k, f in (("some", F.bool_or), ("all", F.bool_and))))
    rows = rows.crossJoin(F.broadcast(facts))
    rows = rows.withColumns({f"__keep_{n}": F.col(f"__base_{n}") & (F.col(f"__allowed_{n}") | ~F.col(f"__allowed_{n}_some")) for n in rules})
    rows = rows.withColumns({f"__left_{n}": F.sum(F.col(f"__keep_{n}").cast("int")).over(by_query) for n in rules})

    def kept(name: str, r: _Rule) -> Column:
        keep = F.col(f"__keep_{name}")
        if r.cap > 0:
            by_survivors = F.lit(r.union) | (~r.quoted & ~F.col(f"__base_{name}_all"))
            keep = keep & F.when(by_survivors, F.col(f"__left_{name}") <= r.cap).otherwise(F.col("rank") < r.cap)
        return keep | ~F.col(f"__base_{name}_some")

    return rows.select(*columns, *(kept(n, r).alias(n) for n, r in rules.items()))


def select(candidates: DataFrame, how: Selection) -> DataFrame:
    """Candidates (q, rank, mask, ...) that a configuration keeps; see decided. Without quotas and exclusions the rank alone counts."""
    if not how.quotas and not how.exclude_only:
        return candidates if how.cap <= 0 else candidates.where(F.col("rank") < how.cap)
    return decided(candidates, {"__kept": how}).where("__kept").drop("__kept")


def exact_hit() -> Column:
    """Whether the candidate's query has any candidate of an exact strategy."""
    return F.bool_or(F.col("mask").bitwiseAND(_bits(EXACT)) != 0).over(Window.partitionBy("q"))


def decided_adaptive(candidates: DataFrame, base: Selection | _Rule, exact: Selection | _Rule, name: str) -> DataFrame:
    """Adds a boolean column: by one of two rules, each decided over the whole query set; whether a query has an exact hit tells which."""
    rows = decided(candidates, {"__rest": base, "__hit": exact}).withColumn("__exact", exact_hit())
    return rows.select(*candidates.columns, F.when(F.col("__exact"), F.col("__hit")).otherwise(F.col("__rest")).alias(name))


def select_adaptive(candidates: DataFrame, base: Selection, exact: Selection) -> DataFrame:
    """The candidates that decided_adaptive keeps."""
    return decided_adaptive(candidates, base, exact, "__kept").where("__kept").drop("__kept")


#: What a recovered pair is worth beside one that a strategy alone found, and the least quota of a strategy with any worth.
CORROBORATION, FLOOR = 0.15, 4


def measured_quotas(yields: DataFrame, cap: int) -> DataFrame:
    """One row of quotas from yields (strategy, exclusive, recovered): __q_<strategy>, null without worth, and __drop, the bits of strategies without worth.

    Slots of the cap go in proportion to worth, exclusive pairs and a share of the recovered ones.
    """
    worth = F.col("exclusive") + CORROBORATION * F.col("recovered")
    total = yields.agg(F.sum(worth).alias("__total"))
    told = yields.crossJoin(F.broadcast(total)).withColumn("__quota", F.when(worth > 0, F.greatest(F.lit(FLOOR), F.bround(cap * worth / F.col("__total")).cast("int"))))
    return told.agg(
        *(F.max(F.when(F.col("strategy") == s, F.col("__quota"))).alias(f"__q_{s}") for s in C.SCALE_BITS),
        F.lit(sum(C.SCALE_BITS.values())).alias("__every"),
        F.coalesce(F.sum(F.when(F.col("__quota").isNotNull(), reduce(lambda out, s: F.when(F.col("strategy") == s[0], s[1]).otherwise(out), C.SCALE_BITS.items(), F.lit(0)))), F.lit(0)).cast("int").alias("__worth"),
    ).withColumn("__drop", F.col("__every") - F.col("__worth"))


def adaptive(candidates: DataFrame, yields: DataFrame, cap: int, mode: str, name: str) -> DataFrame:
    """Adds a boolean column: candidates kept under quotas measured from yields.

    Queries with an exact hit have their name answered: as many slots as the address has more than the name
    (FLOOR at least) go from names to addresses.
    """
    rows = candidates.crossJoin(F.broadcast(measured_quotas(yields, cap)))
    quotas = {s: F.col(f"__q_{s}") for s in C.SCALE_BITS}
    n, a = (F.coalesce(quotas[s], F.lit(0)) for s in ("name_token", "address_token"))
    shift = F.greatest(F.lit(FLOOR), a - n)
    moved = quotas | {"address_token": a + shift, "name_token": F.greatest(F.lit(FLOOR), n - shift)}
    base = _Rule(cap, mode == "union", quotas, F.col("__worth") > 0, F.col("__drop"), EXACT)
    exact = _Rule(cap, mode == "union", moved, F.lit(True), F.col("__drop"), EXACT)
    return decided_adaptive(rows, base, exact, name).select(*candidates.columns, name)


#: Caps of the sweep, and configurations by name.
CAP_SWEEP = (50, 100, 150, 200, 300, 500)
_NOTHING_ALONE = ("country_token", "exact_normalized")


def _named(name: str, cap: int, n: int, a: int, s: int, country: int = 0, exclude: tuple[str, ...] = _NOTHING_ALONE, mode: str = "union") -> Selection:
    quotas = {"name_token": n, "address_token": a, "sorted_neighbourhood": s} | ({"country_token": country} if country else {})
    return Selection(name, cap, quotas, exclude, mode)


CONFIGURATIONS = {
    c.name: c
    for c in (
        *(Selection(f"cap_{n}", n) for n in CAP_SWEEP),
        Selection("A", 100),
        Selection("B", 200),
        _named("C", 100, 50, 30, 20, 10, (), "rank"),
        Selection("E", 100, exclude_only=("country_token",)),
        Selection("F", 200, exclude_only=("country_token",)),
        _named("G", 100, 18, 56, 6, mode="rank"),
        _named("H", 200, 30, 100, 14, mode="rank"),
        _named("C2", 100, 50, 30, 20, 10, ()),
        _named("G2", 100, 18, 56, 6),
        _named("H2", 200, 30, 100, 14),
        _named("I2", 200, 20, 150, 20),
        _named("J2", 200, 10, 170, 20),
        _named("K2", 150, 10, 120, 20),
        _named("L2", 250, 20, 200, 30),
        _named("M2", 200, 100, 70, 30),
    )
}
