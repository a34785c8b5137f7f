"""From records to decisions: candidates of either generation, features, models, thresholds, output."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config, Models
from ..operators import features as X
from ..operators import retrieval as R
from ..operators import select as S
from ..sources.sinks import load_index, save_index
from ..sources.workspace import kept
from . import metrics as M


def sides_of(source1: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Normalised records with positions ``pos`` as query side (q) and pool side (p)."""
    return source1.withColumnRenamed("pos", "q"), pool.withColumnRenamed("pos", "p")


def legacy_strategies(queries: DataFrame, pool: DataFrame, config: Config | None = None) -> dict[str, DataFrame]:
    """In-memory generation: strategy name to (q, p, score)."""
    c = (config or Config()).legacy
    found = {}
    if "exact_name" in c.enabled:
        found["exact_normalized"] = R.exact_key(queries, pool, "name_norm", c.exact_name_max_per_s1)
        found["exact_core"] = R.exact_key(queries, pool, "name_core", c.exact_name_max_per_s1)
    if "token_name" in c.enabled:
        found["token_name"] = R.token_name(queries, pool, c.token_name_max_per_s1, c.token_name_min_score)
    if "tfidf_name" in c.enabled:
        found["tfidf_name"] = R.char_name(queries, pool, c.tfidf_name_top_k, c.tfidf_name_min_score, (c.tfidf_name_ngram_min, c.tfidf_name_ngram_max))
    if "address_token" in c.enabled:
        found["address_token"] = R.token_address(queries, pool, c.address_token_max_per_s1, c.address_token_min_score)
    if "country_aware" in c.enabled:
        found["country_aware"] = R.country_aware(queries, pool, c.country_aware_top_k, c.country_aware_min_score, c.country_aware_min_pool_size, c.country_aware_fallback_top_k)
    return found


def legacy_candidates(queries: DataFrame, pool: DataFrame, config: Config | None = None) -> DataFrame:
    """(q, p, mask, score), capped."""
    c = config or Config()
    return S.capped_legacy(S.union_legacy(legacy_strategies(queries, pool, c)), c.legacy.max_candidates_per_s1, c.legacy.min_candidates_per_s1)


def indexes(pool: DataFrame, config: Config | None = None) -> tuple[R.ScaleIndex, R.ScaleIndex]:
    """The name and the address index of a pool."""
    c = (config or Config()).scale
    return R.ScaleIndex(pool, "name_core", R.C.NAME_STOP, c.min_df, c.max_df), R.ScaleIndex(pool, "addr_core", R.C.ADDRESS_STOP, c.min_df, c.max_df)


def saved_indexes(pool: DataFrame, path: str, config: Config | None = None, build: bool = False) -> tuple[R.ScaleIndex, R.ScaleIndex]:
    """The indexes stored at path, written there first if asked: nothing of the pool is tokenised when they are only read."""
    found = indexes(pool, config)
    for index, name in zip(found, ("name", "address"), strict=True):
        if build:
            save_index(index, f"{path}/{name}")
        load_index(pool.sparkSession, f"{path}/{name}", index)
    return found


def scale_strategies(queries: DataFrame, pool: DataFrame, config: Config | None = None, using: tuple[R.ScaleIndex, R.ScaleIndex] | None = None) -> dict[str, DataFrame]:
    """Indexed generation: strategy name to (q, p, score), or to (q, p, share) that the union adds up. using: indexes that are there already."""
    c = (config or Config()).scale
    name, address = using or indexes(pool, config)
    return {
        "exact_normalized": R.exact_key(queries, pool, "name_norm", c.exact_block_cap, least=1),
        "exact_core": R.exact_key(queries, pool, "name_core", c.exact_block_cap, least=1),
        "name_token": name.shares(queries, c.posting_budget_name, c.max_terms_per_query),
        "address_token": address.shares(queries, c.posting_budget_address, c.max_terms_per_query),
        "sorted_neighbourhood": R.sorted_neighbourhood(queries, pool, c.sn_min_ratio, prefix=c.sn_prefix_bytes, window=c.sn_window),
        "country_token": R.country_prior(queries, pool, c.country_top_k),
    }


def scale_candidates(queries: DataFrame, pool: DataFrame, config: Config | None = None, cap: int | None = None, using: tuple[R.ScaleIndex, R.ScaleIndex] | None = None) -> DataFrame:
    """(q, p, mask, rule_score, content_score, rank): ranked, and capped unless cap is 0."""
    c = config or Config()
    rows = S.ranked(S.union_scale(scale_strategies(queries, pool, c, using)))
    cap = c.scale.max_candidates_per_s1 if cap is None else cap
    return rows if cap <= 0 else rows.where(F.col("rank") < max(cap, c.scale.min_candidates_per_s1))


def with_ids(candidates: DataFrame, queries: DataFrame, pool: DataFrame) -> DataFrame:
    """Adds entity and match_id to candidates (q, p)."""
    return candidates.join(queries.select("q", F.col("entity_id").alias("entity")), "q").join(pool.select("p", F.col("entity_id").alias("match_id")), "p")


def folds(entities: DataFrame, k: int, seed: int = 42, key: str = "entity") -> DataFrame:
    """Adds fold, 0 .. k - 1: a hash of the entity, so that all its pairs are on one side."""
    return entities.withColumn("fold", F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(k)).cast("int"))


def training_sample(labelled: DataFrame, negatives: int = 5, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """All positives, the best ``negatives`` others of each query, and a hashed fraction of the rest."""
    from pyspark.sql import Window

    order = Window.partitionBy("q", "label").orderBy(F.desc("rank_score"), "p")
    rows = labelled.withColumn("__at", F.row_number().over(order))
    drawn = F.pmod(F.xxhash64("q", "p", F.lit(seed)), F.lit(1_000_000)) < int(fraction * 1_000_000)
    return rows.where((F.col("label") == 1) | (F.col("__at") <= negatives) | drawn).drop("__at")


def estimator(name: str, m: Models) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(X.FEATURES), outputCol="raw_x")]
    common = {"labelCol": "label", "weightCol": "weight"}
    if name == "logistic_regression":
        stages += [StandardScaler(inputCol="raw_x", outputCol="x", withMean=True), LogisticRegression(featuresCol="x", maxIter=m.max_iter, regParam=1e-3, **common)]
    elif name == "random_forest":
        stages.append(RandomForestClassifier(featuresCol="raw_x", numTrees=m.trees, maxDepth=m.depth, seed=m.seed, **common))
    elif name == "gradient_boosting":
        stages.append(GBTClassifier(featuresCol="raw_x", maxIter=m.boosting_rounds, seed=m.seed, **common))
    else:
        raise ValueError(name)
    return Pipeline(stages=stages)


def weighted(labelled: DataFrame) -> DataFrame:
    """Adds weight: both classes weigh the same."""
    sums = labelled.agg(F.count("*").alias("__n"), F.sum("label").alias("__pos"))
    share = F.when(F.col("label") == 1, F.col("__n") / (2 * F.col("__pos"))).otherwise(F.col("__n") / (2 * (F.col("__n") - F.col("__pos"))))
    return labelled.crossJoin(F.broadcast(sums)).withColumn("weight", F.coalesce(share, F.lit(1.0))).drop("__n", "__pos")


def scored(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds score, the probability of a match."""
    out = model.transform(rows)
    return out.withColumn("score", vector_to_array("probability")[1]).drop("raw_x", "x", "rawPrediction", "probability", "prediction")


@dataclass
class Validation:
    """Scores out of fold, the best threshold and its measures, by model; winner: the best by F0.5, then precision."""

    scores: dict[str, DataFrame]
    points: dict[str, dict]
    winner: str

    def report(self, truth: DataFrame, universe: DataFrame, model: PipelineModel | None = None, folds_: int = 4, seed: int = 42) -> dict:
        """Models from the best down with their measures, F0.5 of every fold of entities at the winner's pooled threshold, and a fitted winner's importances."""
        order = sorted(self.points, key=lambda n: (-self.points[n]["f05"], -self.points[n]["macro_precision"]))
        each = M.per_entity(M.decided(self.scores[self.winner], self.threshold), truth, universe)
        by_fold = folds(each, folds_, seed).groupBy("fold").agg(F.avg("f05").alias("f05")).orderBy("fold").collect()
        return {"winner": self.winner, "threshold": self.threshold, "models": [{"name": n, **self.points[n]} for n in order], "folds": {r.fold: r.f05 for r in by_fold}, "importances": importances(model) if model else []}

    @property
    def threshold(self) -> float:
        return self.points[self.winner]["threshold"]


def thresholds_of(told: DataFrame, truth: DataFrame, universe: DataFrame, config: Config) -> dict:
    """The best threshold of a grid and, if asked, of the scores themselves, among those of enough macro precision; of all if none has it."""
    t = config.thresholds
    measures = ("threshold", "f05", "macro_precision", "macro_recall", "n_predicted", "tp")
    points = M.sweep(told, truth, universe, M.grid(told.sparkSession, t.grid_start, t.grid_stop, t.grid_step)).select(*measures)
    if t.use_score_breakpoints:
        points = points.unionByName(M.breakpoints(told, truth, universe, t.max_breakpoints).select(*measures))
    points = kept(points, "points")
    precise = points.where(F.col("macro_precision") >= t.min_macro_precision)
    return M.best(points if precise.isEmpty() else precise).first().asDict()


def cross_validate(rows: DataFrame, truth: DataFrame, universe: DataFrame, config: Config | None = None) -> Validation:
    """rows (entity, match_id, label, features): every model is scored on folds of entities that it has not seen."""
    config = config or Config()
    m = config.models
    rows = folds(rows, m.n_splits, m.seed)
    scores, points = {}, {}
    for name in m.candidates:
        parts = None
        for k in range(m.n_splits):
            model = estimator(name, m).fit(weighted(rows.where(F.col("fold") != k)))
            part = scored(model, rows.where(F.col("fold") == k)).select("entity", "match_id", "fold", "score")
            parts = part if parts is None else parts.unionByName(part)
        scores[name] = parts = kept(parts, "out-of-fold")
        points[name] = thresholds_of(parts, truth, universe, config)
    winner = max(m.candidates, key=lambda n: (points[n]["f05"], points[n]["macro_precision"]))
    return Validation(scores, points, winner)


def train(rows: DataFrame, truth: DataFrame, universe: DataFrame, config: Config | None = None) -> tuple[PipelineModel, float, Validation]:
    """The winner of cross-validation, fitted on everything, and its threshold."""
    config = config or Config()
    validation = cross_validate(rows, truth, universe, config)
    return estimator(validation.winner, config.models).fit(weighted(rows)), validation.threshold, validation


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    """(feature, weight) of a fitted model, the largest first."""
    last = model.stages[-1]
    weights = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    return sorted(zip(X.FEATURES, map(float, weights.toArray()), strict=True), key=lambda f: -abs(f[1]))


def save_bundle(spark: SparkSession, model: PipelineModel, threshold: float, path: str) -> None:
    from ..sources.store import write_manifest

    model.write().overwrite().save(f"{path}/model")
    write_manifest(spark, path, "bundle", {"threshold": threshold, "features": list(X.FEATURES)})


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, float]:
    """The model and threshold; features other than this package's are an error."""
    from ..sources.store import required

    facts = required(spark, path, "bundle")
    if facts["features"] != list(X.FEATURES):
        raise ValueError("the model was trained on other features: " + json.dumps(facts["features"]))
    return PipelineModel.load(f"{path}/model"), facts["threshold"]


def featured(candidates: DataFrame, queries: DataFrame, pool: DataFrame) -> DataFrame:
    """Candidates with ids and 62 features; fails on a feature that is not finite."""
    told = kept(X.cosines(candidates, queries, pool), "cosines")
    return X.checked(X.pair_features(with_ids(told, queries, pool), queries, pool))


def infer(model: PipelineModel, threshold: float, queries: DataFrame, pool: DataFrame, config: Config | None = None) -> DataFrame:
    """(entity, match_id, score, matched) of every candidate."""
    rows = scored(model, featured(kept(legacy_candidates(queries, pool, config), "candidates"), queries, pool))
    return rows.select("entity", "match_id", "score", (F.col("score") >= threshold).alias("matched"))
