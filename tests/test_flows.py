from __future__ import annotations

import json

from pyspark.sql import functions as F

from recordloom.config import Config
from recordloom.functions.text import load_aliases, normalize_country
from recordloom.plans import flows, linkage
from recordloom.sources import sinks, store, synthetic
from recordloom.sources.workspace import kept


def test_from_tables_to_a_submission(spark, tmp_path):
    s1, s2, s3, wide = synthetic.frames(spark, synthetic.build(40, 30, 7))
    for split in ("train", "test"):
        for k, df in enumerate((s1, s2, s3), 1):
            df.toPandas().to_csv(tmp_path / f"{split}_source{k}.tsv", sep="\t", index=False)
    wide.toPandas().to_csv(tmp_path / "truth.tsv", sep="\t", index=False)
    config = Config.load(overrides={"models.candidates": "logistic_regression", "models.n_splits": 2, "models.max_iter": 15, "thresholds.min_macro_precision": 0.2})
    out = f"file://{tmp_path}/out"
    report = flows.train(spark, str(tmp_path), f"file://{tmp_path}/truth.tsv", out, config)
    assert report["winner"] == "logistic_regression" and set(report["folds"]) == {0, 1} and len(report["importances"]) == 62
    assert report["models"][0]["macro_precision"] >= 0.2 and store.read_manifest(spark, out, "report")["threshold"] == report["threshold"]
    scores = spark.read.option("sep", "\t").option("header", True).csv(f"{out}/scores")
    assert scores.columns == ["source1_id", "candidate_id", "score", "candidate_source"] and scores.where("score is null").count() == 0
    problems = {r.problem: r.n for r in flows.infer(spark, str(tmp_path), "test", out, f"{out}/test", config).collect()}
    assert not any(problems.values())
    assert spark.read.option("sep", "\t").option("header", True).csv(f"{out}/test/matching_results").count() == 40


def test_positions_are_dense(spark):
    df = spark.createDataFrame([(f"S1-{i:03d}",) for i in range(100)], "entity_id string").repartition(5)
    rows = flows.positioned(df).orderBy("entity_id").collect()
    assert [r.pos for r in rows] == list(range(100))


def test_saved_indexes_give_what_built_ones_give(spark, tmp_path):
    s1, s2, *_ = synthetic.frames(spark, synthetic.build(30, 20, 3))
    queries, pool = linkage.sides_of(*(kept(flows.normalised(flows.positioned(df)), "n") for df in (s1, s2)))
    path = f"file://{tmp_path}/index"
    linkage.saved_indexes(pool, path, build=True)
    rows = lambda **o: sorted(map(str, linkage.scale_candidates(queries, pool, cap=0, **o).collect()))
    assert rows() == rows(using=linkage.saved_indexes(pool, path))


def test_scores_and_aliases(spark, tmp_path):
    sinks.write_scores(spark.createDataFrame([("S1-1", "S3-2", 0.5)], "entity string, match_id string, score double"), f"file://{tmp_path}/s")
    assert spark.read.option("sep", "\t").option("header", True).csv(f"file://{tmp_path}/s").first()["candidate_source"] == "S3"
    (tmp_path / "a.json").write_text(json.dumps({"U.S.A.": "us", "Deutschland": "de"}))
    aliases = load_aliases(spark, f"file://{tmp_path}/a.json")
    assert aliases == {"u s a": "us", "deutschland": "de"}
    df = spark.createDataFrame([("u.s.a",), ("DEUTSCHLAND ",), ("fr",)], "c string")
    assert [r[0] for r in df.select(normalize_country(F.col("c"), aliases)).collect()] == ["us", "de", "fr"]
