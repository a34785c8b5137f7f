from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from recordloom.config import Config
from recordloom.operators.retrieval import resolve_ids
from recordloom.sources import sinks, store, synthetic, tables, truth


def test_tsv_headers_nulls_and_discovery(spark, tmp_path):
    (tmp_path / "train_source1.tsv").write_text('ID\tCompany_Name\tname\tnation\textra\n007 \tA "B\tx\tNA\t1\nS1-2\tnull\ty\tus\t\n')
    assert tables.find_file(tmp_path, "source1.tsv").name == "train_source1.tsv"
    with pytest.raises(FileNotFoundError):
        tables.find_file(tmp_path, "nothing.tsv")
    df = tables.read_tsv(spark, str(tmp_path / "train_source1.tsv"))
    assert df.columns == ["entity_id", "business_name", "name", "country", "extra"]
    assert [tuple(r) for r in df.orderBy("entity_id").collect()] == [("007", 'A "B', "x", None, "1"), ("S1-2", None, "y", "us", None)]
    text = tables.read_tsv(spark, str(tmp_path / "train_source1.tsv"), nulls=False, keep_unknown=False, columns=("entity_id", "country"), limit=1)
    assert [tuple(r) for r in text.collect()] == [("007", "NA")]
    assert tables.validated(df).columns[-1] == "business_address"
    with pytest.raises(tables.SchemaError):
        tables.validated(df.drop("entity_id"))
    with pytest.raises(ValueError, match="repeated"):
        tables.pool_of(df, df)


def test_truth_forms(spark):
    wide = spark.createDataFrame([("S1-1", "S2-1, S3-2;S2-9"), ("S1-2", ""), ("S1-3", "nan"), ("S1-4", None)], "s1_id string, matches string")
    assert {tuple(r) for r in truth.parse(wide).collect()} == {("S1-1", "S2-1"), ("S1-1", "S3-2"), ("S1-1", "S2-9")}
    long = spark.createDataFrame([("a", "x", 1), ("a", "y", 0), ("a", "x", 1)], "source1 string, match_id string, label int")
    assert [tuple(r) for r in truth.parse(long).collect()] == [("a", "x")]
    universe = wide.select(F.col("s1_id").alias("entity"))
    back = {r.source1_id: r.matched_entity_ids for r in truth.wide(truth.parse(wide), universe).collect()}
    assert back == {"S1-1": "S2-1,S2-9,S3-2", "S1-2": "", "S1-3": "", "S1-4": ""}
    with pytest.raises(ValueError):
        truth.parse(wide.select("matches"))


def test_store_round_trip(spark, tmp_path):
    rows = [(f"S2-{i:06d}", f"Firm Number {i} Holdings", f"{i} Example Street, Testville", "US" if i % 2 else "India") for i in range(250)]
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string").repartition(5)
    path = f"file://{tmp_path}/s2"
    assert store.write(df, path, rows_per_file=60)["rows"] == 250
    got = store.read(spark, path)
    assert got.columns == list(store.STORED)
    assert sorted(r.rowid for r in got.select("rowid").collect()) == list(range(250))
    assert store.is_current(spark, path, "store", {"rows": 250}) and not store.is_current(spark, path, "store", {"rows": 1})
    with pytest.raises(FileNotFoundError):
        store.required(spark, path, "index")
    assert store.read_range(got, -3, 7).count() == 7 and store.read_range(got, 245, 999).count() == 5
    asked = spark.createDataFrame([(0, 9), (1, 200), (2, 9), (3, 999)], "at int, rowid int")
    found = store.gather(got, asked).orderBy("at").collect()
    assert found[0].entity_id == found[2].entity_id and found[3].entity_id is None
    both = store.pool(got, got)
    assert both.agg(F.max("rowid"), F.countDistinct("rowid")).first() == (499, 500)
    ids = resolve_ids(spark.createDataFrame([("S2-000001",), ("nobody",)], "entity_id string"), got.withColumnRenamed("rowid", "pos"))
    assert {r.entity_id: r.pos >= 0 for r in ids.collect()} == {"S2-000001": True, "nobody": False}


def test_sinks(spark, tmp_path):
    cands = spark.createDataFrame([(1, 2, 4, 10.0, 0.5)], "q long, p long, mask int, rule_score double, content_score double")
    sinks.write_candidates(cands, f"{tmp_path}/c")
    assert [tuple(r) for r in sinks.read_candidates(spark, f"{tmp_path}/c").collect()] == [(1, 2, 4, 10.0, 0.5)]
    universe = spark.createDataFrame([("a",), ("b",)], "entity string")
    pairs = spark.createDataFrame([("a", "m2"), ("a", "m1")], "entity string, match_id string")
    results = sinks.matching_results(pairs, universe)
    assert {tuple(r) for r in results.collect()} == {("a", "m1,m2"), ("b", "")}
    pool = spark.createDataFrame([("m1",), ("m2",)], "entity_id string")
    sinks.raise_if_invalid(sinks.submission_problems(results, pairs, universe, pool))
    with pytest.raises(ValueError, match="matches_without_candidate"):
        sinks.raise_if_invalid(sinks.submission_problems(results, pairs.limit(1), universe, pool))
    sinks.write_tsv(results, f"{tmp_path}/out")
    assert tables.read_tsv(spark, f"{tmp_path}/out", nulls=False, aliases={}).count() == 2


def test_generator_and_config(tmp_path):
    made = synthetic.build(200, 100, 7)
    assert made == synthetic.build(200, 100, 7) and len(made.source1) == len(made.truth) == 200
    ids = {r[0] for r in (*made.source2, *made.source3)}
    assert all(m in ids for _, ms in made.truth for m in ms.split(",") if m)
    config = Config.load(overrides={"scale.max_df": "9", "models.candidates": "random_forest"})
    config.dump(tmp_path / "c.json")
    assert Config.load(tmp_path / "c.json") == config and config.scale.max_df == 9 and config.models.candidates == ("random_forest",)
    with pytest.raises(KeyError):
        Config.load(overrides={"scale.nothing": 1})
