from __future__ import annotations

import shutil
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from recordloom import oracle
from recordloom import queries as core

ROOT = Path(__file__).parent.parent
DATA = Path("/root/testdata/sf0.001")
#: Without SQL: edit ratios and models.
ROWS_ONLY = {"pair_features", "entity_folds", "train_score_lr"}
SAMPLE = ("scan_profile", "normalize_name_core", "normalize_address", "address_components", "truth_pairs", "block_country_aware", "block_char_tfidf", "gather_budgeted", "quota_union", "candidate_recall", "features_native", "features_cosine", "breakpoint_sweep", "submission_checks", "union_scale_all", "adaptive_quota", "configuration_recall", "features_token_set", "best_threshold")


def test_every_query_has_sql_or_a_reason():
    assert set(core.queries()) - set(oracle.oracle_sql()) == ROWS_ONLY
    assert set(oracle.oracle_sql()) <= set(core.queries())


def plain(v):
    if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool):
        return f"{float(v):.9g}"
    return str(v)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in DATA.iterdir():
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, tables, name):
    got = core.queries()[name](spark, str(DATA))
    cur = tables.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(got.columns)
    want = [tuple(plain(v) for v in r) for r in cur.fetchall()]
    assert sorted(tuple(plain(v) for v in r) for r in got.select(*(f"`{c}`" for c in columns)).collect()) == sorted(want)


def test_entry_runs(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["q", "p", "mask", "rule_score", "content_score", "rank"] and df.count() > 0


def test_rest_works_without_the_training_data_subpackage(tmp_path):
    shutil.copytree(ROOT / "recordloom", tmp_path / "recordloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 90 and not [k for k in q if k[:2] == 'op' and k[2].isdigit() or k == 'pipeline']; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
