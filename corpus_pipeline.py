"""From raw documents to packed training sequences: five stages, each an operator of ``recordloom.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import decontaminate, packing, quality, simhash, suffix_dedup
from recordloom.llm.common import table, written
from recordloom.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one row stays, that of the least id."""
    return simhash.one_per_component(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their passages of 200 bytes or more that repeat; documents of which nothing is left go."""
    return suffix_dedup.without_repeats(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with enough of the benchmark's windows go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL has neither the classifier nor XXH64 nor the tokens; a brute-force version tests the pipeline instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
