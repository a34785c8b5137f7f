"""Bounded, repeatable samples of labelled rows to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled rows that a classifier is fitted on: those with the least hashes of their ids.
FIT_ROWS = 20_000


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(label int, text) of up to ``rows`` labelled documents; learn: which ids labels may be learnt from.

    Null ids and null labels are left out; an id that labels repeat counts once, with its largest label.
    The ids alone are ordered and broadcast (``rows`` longs at most); texts stay where they are read.
    """
    chosen = labels.where(learn & F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("__id"), "__id").limit(rows)
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("label", "text")
