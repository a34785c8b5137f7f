"""Candidates for a stream of source 1 records against a static pool."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..plans.linkage import saved_indexes, scale_candidates
from ..sources.adapter import normalised


def generate(records: DataFrame, pool: DataFrame, path: str, checkpoint: str, config: Config | None = None, on_batch: Callable[[int, DataFrame], None] | None = None, once: bool = False, index_path: str | None = None) -> StreamingQuery:
    """Write (entity, match_id, mask, rule_score, content_score, rank) of each micro-batch to its own folder of path.

    records: a stream of (pos, entity_id, business_name, business_address, country). A batch that is run
    again after a failure overwrites its folder, so that nothing is written twice. pool: normalised, (p, ...). index_path: indexes
    of the pool that linkage.saved_indexes has written, so that no batch tokenises the pool again.
    """
    using = saved_indexes(pool, index_path, config) if index_path else None

    def run(batch: DataFrame, number: int) -> None:
        queries = normalised(batch).withColumnRenamed("pos", "q")
        found = scale_candidates(queries, pool, config, using=using)
        ids = found.join(queries.select("q", F.col("entity_id").alias("entity")), "q").join(pool.select("p", F.col("entity_id").alias("match_id")), "p")
        target = f"{path}/batch={number}"
        ids.select("entity", "match_id", "mask", "rule_score", "content_score", "rank").write.mode("overwrite").parquet(target)
        if on_batch:
            on_batch(number, batch.sparkSession.read.parquet(target))

    writer = records.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
