"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest object that is broadcast to the executors at once.
BROADCAST_BYTES = 64 << 20

#: Rows and bytes of text that a Python worker looks at together.
BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Unset, a folder of this machine serves, which only a local master allows.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = "file://" + tempfile.mkdtemp(prefix="recordloom-")
    spark.conf.set("spark.checkpoint.dir", at)
    return at


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete the files of a table made by written() that no later plan reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for top in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(top)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def remainder(id_column: Column, divisor: int) -> Column:
    """crc32 of an id as text, modulo divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(column: pa.Array) -> list[bytes | None]:
    """A string column's values as bytes, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded rows and, but for single long rows, bounded bytes of text."""
    for batch in batches:
        start = size = 0
        lengths = [0 if n is None else n for n in pa.compute.binary_length(batch.column(text)).to_pylist()]
        for i, n in enumerate(lengths):
            if i > start and (i - start >= BATCH_ROWS or size + n > most):
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if len(lengths) > start:
            yield batch.slice(start)


def lean(function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function for mapInArrow, which gives a task's free memory back to the system at its end.

    Workers are reused by all tasks of an executor, and what allocators keep of one task adds to the next one's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim:
                trim(0)

    return run


def map_texts(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over bounded slices; the second column of df is the text."""
    return df.mapInArrow(lean(lambda batches: function(slices(batches))), schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
