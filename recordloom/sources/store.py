"""The normalised record store: Parquet with dense row numbers, range reads and point gathers."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.address import components
from ..functions.text import address_core, normalize_address, normalize_country, normalize_name, truncated

STORED = ("rowid", "entity_id", "name_norm", "name_core", "addr_norm", "addr_core", "country", "pincode", "house_number", "city", "state")
ROWS_PER_FILE = 250_000


def normalised_rows(df: DataFrame) -> DataFrame:
    """Store columns but the row number, texts cut to 512 characters; null words stay texts until the normalisers drop them."""
    name, address = truncated(F.col("business_name")), truncated(F.col("business_address"))
    rows = df.select("*", normalize_name(name).alias("name_norm"), normalize_name(name, core=True).alias("name_core"), normalize_address(address).alias("addr_norm"), normalize_country(F.col("country")).alias("__country"))
    rows = rows.withColumns({"addr_core": address_core(F.col("addr_norm"), whole_tokens=True), "__c": components(F.col("addr_norm"))})
    kept = [truncated(F.col(c)).alias(c) for c in ("name_norm", "name_core", "addr_norm", "addr_core")]
    return rows.select("entity_id", *kept, F.col("__country").alias("country"), "__c.*")


def numbered(df: DataFrame, path: str) -> DataFrame:
    """Adds dense row numbers from 0 in the order of partitions and rows, without gathering rows: a written copy fixes the order, and only row counts by file reach the driver."""
    spark = df.sparkSession
    df.withColumn("__at", F.monotonically_increasing_id()).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path)
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    counts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for r in counts:
        starts[r.part], total = total, total + r.n
    offsets = spark.createDataFrame(list(starts.items()) or [(0, 0)], "__part long, __start long")
    return rows.join(F.broadcast(offsets), part == F.col("__part")).withColumn("rowid", (F.col("__start") + place).cast("long")).drop("__at", "__part", "__start")


def write(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> dict:
    """Write a raw table's store at path, sorted by row number within files, and its manifest; gives the manifest."""
    rows = numbered(normalised_rows(df), f"{path}/_unordered").select(*STORED)
    rows.repartitionByRange("rowid").sortWithinPartitions("rowid").write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).parquet(f"{path}/rows")
    n = df.sparkSession.read.parquet(f"{path}/rows").count()
    manifest = {"rows": n, "rows_per_file": rows_per_file, "columns": list(STORED)}
    write_manifest(df.sparkSession, path, "store", manifest)
    _path(df.sparkSession, f"{path}/_unordered")[1].delete(_path(df.sparkSession, f"{path}/_unordered")[0], True)
    return manifest


def read(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None) -> DataFrame:
    rows = spark.read.parquet(f"{path}/rows")
    return rows.select(*columns) if columns else rows


def pool(source2: DataFrame, source3: DataFrame) -> DataFrame:
    """Both stores under pool-wide row numbers, source 2 first, with the source."""
    n = source2.agg(F.count("*").alias("__n"))
    second = source3.crossJoin(F.broadcast(n)).withColumn("rowid", F.col("rowid") + F.col("__n")).drop("__n")
    return source2.withColumn("source", F.lit("S2")).unionByName(second.withColumn("source", F.lit("S3")))


def read_range(rows: DataFrame, start: int, stop: int) -> DataFrame:
    """Rows start to stop - 1; bounds beyond the table are cut, and row group statistics skip the rest."""
    return rows.where((F.col("rowid") >= max(start, 0)) & (F.col("rowid") < stop))


def gather(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """requests (at, rowid) with the rows they name, repeats too; order by ``at`` to have the order of asking."""
    return requests.join(rows, "rowid", "left")


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_manifest(spark: SparkSession, folder: str, stage: str, facts: dict) -> None:
    """A stage's manifest as JSON: written aside, then renamed, in any file system that Spark knows."""
    text = json.dumps(facts | {"stage": stage, "written_at": time.time()}, sort_keys=True)
    aside, fs = _path(spark, f"{folder}/manifest-{stage}.json.tmp")
    target, _ = _path(spark, f"{folder}/manifest-{stage}.json")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(aside, target)


def read_manifest(spark: SparkSession, folder: str, stage: str) -> dict | None:
    path, fs = _path(spark, f"{folder}/manifest-{stage}.json")
    if not fs.exists(path):
        return None
    return json.loads("\n".join(r.value for r in spark.read.text(str(path)).collect()))


def is_current(spark: SparkSession, folder: str, stage: str, expected: dict) -> bool:
    """Whether the stage's manifest has all the expected facts."""
    found = read_manifest(spark, folder, stage)
    return found is not None and all(found.get(k) == v for k, v in expected.items())


def required(spark: SparkSession, folder: str, stage: str) -> dict:
    found = read_manifest(spark, folder, stage)
    if found is None:
        raise FileNotFoundError(f"stage {stage} has not been written to {folder}")
    return found
