"""Tab-separated record tables: discovery, headers under other names, null words, splits."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import constants as C

COLUMNS = ("entity_id", "business_name", "business_address", "country")
REQUIRED = ("entity_id", "business_name")


class SchemaError(ValueError):
    """A table lacks a column that nothing can stand in for."""


def find_file(folder: str | Path, name: str) -> Path:
    """The file of that name, else the first that ends in it."""
    folder = Path(folder)
    if (folder / name).is_file():
        return folder / name
    found = sorted(folder.glob(f"*{name}"))
    if not found:
        raise FileNotFoundError(f"no {name} in {folder}")
    return found[0]


def find_root(places: list[str | Path], splits: tuple[str, ...] = ("train", "test")) -> Path:
    """The first of the places that has every split."""
    for place in map(Path, places):
        if all((place / s).is_dir() for s in splits):
            return place
    raise FileNotFoundError(f"no folder with {' and '.join(splits)} among {[str(p) for p in places]}")


def canonical(header: list[str], aliases: dict[str, str] = C.COLUMN_ALIASES) -> dict[str, str]:
    """Header names to canonical ones; of several that stand for one column the first counts."""
    out: dict[str, str] = {}
    for name in header:
        known = aliases.get(name.strip().lower())
        if known and known not in out.values():
            out[name] = known
    return out


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...] | None = None, limit: int | None = None, nulls: bool = True, keep_unknown: bool = True, aliases: dict[str, str] = C.COLUMN_ALIASES) -> DataFrame:
    """A table of strings with canonical column names. The schema comes from the header alone, so that ids keep their zeros.

    nulls: null words become null (in-memory generation); without it they are text. Files are split among
    tasks as Spark splits them, columns that are not asked for are not parsed.
    """
    header = spark.read.text(path).first()
    names = header[0].split("\t") if header else []
    schema = StructType([StructField(n, StringType()) for n in names])
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "\x00").csv(path)
    known = canonical(names, aliases)
    df = df.select(*(F.col(f"`{n}`").alias(known.get(n, n)) for n in names if keep_unknown or n in known))
    if nulls:
        df = df.select(*(F.when(~F.col(c).isin(*C.NULL_VALUES), F.col(c)).alias(c) for c in df.columns))
    else:
        df = df.na.fill("")
    if "entity_id" in df.columns:
        df = df.withColumn("entity_id", F.trim("entity_id"))
    if columns:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def validated(df: DataFrame) -> DataFrame:
    """Requires an id and a name; gives empty columns for a missing address or country."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {', '.join(missing)}")
    return df.withColumns({c: F.lit("") for c in COLUMNS if c not in df.columns})


def pool_of(source2: DataFrame, source3: DataFrame, check: bool = True) -> DataFrame:
    """Sources 2 and 3 with their source; repeated ids among them are an error if checked."""
    both = source2.withColumn("source", F.lit("S2")).unionByName(source3.withColumn("source", F.lit("S3")), allowMissingColumns=True)
    if check:
        repeated = both.groupBy("entity_id").count().where("count > 1").limit(5).collect()
        if repeated:
            raise ValueError(f"repeated pool ids: {[r.entity_id for r in repeated]}")
    return both


@dataclass
class Split:
    """The three tables of a split."""

    source1: DataFrame
    source2: DataFrame
    source3: DataFrame

    def pool(self) -> DataFrame:
        return pool_of(self.source2, self.source3)


def load_split(spark: SparkSession, folder: str, split: str, **options) -> Split:
    return Split(*(validated(read_tsv(spark, str(find_file(folder, f"{split}_source{k}.tsv")), **options)) for k in (1, 2, 3)))
