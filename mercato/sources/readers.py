"""Readers: marketplace CSV exports and Parquet tables, with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.sources.schemas import CANONICAL_SCHEMAS

# Tables whose quoted texts may hold line breaks; only their files cannot be split.
MULTI_LINE = {"reviews"}


def csv_header(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The file as it is: every column of its header, as strings."""
    reader = spark.read.option("header", True).option("escape", '"').option("enforceSchema", False).option("mode", "FAILFAST")
    return reader.option("multiLine", name in MULTI_LINE).csv(path)


def read_csv_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Scan one CSV export with its declared schema (no inference).

    Quoted fields may contain commas (RFC-4180 escaping) and, in the tables of
    ``MULTI_LINE``, line breaks.  Columns that the schema does not name are not
    read; a declared column that the header lacks is an error.
    """
    raw = csv_header(spark, path, name)
    schema = CANONICAL_SCHEMAS[name]
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: table {name!r} lacks the columns {missing}")
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_csv_tables(spark: SparkSession, files: dict[str, str]) -> dict[str, DataFrame]:
    """Load the CSV files the caller names (``table -> path``) into canonical DataFrames."""
    unknown = set(files) - set(CANONICAL_SCHEMAS)
    if unknown:
        raise ValueError(f"unknown tables {sorted(unknown)}")
    return {name: read_csv_table(spark, path, name) for name, path in files.items()}


def load_parquet_tables(spark: SparkSession, directory: str, names) -> dict[str, DataFrame]:
    """Load ``{directory}/{name}.parquet`` for each name (lazy scans)."""
    return {n: spark.read.parquet(f"{directory}/{n}.parquet") for n in names}


def register_views(tables: dict[str, DataFrame], suffix: str = "") -> None:
    """Expose each table as a temp view so the same data serves ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{name}{suffix}")
