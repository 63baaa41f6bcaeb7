"""Sinks: flat CSV marts for BI tools, Parquet for large results, the model report.

Marts are small aggregates (tens to thousands of rows), so each is written
as a single CSV file with a header (``coalesce(1)`` after aggregation, never
on fact-sized data).  Large frames go to Parquet with the cluster's
parallelism.  Writes overwrite the target folder, like re-exporting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed file names of the BI export set.
MART_FILES = [
    "kpi_summary",
    "monthly_revenue",
    "revenue_by_state",
    "revenue_by_city",
    "payment_methods",
    "order_status",
    "top_categories",
    "top_sellers",
    "delivery_performance",
    "rfm_segments",
]


def _plain_decimal(c) -> "F.Column":
    """Double as its shortest exact text, without an exponent where DECIMAL(38,19) holds it; ``12.0`` is kept."""
    text = c.cast("string")
    plain = F.regexp_replace(text.try_cast("decimal(38,19)").cast("string"), r"(\.\d*?[1-9])0+$", "$1")
    plain = F.regexp_replace(plain, r"\.0+$", ".0")
    exact = plain.try_cast("double") == c
    return F.when(text.contains("E") & F.coalesce(exact, F.lit(False)), plain).otherwise(text)


def write_mart_csv(df: DataFrame, out_dir: str, name: str) -> str:
    """Write ``out_dir/<name>.csv``, one file of a fixed name; the old file is replaced when the new one is whole."""
    folder = f"{out_dir.rstrip('/')}/_{name}"
    cols = [
        _plain_decimal(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields
    ]
    df.select(*cols).coalesce(1).write.mode("overwrite").option("header", True).csv(folder)
    return _single_file(df, folder, f"{out_dir.rstrip('/')}/{name}.csv")


def _single_file(df: DataFrame, folder: str, path: str) -> str:
    """Move the folder's only part file to ``path`` by Hadoop's file systems."""
    jvm = df.sparkSession.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(folder), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
    fs.delete(target, True)
    if not fs.rename(part, target):
        raise OSError(f"could not rename {part} to {path}")
    fs.delete(source, True)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def export_marts(marts: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Write each mart as ``out_dir/<name>.csv``; returns name -> file."""
    return {name: write_mart_csv(df, out_dir, name) for name, df in marts.items()}


def write_report(metrics: DataFrame, path: str) -> str:
    """Model report as text lines ``model  metric: value`` (the metrics frame is small)."""
    lines = metrics.select(
        F.format_string("%s  %s: %.4f", F.col("model"), F.col("metric"), F.col("value")).alias("value")
    )
    lines.coalesce(1).write.mode("overwrite").text(f"{path}.parts")
    return _single_file(metrics, f"{path}.parts", path)
