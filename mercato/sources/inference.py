"""CSV files of unknown types: text as it is, malformed lines, and types inferred in one pass.

Types form a lattice: ``empty`` below everything, ``integer`` below ``decimal``, and ``text``
above all; ``timestamp`` lies between ``empty`` and ``text`` beside the numbers.  A value
has the lowest type that its text fits; a column has the least type above all its
values.  Joining is associative and commutative, so a column's type is one
aggregate over any partition of its rows, and types of several files join alike.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.common import reuse_checkpointed

INTEGER = r"^[+-]?[0-9]{1,18}$"
DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
SPARK_TYPES = {"integer": T.LongType(), "decimal": T.DoubleType(), "timestamp": T.TimestampNTZType(), "text": T.StringType(), "empty": T.StringType()}


@dataclass(frozen=True)
class CsvText:
    """A CSV file as text: ``rows`` with the header's columns as strings, ``malformed`` with the other lines as ``raw``."""

    rows: DataFrame
    malformed: DataFrame


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> CsvText:
    """The lines with as many fields as the header, and those with more or fewer (or a broken quotation).

    Parsed once and written, since both halves and the inference read it.  Empty fields are null.
    """
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    corrupt = "_corrupt"
    while corrupt in header:
        corrupt += "_"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, corrupt]])
    # Without column pruning every line is parsed to its end, so its fields are counted.
    reader = spark.read.schema(schema).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=corrupt, columnPruning=False)
    lines = reuse_checkpointed(reader.csv(path))
    rows = lines.where(F.col(f"`{corrupt}`").isNull()).select(*[F.col(f"`{c}`") for c in header])
    return CsvText(rows, lines.where(F.col(f"`{corrupt}`").isNotNull()).select(F.col(f"`{corrupt}`").alias("raw")))


def join_types(a: str, b: str) -> str:
    """The least type above both."""
    if "empty" in (a, b):
        return b if a == "empty" else a
    if a == b:
        return a
    return "decimal" if {a, b} == {"integer", "decimal"} else "text"


def value_type(value: Column) -> Column:
    """The type of one text (null counts as ``empty``)."""
    text = F.trim(value)
    return (
        F.when(value.isNull() | (text == ""), "empty")
        .when(text.rlike(INTEGER), "integer")
        .when(text.rlike(DECIMAL), "decimal")
        .when(text.rlike(TIMESTAMP) & text.try_cast("timestamp_ntz").isNotNull(), "timestamp")
        .otherwise("text")
    )


def joined(has: Mapping[str, Column]) -> Column:
    """``join_types`` over the types that occur: ``has`` tells of each whether it does."""
    number = has["integer"] | has["decimal"]
    return (
        F.when(has["text"] | (has["timestamp"] & number), "text")
        .when(has["timestamp"], "timestamp")
        .when(has["decimal"], "decimal")
        .when(has["integer"], "integer")
        .otherwise("empty")
    )


def inferred_schema(rows: DataFrame) -> DataFrame:
    """``column_name, inferred_type, rows, nulls`` of text columns, by one aggregate over the rows."""
    kinds = ("integer", "decimal", "timestamp", "text")
    # The types are a step of their own: inside the counts a text would be matched again for each kind.
    types = rows.select(*[value_type(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(rows.columns)])
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i in range(len(rows.columns)):
        aggs += [F.count_if(F.col(f"_{i}") == k).alias(f"_{k}{i}") for k in kinds]
    cells = []
    for i, c in enumerate(rows.columns):
        n = {k: F.col(f"_{k}{i}") for k in kinds}
        filled = sum((n[k] for k in kinds), F.lit(0))
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                joined({k: n[k] > 0 for k in kinds}).alias("inferred_type"),
                F.col("_rows").alias("rows"),
                (F.col("_rows") - filled).alias("nulls"),
            )
        )
    return types.agg(*aggs).select(F.inline(F.array(*cells)))


def typed(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns cast to inferred types; blank texts of typed columns are null."""
    return rows.select(
        *[
            F.col(f"`{c}`") if isinstance(SPARK_TYPES[types[c]], T.StringType) else F.trim(F.col(f"`{c}`")).try_cast(SPARK_TYPES[types[c]]).alias(c)
            for c in rows.columns
        ]
    )


def read_csv_inferred(spark: SparkSession, path: str, multi_line: bool = False) -> CsvText:
    """A CSV file with inferred types, and its malformed lines: one parse, one aggregate."""
    text = read_csv_text(spark, path, multi_line)
    types = {r["column_name"]: r["inferred_type"] for r in inferred_schema(text.rows).collect()}  # one row a column
    return CsvText(typed(text.rows, types), text.malformed)
