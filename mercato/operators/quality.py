"""Data-quality gates: schema, nulls in critical fields, negative payments, join fan-out.

Each check is one aggregate pass per table (all null counts of a table in
a single ``agg``), reported in long form so results of all tables union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.sources.schemas import CANONICAL_SCHEMAS, CRITICAL_COLUMNS


def _compatible(expected: T.DataType, actual: T.DataType) -> bool:
    """Ids may be strings (CSV exports) or integers (derived tables)."""
    if expected == actual:
        return True
    ids = (T.StringType, T.LongType, T.IntegerType)
    return isinstance(expected, ids) and isinstance(actual, ids)


def schema_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Per declared column of the given tables: expected and actual type, presence, rows and rows that do not fit.

    ``tables`` are the files as they are (CSV headers with string columns, or typed
    tables), before any projection, so a missing or mistyped column shows.
    ``misfits`` counts values that the declared type cannot hold; a column is
    ``type_ok`` when it is present and every value fits.  One scan per table.
    """
    out = None
    for name, df in tables.items():
        actual = {f.name: f.dataType for f in df.schema.fields}
        fields = CANONICAL_SCHEMAS[name].fields
        misfit = {
            f.name: F.lit(False) if _compatible(f.dataType, actual[f.name]) else F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
            for f in fields
            if f.name in actual
        }
        agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(m).alias(c) for c, m in misfit.items()])
        cells = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                F.lit(actual[f.name].simpleString() if f.name in actual else None).cast("string").alias("actual_type"),
                F.lit(f.name in actual).alias("present"),
                (F.col(f.name) if f.name in actual else F.lit(None).cast("bigint")).alias("misfits"),
            )
            for f in fields
        ]
        long = agg.select(F.lit(name).alias("table_name"), F.col("_rows").alias("rows"), F.explode(F.array(*cells)).alias("_c")).select(
            "table_name", "rows", "_c.*", (F.col("_c.present") & (F.coalesce("_c.misfits", F.lit(0)) == 0)).alias("type_ok")
        )
        out = long if out is None else out.unionByName(long)
    return out


def null_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and null count per critical column (one aggregate per table)."""
    out = None
    for name, cols in CRITICAL_COLUMNS.items():
        df = tables[name]
        agg = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in cols],
        )
        stack = F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("nulls")) for c in cols])
        )
        long = agg.select(F.lit(name).alias("table_name"), F.col("_rows").alias("rows"), stack.alias("_s")).select(
            "table_name", "_s.column_name", "rows", F.coalesce("_s.nulls", F.lit(0)).cast("bigint").alias("nulls")
        )
        out = long if out is None else out.unionByName(long)
    return out


def negative_payments(payments: DataFrame) -> DataFrame:
    return payments.agg(
        F.count(F.lit(1)).alias("payments"),
        F.count_if(F.col("payment_value") < 0).alias("negative_payments"),
        F.coalesce(F.sum(F.when(F.col("payment_value") < 0, F.col("payment_value"))), F.lit(0))
        .cast("double")
        .alias("negative_total"),
    )


def join_fanout(tables: dict[str, DataFrame], fact: DataFrame) -> DataFrame:
    """Rows, orders and revenue before (payments) and after the fact joins."""
    before = tables["payments"].agg(
        F.count(F.lit(1)).alias("payment_rows"),
        F.countDistinct("order_id").alias("payment_orders"),
        F.sum("payment_value").cast("double").alias("payment_revenue"),
    )
    after = fact.agg(
        F.count(F.lit(1)).alias("fact_rows"),
        F.countDistinct("order_id").alias("fact_orders"),
        F.sum("payment_value").cast("double").alias("fact_revenue"),
    )
    orders = tables["orders"].agg(F.count(F.lit(1)).alias("orders"))
    p = before.select(
        F.lit(1).alias("_k"), "payment_rows", "payment_orders", F.round("payment_revenue", 2).alias("payment_revenue")
    )
    a = after.select(F.lit(1).alias("_k"), "fact_rows", "fact_orders", F.round("fact_revenue", 2).alias("fact_revenue"))
    o = orders.select(F.lit(1).alias("_k"), "orders")
    j = p.join(a, "_k").join(o, "_k").drop("_k")  # three one-row aggregates
    return j.withColumn(
        "fanout_ratio", F.round(F.try_divide(F.col("fact_rows").cast("double"), F.col("payment_rows").cast("double")), 6)
    ).withColumn("orders_lost", F.col("orders") - F.col("fact_orders"))
