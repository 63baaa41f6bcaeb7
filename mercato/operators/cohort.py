"""Monthly cohort retention (cohort = month of a person's first purchase).

One shuffle of the fact: each person's set of active months is aggregated
(map-side partial ``collect_set`` shrinks it before the exchange, and the
set is bounded by the number of distinct months in the data, never by the
person's row count).  The cohort is the set's minimum, and exploding the
set gives one row per (person, active month) with its period.  Everything
after that is aggregated by (cohort, period) - a small table - so the
retention windows and the pivot run on bounded data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.timefx import month_index_from_text

CUST = "customer_unique_id"


def cohort_assignment(fact: DataFrame) -> DataFrame:
    """(person, active month, cohort, period = month distance to the cohort)."""
    months = (
        fact.where(F.col(CUST).isNotNull() & F.col("order_month").isNotNull())
        .groupBy(CUST)
        .agg(F.collect_set("order_month").alias("_months"))
    )
    return months.select(
        CUST, F.explode("_months").alias("order_month"), F.array_min("_months").alias("cohort")
    ).withColumn("period", month_index_from_text("order_month") - month_index_from_text("cohort"))


def cohort_counts(assignment: DataFrame) -> DataFrame:
    """Distinct persons per (cohort, period); rows of the assignment are distinct."""
    return assignment.groupBy("cohort", "period").agg(F.count(F.lit(1)).alias("customers"))


def cohort_retention(counts: DataFrame) -> DataFrame:
    """Long form: customers and percent of the cohort's period-0 size."""
    size = F.max(F.when(F.col("period") == 0, F.col("customers"))).over(Window.partitionBy("cohort"))
    return counts.select(
        "cohort",
        "period",
        "customers",
        F.round(F.try_divide(F.col("customers").cast("double"), size.cast("double")) * 100, 2).alias(
            "retention_pct"
        ),
    ).orderBy("cohort", "period")


def cohort_cells(counts: DataFrame) -> DataFrame:
    """Every (cohort, period) cell up to the last period, null where nobody bought; no job while it is planned."""
    last = counts.select(F.max("period")).scalar()
    by_period = counts.groupBy("cohort").agg(F.map_from_entries(F.collect_list(F.struct("period", "customers"))).alias("_cells"))
    grid = by_period.withColumn("_last", last).select("cohort", "_cells", F.explode(F.sequence(F.lit(0), "_last")).alias("period"))
    return grid.select("cohort", "period", F.try_element_at("_cells", F.col("period")).cast("double").alias("customers"))


def cohort_matrix(counts: DataFrame, values: list[int] | None = None) -> DataFrame:
    """Wide cohort x period matrix of distinct persons (missing cells null).

    ``values`` fixes the period columns; by default they are read from the
    counts (at most one per month of the data's time span).
    """
    if values is None:
        values = [r[0] for r in counts.select("period").distinct().orderBy("period").collect()]
    # Cells are double like the pandas pivot (missing cells are null/NaN).
    wide = counts.groupBy("cohort").pivot("period", values).agg(F.first("customers").cast("double"))
    return wide.select("cohort", *[F.col(str(v)).alias(f"p{v}") for v in values]).orderBy("cohort")


def cohort_retention_corner(retention: DataFrame, n: int = 6) -> DataFrame:
    """First n cohorts x first n period columns of the retention matrix (long, nulls kept)."""
    cohorts = retention.select("cohort").distinct().withColumn(
        "_ci", F.dense_rank().over(Window.orderBy("cohort"))
    ).where(F.col("_ci") <= n)
    periods = retention.select("period").distinct().withColumn(
        "_pi", F.dense_rank().over(Window.orderBy("period"))
    ).where(F.col("_pi") <= n)
    first_periods = periods.select(F.array_sort(F.collect_list("period"))).scalar()
    grid = cohorts.withColumn("_pa", first_periods).select("cohort", F.explode("_pa").alias("period"))
    return grid.join(retention.select("cohort", "period", "retention_pct"), ["cohort", "period"], "left").select(
        "cohort", "period", "retention_pct"
    ).orderBy("cohort", "period")
