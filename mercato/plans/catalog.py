"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``, with oracle SQL.

Every query reads the driver's test tables through the role views, so its
work grows with the tables.  The matching DuckDB SQL (when one exists) is
registered next to it; queries without SQL are model fits and get a
rows-only check plus pytest coverage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.plans import oracle as _oracle
from mercato.sources.landing import land_tables
from mercato.sources.roles import RAW_TABLES, load_role_tables
from mercato.sources.schemas import CANONICAL_SCHEMAS

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def R(expr: str, digits: int = 2) -> str:
    """DuckDB rounding with Spark's semantics (HALF_UP on the shortest decimal text)."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def M(expr: str) -> str:
    """Money sum as double, rounded to cents (exact in both engines)."""
    return R(f"CAST(sum({expr}) AS DOUBLE)")


def money_as_double(df: DataFrame) -> DataFrame:
    """Emit DECIMAL money columns as double (the marts' output convention)."""
    if not any(isinstance(f.dataType, T.DecimalType) for f in df.schema.fields):
        return df
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return money_as_double(fn(spark, sf_dir))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            _oracle.oracle(name, sql)
        return fn

    return deco


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Canonical tables for ``sf_dir``: role views landed as bucketed Parquet, each on first use."""
    paths = [f"{sf_dir}/{t}.parquet" for t in RAW_TABLES]
    return land_tables(spark, paths, list(CANONICAL_SCHEMAS), lambda: load_role_tables(spark, sf_dir))


# Import the modules that register queries (order = presentation order).
def _load_all() -> None:
    from mercato.plans import q_marts  # noqa: F401
    from mercato.plans import q_customers  # noqa: F401
    from mercato.plans import q_cohorts  # noqa: F401
    from mercato.plans import q_features  # noqa: F401
    from mercato.plans import q_quality  # noqa: F401
    from mercato.plans import q_models  # noqa: F401  (model fits last: the heaviest jobs)


def all_queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_all()
    return _oracle.oracle_sql()
