"""Data-quality queries and the streaming mart refresh."""

from __future__ import annotations

from mercato.operators import quality as dq
from mercato.operators import quarantine as qr
from mercato.operators.fact import sales_fact
from mercato.plans.catalog import R, register, tables
from mercato.sources.roles import load_role_tables
from mercato.sources.schemas import CRITICAL_COLUMNS

_VIEW = {
    "orders": "orders_r",
    "payments": "payments_r",
    "customers": "customers_r",
    "reviews": "reviews_r",
    "items": "items_r",
    "products": "products_r",
    "category_translation": "translation_r",
    "sellers": "sellers_r",
}

_NULL_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS rows, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM {_VIEW[t]}"
    for t, cols in CRITICAL_COLUMNS.items()
    for c in cols
)


def _schema_sql() -> str:
    from mercato.sources.schemas import CANONICAL_SCHEMAS

    ids = "('string', 'bigint', 'int')"
    spark_type = (
        "CASE typeof({c}) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' "
        "WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(typeof({c})) END"
    )
    parts = []
    for t, schema in CANONICAL_SCHEMAS.items():
        for f in schema.fields:
            e = f.dataType.simpleString()
            a = spark_type.format(c=f.name)
            parts.append(
                f"(SELECT '{t}' AS table_name, '{f.name}' AS column_name, '{e}' AS expected_type, "
                f"any_value({a}) AS actual_type, true AS present, count(*) AS rows, "
                f"count(*) FILTER (WHERE {f.name} IS NOT NULL AND NOT ({a} = '{e}' OR ('{e}' IN {ids} AND {a} IN {ids}))) AS misfits, "
                f"bool_and({f.name} IS NULL OR {a} = '{e}' OR ('{e}' IN {ids} AND {a} IN {ids})) AS type_ok FROM {_VIEW[t]})"
            )
    return " UNION ALL ".join(parts)


@register("dq_schema", _schema_sql())
def q_dq_schema(spark, d):
    """Declared against actual columns of the tables as they come, with the rows that do not fit."""
    return dq.schema_report(load_role_tables(spark, d))


@register("dq_nulls", _NULL_SQL)
def q_dq_nulls(spark, d):
    return dq.null_report(tables(spark, d))


@register(
    "dq_negative_payments",
    """
    SELECT count(*) AS payments, count(*) FILTER (WHERE payment_value < 0) AS negative_payments,
           CAST(coalesce(sum(payment_value) FILTER (WHERE payment_value < 0), 0) AS DOUBLE) AS negative_total
    FROM payments_r
    """,
)
def q_dq_negative_payments(spark, d):
    return dq.negative_payments(tables(spark, d)["payments"])


@register(
    "dq_join_fanout",
    f"""
    WITH p AS (SELECT count(*) AS payment_rows, count(DISTINCT order_id) AS payment_orders,
                      {R('CAST(sum(payment_value) AS DOUBLE)')} AS payment_revenue FROM payments_r),
    f AS (SELECT count(*) AS fact_rows, count(DISTINCT order_id) AS fact_orders,
                 {R('CAST(sum(payment_value) AS DOUBLE)')} AS fact_revenue FROM fact_r),
    o AS (SELECT count(*) AS orders FROM orders_r)
    SELECT p.*, f.*, o.orders,
           {R('CAST(fact_rows AS DOUBLE) / CAST(payment_rows AS DOUBLE)', 6)} AS fanout_ratio,
           orders - fact_orders AS orders_lost
    FROM p, f, o
    """,
)
def q_dq_join_fanout(spark, d):
    t = tables(spark, d)
    return dq.join_fanout(t, sales_fact(t))


_QUARANTINE_SQL = " UNION ALL ".join(
    [
        f"SELECT '{t}' AS table_name, 'null:{c}' AS rule, CAST(count(*) - count({c}) AS BIGINT) AS rows FROM {_VIEW[t]}"
        for t, cols in CRITICAL_COLUMNS.items()
        for c in cols
    ]
    + [
        f"SELECT '{t}' AS table_name, 'negative:{c}' AS rule, count(*) FILTER (WHERE {c} < 0) AS rows FROM {_VIEW[t]}"
        for t, cols in qr.NOT_NEGATIVE.items()
        for c in cols
    ]
)


@register("dq_quarantine", _QUARANTINE_SQL)
def q_dq_quarantine(spark, d):
    """Rejected rows of every table by rule, from the written quarantine."""
    return qr.report(qr.quarantine_tables(load_role_tables(spark, d)))


def _inferred_sql() -> str:
    from mercato.sources.inference import DECIMAL, INTEGER
    from mercato.sources.schemas import CANONICAL_SCHEMAS

    parts = []
    for t, schema in CANONICAL_SCHEMAS.items():
        for f in schema.fields:
            text = f"CAST({f.name} AS VARCHAR)"
            parts.append(
                f"(SELECT '{t}' AS table_name, '{f.name}' AS column_name, "
                f"CASE WHEN count({f.name}) = 0 THEN 'empty' WHEN bool_and(regexp_matches({text}, '{INTEGER}')) THEN 'integer' "
                f"WHEN bool_and(regexp_matches({text}, '{DECIMAL}')) THEN 'decimal' "
                f"WHEN bool_and(try_cast({text} AS TIMESTAMP) IS NOT NULL) FILTER (WHERE {f.name} IS NOT NULL) THEN 'timestamp' ELSE 'text' END AS inferred_type, "
                f"count(*) AS rows, CAST(count(*) - count({f.name}) AS BIGINT) AS nulls FROM {_VIEW[t]})"
            )
    return " UNION ALL ".join(parts)


@register("csv_inferred_schema", _inferred_sql())
def q_csv_inferred_schema(spark, d):
    """Types of the tables inferred from text copies of them (CSV with a header)."""
    import uuid

    from pyspark.sql import functions as F

    from mercato.functions.common import materialized_folder
    from mercato.sources import inference as inf

    out = None
    for name, df in load_role_tables(spark, d).items():
        path = f"{materialized_folder(spark)}/{uuid.uuid4().hex}"
        df.write.csv(path, header=True, escape='"')
        types = inf.inferred_schema(inf.read_csv_text(spark, path).rows).select(F.lit(name).alias("table_name"), "*")
        out = types if out is None else out.unionByName(types)
    return out


@register(
    "stream_monthly_revenue",
    "SELECT order_month, " + R("CAST(sum(payment_value) AS DOUBLE)") + " AS revenue FROM fact_r GROUP BY order_month",
)
def q_stream_monthly_revenue(spark, d):
    """Monthly revenue maintained by a Structured Streaming query over the payment files."""
    from mercato.streaming.incremental import monthly_revenue_stream_once

    return monthly_revenue_stream_once(spark, d)


@register(
    "stream_state_persons",
    "SELECT customer_state, count(DISTINCT customer_unique_id) AS persons, true AS within_bound FROM fact_r "
    "WHERE customer_state IS NOT NULL GROUP BY customer_state",
)
def q_stream_state_persons(spark, d):
    """Distinct persons per state, and whether the refresh's stored sketches come near them."""
    from mercato.streaming.incremental import state_persons_check

    return state_persons_check(spark, d)
