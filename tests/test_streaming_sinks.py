"""Incremental (streaming) mart refresh equals the batch mart; CSV mart export."""

from __future__ import annotations

import os
import tempfile
from datetime import datetime
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.operators import marts
from mercato.operators.fact import sales_fact
from mercato.sources.readers import load_parquet_tables
from mercato.sources.roles import RAW_TABLES, role_tables
from mercato.sources.sinks import export_marts, write_report
from mercato.streaming.incremental import RevenueRefresh


def _refresh(spark, steps):
    """Land the given (table, rows) steps one after the other, each with its own run; the mart as a dict."""
    root = tempfile.mkdtemp(prefix="mercato-stream-")
    schemas = {
        "customers": "customer_id long, customer_unique_id long, customer_city string, customer_state string",
        "orders": "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz",
        "payments": "order_id long, payment_value decimal(18,2)",
        "reviews": "review_id long, order_id long, review_score int",
    }
    empty = {n: spark.createDataFrame([], s) for n, s in schemas.items()}
    refresh = RevenueRefresh(spark, root, {n: df.schema for n, df in empty.items()})
    for name, rows in steps:
        spark.createDataFrame(rows, empty[name].schema).write.mode("append").parquet(f"{root}/files/{name}")
        refresh.run_available({name: spark.readStream.schema(empty[name].schema).parquet(f"{root}/files/{name}")})
    return {r["order_month"]: r["revenue"] for r in refresh.mart().collect()}


CUSTOMERS = ("customers", [(1, 1, "c", "s")])


def _order(k, month):
    return (k, 1, "delivered", datetime(2020, month, 5))


def test_order_after_its_payment(spark):
    steps = [CUSTOMERS, ("orders", [_order(1, 1)]), ("payments", [(1, Decimal("11.00")), (2, Decimal("20.00"))])]
    assert _refresh(spark, steps) == {"2020-01": 11.0}
    assert _refresh(spark, [*steps, ("orders", [_order(2, 1)])]) == {"2020-01": 31.0}


def test_review_after_its_payment_and_customer_last(spark):
    steps = [
        ("payments", [(1, Decimal("10.00")), (2, Decimal("5.00"))]),
        ("orders", [_order(1, 1), _order(2, 2)]),
        ("reviews", [(1, 1, 5)]),
        CUSTOMERS,
    ]
    assert _refresh(spark, steps) == {"2020-01": 10.0, "2020-02": 5.0}
    # A second review of order 1 doubles its payment rows in the fact, as in the batch mart.
    assert _refresh(spark, [*steps, ("reviews", [(2, 1, 1)])]) == {"2020-01": 20.0, "2020-02": 5.0}


def test_stream_refresh_matches_batch(spark, queries):
    t = role_tables(load_parquet_tables(spark, SF_SMALL, RAW_TABLES))
    got = queries["stream_monthly_revenue"](spark, SF_SMALL).toPandas().sort_values("order_month").reset_index(drop=True)
    want = marts.monthly_revenue(sales_fact(t)).toPandas().reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want)


def test_export_marts_csv(spark, queries):
    out = tempfile.mkdtemp(prefix="mercato-marts-")
    ms = {n: queries[n](spark, SF_SMALL) for n in ["kpi_summary", "monthly_revenue", "order_status"]}
    paths = export_marts(ms, out)
    for name, path in paths.items():
        assert path == f"{out}/{name}.csv"
        back = pd.read_csv(path)
        assert list(back.columns) == ms[name].columns
        assert len(back) == ms[name].count()


def test_write_report(spark):
    df = spark.createDataFrame([("m", "accuracy", 0.75)], "model string, metric string, value double")
    path = write_report(df, tempfile.mkdtemp(prefix="mercato-report-") + "/r")
    text = open(path).read()
    assert "m  accuracy: 0.7500" in text


def test_csv_export_reader(spark):
    from mercato.sources.readers import read_csv_table

    d = tempfile.mkdtemp(prefix="mercato-csv-")
    path = os.path.join(d, "reviews.csv")
    with open(path, "w") as f:
        f.write("review_id,order_id,review_score,review_comment_message\n")
        f.write('r1,o1,5,"great, fast\ndelivery"\n')
        f.write("r2,o2,,\n")
        f.write('r3,o2,3,"said ""ok"""\n')
    df = read_csv_table(spark, path, "reviews")
    assert df.columns == ["review_id", "order_id", "review_score"]
    rows = sorted(df.collect())
    assert [(r.review_id, r.order_id, r.review_score) for r in rows] == [("r1", "o1", 5), ("r2", "o2", None), ("r3", "o2", 3)]

    orders_path = os.path.join(d, "orders.csv")
    with open(orders_path, "w") as f:
        f.write("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                "order_delivered_customer_date,order_estimated_delivery_date\n")
        f.write("o1,c1,delivered,2017-10-02 10:56:33,2017-10-02 11:07:15,2017-10-10 21:25:13,2017-10-18 00:00:00\n")
        f.write("o2,c2,shipped,2018-07-24 20:41:37,,,2018-08-13 00:00:00\n")
    o = read_csv_table(spark, orders_path, "orders")
    assert [f.dataType.simpleString() for f in o.schema.fields][3:] == ["timestamp_ntz"] * 3
    r = o.orderBy("order_id").collect()
    assert r[1].order_delivered_customer_date is None and r[0].order_purchase_timestamp.hour == 10


def test_load_csv_export_directory(spark):
    from mercato.sources.readers import load_csv_tables

    d = tempfile.mkdtemp(prefix="mercato-export-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01000,campinas,SP\n")
    with open(os.path.join(d, "b.csv"), "w") as f:
        f.write("product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n")
    t = load_csv_tables(spark, {"sellers": os.path.join(d, "a.csv"), "category_translation": os.path.join(d, "b.csv")})
    assert t["sellers"].collect()[0].asDict() == {"seller_id": "s1", "seller_city": "campinas", "seller_state": "SP"}
    assert t["category_translation"].first().product_category_name_english == "health_beauty"


def test_csv_without_a_declared_column_is_refused(spark):
    from mercato.sources.readers import read_csv_table

    path = os.path.join(tempfile.mkdtemp(prefix="mercato-short-"), "orders.csv")
    with open(path, "w") as f:
        f.write("order_id,customer_id\no1,c1\n")
    with pytest.raises(ValueError, match="order_status"):
        read_csv_table(spark, path, "orders")


def test_runs_compose_and_export(spark):
    from mercato.plans.catalog import tables
    from mercato.plans.runs import analysis_tables, bi_marts, dashboard_tables

    t = tables(spark, SF_SMALL)
    ms = bi_marts(t)
    out = tempfile.mkdtemp(prefix="mercato-bi-")
    paths = export_marts(ms, out)
    assert sorted(paths) == sorted(ms)
    for name in ["kpi_summary", "rfm_segments"]:
        assert os.path.isfile(paths[name]) and os.path.basename(paths[name]) == f"{name}.csv"
    a = analysis_tables(t)
    assert a["cohort_retention"].where("period = 0 AND retention_pct <> 100").count() == 0
    assert dashboard_tables(t)["kpi_banner"].count() == 1


def test_mart_csv_plain_decimals(spark):
    df = spark.createDataFrame([(357997248.43, 12.0, 0.125, None, 1.5e-7, 2e-300)], "a double, b double, c double, d double, e double, f double")
    path = export_marts({"m": df}, tempfile.mkdtemp(prefix="mercato-dec-"))["m"]
    text = open(path).read().splitlines()
    assert text[1] == "357997248.43,12.0,0.125,,0.00000015,2.0E-300"
