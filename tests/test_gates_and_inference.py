"""Quarantine, CSV type inference with malformed lines, and quantile sketches."""

from __future__ import annotations

import itertools
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from mercato.functions import sketches as sk
from mercato.operators import customers as cu
from mercato.operators import quarantine as qr
from mercato.sources import inference as inf
from mercato.sources.roles import load_role_tables

PAYMENTS = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value decimal(18,2), rejected string, row int"


def payments(spark):
    rows = [("a", 1, "card", 1, 5, "x", 1), ("b", 1, None, 1, -2, "y", 2), (None, 1, None, 1, None, None, None), ("c", 1, "card", 1, 0, "", 0)]
    from decimal import Decimal

    return spark.createDataFrame([(*r[:4], None if r[4] is None else Decimal(r[4]), *r[5:]) for r in rows], PAYMENTS)


def test_quarantine_splits_every_row_once(spark):
    df = payments(spark)
    q = qr.quarantine("payments", df)
    assert q.accepted.columns == df.columns and sorted(r["order_id"] for r in q.accepted.collect()) == ["a", "c"]
    failed = {r["row"]["order_id"]: r["failed_rules"] for r in q.rejected.collect()}
    assert failed == {
        "b": ["null:payment_type", "negative:payment_value"],
        None: ["null:order_id", "null:payment_type", "null:payment_value"],
    }
    assert {r["rule"]: r["rows"] for r in q.report().collect()} == {
        "null:order_id": 1, "null:payment_type": 2, "null:payment_value": 1, "negative:payment_value": 1
    }
    # Each half reads its own folder.
    assert all("rejected=false" in f for f in q.accepted.inputFiles()) or "PartitionFilters: [isnotnull(rejected" in q.accepted._jdf.queryExecution().toString()


def test_quarantine_of_all_tables_keeps_all_rows(spark):
    t = load_role_tables(spark, SF_SMALL)
    for name, q in qr.quarantine_tables(t, max_rejected=0.2).items():
        assert q.accepted.count() + q.rejected.count() == t[name].count()


def test_quarantine_stops_the_run(spark):
    q = qr.quarantine("payments", payments(spark))
    assert q.check(0.5) is q
    with pytest.raises(qr.DataQualityError, match="2 of 4 rows"):
        q.check(0.49)
    with pytest.raises(qr.DataQualityError, match="payment_value"):
        qr.quarantine("payments", payments(spark).drop("payment_value"))
    empty = qr.quarantine("payments", payments(spark).limit(0)).check(0.0)
    assert empty.accepted.count() == empty.rejected.count() == 0


def csv(text):
    path = os.path.join(tempfile.mkdtemp(prefix="mercato-csv-"), "f.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_gated_csv(spark):
    lines = ["order_id,payment_sequential,payment_type,payment_installments,payment_value", "a,1,card,1,5.50", "b,x,card,1,6", "c,1,card,1", "d,1,,1,-3", "e,1,card,1,1,9"]
    path = csv("\n".join(lines) + "\n")
    q = qr.load_csv_gated(spark, {"payments": path}, 0.8)["payments"]
    assert [(r["order_id"], float(r["payment_value"])) for r in q.accepted.collect()] == [("a", 5.5)]
    assert {r["rule"]: r["rows"] for r in q.report().collect() if r["rows"]} == {
        "type:payment_sequential": 1, "null:payment_type": 1, "negative:payment_value": 1, "malformed": 2
    }
    with pytest.raises(qr.DataQualityError):
        qr.load_csv_gated(spark, {"payments": path}, 0.5)


def test_csv_inference(spark):
    path = csv(
        "i,d,t,s,mixed,none,_corrupt\n"
        "1,1.5,2020-01-01,a,1,,7\n"
        '-2,3,2020-01-01 10:00:00,"b, c",2020-01-01,,8\n'
        "short,1\n"
        ",,,,,,\n"
        "3,1e3,2020-02-03T04:05:06.7,9,5,,9,extra\n"
        "44,.5,2020-12-31 23:59:59,\"said \"\"x\"\"\",7,,10\n"
    )
    text = inf.read_csv_text(spark, path)
    assert sorted(r["raw"] for r in text.malformed.collect()) == ["3,1e3,2020-02-03T04:05:06.7,9,5,,9,extra", "short,1"]
    got = {r["column_name"]: (r["inferred_type"], r["rows"], r["nulls"]) for r in inf.inferred_schema(text.rows).collect()}
    assert got == {
        "i": ("integer", 4, 1), "d": ("decimal", 4, 1), "t": ("timestamp", 4, 1), "s": ("text", 4, 1),
        "mixed": ("text", 4, 1), "none": ("empty", 4, 4), "_corrupt": ("integer", 4, 1),
    }
    out = inf.read_csv_inferred(spark, path).rows
    assert [t for _, t in out.dtypes] == ["bigint", "double", "timestamp_ntz", "string", "string", "string", "bigint"]
    assert sorted((r["i"], r["s"]) for r in out.where("i is not null").collect()) == [(-2, "b, c"), (1, "a"), (44, 'said "x"')]


def test_types_join_like_a_lattice(spark):
    kinds = list(inf.SPARK_TYPES)
    for a, b, c in itertools.product(kinds, repeat=3):
        assert inf.join_types(a, b) == inf.join_types(b, a)
        assert inf.join_types(inf.join_types(a, b), c) == inf.join_types(a, inf.join_types(b, c))
    one = {"integer": "5", "decimal": "5.5", "timestamp": "2020-01-01", "text": "x", "empty": None}
    for a, b in itertools.product(kinds, repeat=2):  # the aggregate folds as the join does
        df = spark.createDataFrame([(one[a],), (one[b],)], "v string")
        assert inf.inferred_schema(df).first()["inferred_type"] == inf.join_types(a, b)


def test_sketched_quantiles_stay_within_their_bound(spark):
    rng = random.Random(1)
    values = [rng.lognormvariate(0, 2) for _ in range(40_000)] + [1.0] * 20_000 + [None] * 100
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(8)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    for k in (200, sk.K):
        rows = sk.edge_errors(df, "v", probs, k).collect()
        assert [r["probability"] for r in rows] == probs and all(r["rank_error"] <= r["bound"] == sk.rank_error(k) for r in rows)
    assert sk.edge_errors(df.limit(0), "v", [0.5]).first()["edge"] is None
    by = sk.approx_quantile_table(df.withColumn("g", F.col("v") > 1), "v", [0.5], group=["g"]).collect()
    assert len(by) == 2


def test_sketched_segments_are_near_the_exact_ones(spark, queries):
    fact = queries["sales_fact"](spark, SF_SMALL)
    exact = {r[0]: r["segment_rank"] for r in cu.customer_value_segments(fact).collect()}
    near = {r[0]: r["segment_rank"] for r in cu.customer_value_segments(fact, approx=True).collect()}
    assert exact.keys() == near.keys()
    off = sum(exact[k] != near[k] for k in exact)
    assert off <= 3 * (1 + 2 * sk.rank_error() * len(exact))
    for r in queries["customer_value_segments_approx"](spark, SF_SMALL).collect():
        assert r["rank_error"] <= r["bound"]


def test_types_are_worked_out_once_a_value(spark):
    from mercato.sources.inference import inferred_schema

    rows = spark.createDataFrame([("1", "x"), ("2.5", None), (" ", "2020-01-01")], "a string, b string")
    schema = inferred_schema(rows)
    plan = schema._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 2 * 3  # three patterns a column, not three for each kind
    assert {tuple(r) for r in schema.collect()} == {("a", "decimal", 3, 1), ("b", "text", 3, 1)}
