"""The refresh by differences: any landing order, retries, restarts, touched buckets only, distinct sketches."""

from __future__ import annotations

import random
import tempfile
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mercato.operators import marts
from mercato.operators.fact import sales_fact
from mercato.streaming.incremental import RevenueRefresh

SCHEMAS = {
    "customers": "customer_id long, customer_unique_id long, customer_city string, customer_state string",
    "orders": "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz",
    "payments": "order_id long, payment_value decimal(18,2)",
    "reviews": "review_id long, order_id long, review_score int",
}


def rows_of(rng):
    customers = [(c, c // 2, "city", rng.choice(("A", "B", None))) for c in range(12)]
    # Customer 3 has a third of all orders; orders 38 and 39 have no customer.
    orders = [(k, 3 if k % 3 == 0 else rng.randrange(14), "delivered", datetime(2020, 1 + k % 4, 5)) for k in range(38)]
    orders += [(38, None, "delivered", datetime(2020, 1, 1)), (39, 99, "delivered", datetime(2020, 1, 1))]
    payments = [(rng.randrange(44), Decimal(rng.randrange(1, 9000)) / 100) for _ in range(60)] + [(None, Decimal("5.00"))]
    reviews = [(i, rng.randrange(44), 1 + i % 5) for i in range(40)] + [(99, None, 1)]
    return {"customers": customers, "orders": orders, "payments": payments, "reviews": reviews}


def frames(spark, rows):
    return {n: spark.createDataFrame(r, SCHEMAS[n]) for n, r in rows.items()}


def new_refresh(spark, root=None, buckets=4):
    empty = {n: spark.createDataFrame([], s).schema for n, s in SCHEMAS.items()}
    return RevenueRefresh(spark, root or tempfile.mkdtemp(prefix="mercato-stream-"), empty, buckets)


def mart_of(refresh):
    return {r["order_month"]: r["revenue"] for r in refresh.mart().collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_landing_order_equals_the_batch_mart(spark, seed):
    rng = random.Random(seed)
    rows = rows_of(rng)
    batches = []
    for name, r in rows.items():
        cut = rng.randrange(1, len(r))
        batches += [(name, r[:cut]), (name, r[cut:])]
    rng.shuffle(batches)
    refresh, epochs = new_refresh(spark), dict.fromkeys(SCHEMAS, -1)
    for name, r in batches:
        epochs[name] += 1
        batch = spark.createDataFrame(r, SCHEMAS[name])
        refresh.apply(name, batch, epochs[name])
        if rng.random() < 0.5:
            refresh.apply(name, batch, epochs[name])  # retried after its commit
    fact = sales_fact(frames(spark, rows))
    want = {r["order_month"]: r["revenue"] for r in marts.monthly_revenue(fact).collect()}
    assert mart_of(refresh) == want and want
    states = fact.where("customer_state is not null").groupBy("customer_state").agg(F.countDistinct("customer_unique_id").alias("n"))
    # A few persons are counted exactly by the sketches.
    assert {r[0]: r[1] for r in refresh.persons_by_state().where("customer_state is not null").collect()} == {r[0]: r["n"] for r in states.collect()}
    spring = fact.where("order_month between '2020-02' and '2020-03' and customer_state = 'A'").select("customer_unique_id").distinct().count()
    got = {r[0]: r[1] for r in refresh.persons_by_state("2020-02", "2020-03").collect()}
    assert got.get("A", 0) == spring


def test_failed_batches_and_restarts(spark):
    rows = rows_of(random.Random(5))
    t = frames(spark, rows)
    refresh = new_refresh(spark)
    for name in ("orders", "payments"):
        refresh.apply(name, t[name], 0)
    assert mart_of(refresh) == {}
    commit = refresh._commit
    refresh._commit = lambda m: (_ for _ in ()).throw(RuntimeError("lost before the commit"))
    with pytest.raises(RuntimeError):
        refresh.apply("customers", t["customers"], 0)
    refresh._commit = commit
    refresh.apply("reviews", t["reviews"].limit(0), 0)  # another stream takes the version over
    again = new_refresh(spark, refresh.root)  # a new process finds the committed state
    assert again.manifest == refresh.manifest and again.manifest.version == 2
    again.apply("customers", t["customers"], 0)
    again.apply("reviews", t["reviews"], 1)
    fact = sales_fact(t)
    assert mart_of(again) == {r["order_month"]: r["revenue"] for r in marts.monthly_revenue(fact).collect()}


def test_an_order_that_lands_again_moves(spark):
    refresh = new_refresh(spark)
    refresh.apply("customers", spark.createDataFrame([(1, 1, "c", "s")], SCHEMAS["customers"]), 0)
    refresh.apply("payments", spark.createDataFrame([(7, Decimal("10.00"))], SCHEMAS["payments"]), 0)
    order = lambda month, customer=1: spark.createDataFrame([(7, customer, "x", datetime(2020, month, 1))], SCHEMAS["orders"])
    refresh.apply("orders", order(1), 0)
    assert mart_of(refresh) == {"2020-01": 10.0}
    refresh.apply("orders", order(2), 1)
    assert mart_of(refresh) == {"2020-02": 10.0}
    refresh.apply("orders", order(2, customer=5), 2)  # a customer that has not landed
    assert mart_of(refresh) == {}
    refresh.apply("customers", spark.createDataFrame([(5, 5, "c", "s")], SCHEMAS["customers"]), 1)
    assert mart_of(refresh) == {"2020-02": 10.0}


def test_a_batch_reads_its_buckets_only(spark):
    rows = rows_of(random.Random(3))
    t = frames(spark, rows)
    refresh = new_refresh(spark, buckets=8)
    for name in ("customers", "orders", "payments"):
        refresh.apply(name, t[name], 0)
    before = dict(refresh.manifest.buckets["orders"])
    assert len(before) > 4
    batch = spark.createDataFrame([(100, 6, 5)], SCHEMAS["reviews"])
    touched = refresh._buckets_of(batch, "order_id")
    files = refresh._read("orders", refresh.manifest, touched).inputFiles()
    assert len(touched) == 1 and files and all(f"/bucket={touched[0]}/" in f for f in files)
    seen, read = [], refresh._read
    refresh._read = lambda table, m, buckets=None: seen.append((table, buckets)) or read(table, m, buckets)
    refresh.apply("reviews", batch, 0)
    assert {tuple(b) for table, b in seen if table == "orders"} == {tuple(touched)}
    assert not any(table == "customers" for table, _ in seen)
    after = refresh.manifest.buckets["orders"]
    assert {b for b in after if after[b] != before.get(b)} == set(touched)
    # The landed batches themselves are not kept.
    fs, p = refresh._fs(refresh.root)
    assert {s.getPath().getName() for s in fs.listStatus(p)} <= {"orders", "customers", "months", "persons", "manifest", "deltas"}


def test_months_are_refreshed_without_a_join(spark, monkeypatch):
    refresh, plans = new_refresh(spark, buckets=1), []
    months = refresh._refresh_months

    def refreshed(written, old, m):
        plans.append(written._jdf.queryExecution().optimizedPlan().toString())
        months(written, old, m)

    monkeypatch.setattr(refresh, "_refresh_months", refreshed)
    rows = rows_of(random.Random(3))
    for name in ("payments", "reviews", "customers", "orders"):
        refresh.apply(name, spark.createDataFrame(rows[name], SCHEMAS[name]), 0)
    # A second payment of one order: the bucket's other orders are written again and must add nothing.
    refresh.apply("payments", spark.createDataFrame([(4, Decimal("7.25"))], SCHEMAS["payments"]), 1)
    assert len(plans) == 5 and not any("Join" in p for p in plans)
    rows["payments"].append((4, Decimal("7.25")))
    batch = frames(spark, rows)
    want = {r["order_month"]: r["revenue"] for r in marts.monthly_revenue(sales_fact(batch)).collect()}
    assert mart_of(refresh) == want
    by_state = {r["customer_state"]: r["persons"] for r in refresh.persons_by_state().collect() if r["customer_state"]}
    fact = sales_fact(batch).where(F.col("customer_state").isNotNull()).groupBy("customer_state")
    assert by_state == {r[0]: r[1] for r in fact.agg(F.countDistinct("customer_unique_id")).collect()}
