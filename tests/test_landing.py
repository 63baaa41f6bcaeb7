"""Landing on demand: only what is read is written, once, and found again by another reader of the same files."""

from __future__ import annotations

import os
import tempfile

from conftest import SF_SMALL
from mercato.operators import features as fe
from mercato.plans.catalog import tables
from mercato.sources import landing
from mercato.sources.roles import RAW_TABLES, load_role_tables


def _folders(root):
    return sorted(n for t in os.listdir(root) for n in os.listdir(os.path.join(root, t)))


def test_one_table_is_landed_once(spark, queries):
    old = spark.conf.get("mercato.landing.dir", None)
    root = tempfile.mkdtemp(prefix="mercato-land-")
    paths = [f"{SF_SMALL}/{t}.parquet" for t in RAW_TABLES]
    try:
        spark.conf.set("mercato.landing.dir", root)
        files = landing.source_files(spark, paths)
        assert len(files) == len(RAW_TABLES)

        def fresh(f=files):
            return landing.LandedTables(spark, ["orders", "payments"], lambda: load_role_tables(spark, SF_SMALL), f)

        other = [(p, n + 1, t) for p, n, t in files]
        first = fresh(other)
        n = first["orders"].count()
        assert _folders(root) == ["orders"]
        written = {f: os.path.getmtime(f) for d, _, fs in os.walk(root) for f in [os.path.join(d, x) for x in fs]}
        name = first["orders"]._jdf.queryExecution().analyzed().toString()
        table = next(t.name for t in spark.catalog.listTables() if t.name.endswith("_orders") and t.name in name)
        # As in another session: the catalog knows nothing, the files are there.
        spark.sql(f"DROP TABLE {table}")
        again = fresh(other)["orders"]
        assert again.count() == n and again.schema == first["orders"].schema
        assert {f: os.path.getmtime(f) for f in written} == written
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        assert described["Num Buckets"] == str(first.n) and described["Bucket Columns"] == "[`order_id`]"
        changed = fresh([(p, n + 2, t) for p, n, t in files])["orders"]
        assert changed.count() == n and _folders(root) == ["orders", "orders"]
    finally:
        if old is None:
            spark.conf.unset("mercato.landing.dir")
        else:
            spark.conf.set("mercato.landing.dir", old)


def test_buckets_follow_the_size(spark):
    assert landing._buckets(spark, 100 << 40) == 102_400
    assert landing._buckets(spark, 1) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_unknown_table(spark):
    t = tables(spark, SF_SMALL)
    assert "orders" in t and "nothing" not in t


def test_tables_land_side_by_side(spark, tmp_path):
    from mercato.sources.landing import LandedTables

    spark.conf.set("mercato.landing.dir", str(tmp_path))
    try:
        build = lambda: {n: spark.range(50).selectExpr("id as order_id", f"id + {i} as v") for i, n in enumerate(("orders", "payments", "other"))}
        t = LandedTables(spark, ["orders", "payments", "other"], build, [(str(tmp_path), 1, 1)])
        assert {n: df.agg({"v": "sum"}).first()[0] for n, df in t.items()} == {"orders": 1225, "payments": 1275, "other": 1325}
        assert len(t.frames) == 3 and [df.count() for df in t.values()] == [50, 50, 50]
    finally:
        spark.conf.unset("mercato.landing.dir")


def test_feature_queries_land_nothing_of_their_own(spark, queries, tmp_path):
    spark.conf.set("mercato.landing.dir", str(tmp_path))
    files = landing.source_files(spark, [f"{SF_SMALL}/{t}.parquet" for t in RAW_TABLES])
    names = ["orders", "items", "payments", "reviews", "products", "customers"]
    t = landing.LandedTables(spark, names, lambda: load_role_tables(spark, SF_SMALL), [(p, n + 7, m) for p, n, m in files])
    try:
        fresh = fe.order_features(t.at_hand(fe.FEATURE_TABLES))
        rows = fresh.count()
        assert rows > 0 and not os.listdir(tmp_path) and not t.frames
        t.land(["items", "orders"])
        mixed = fe.order_features(t.at_hand(fe.FEATURE_TABLES))
        assert _folders(tmp_path) == ["items", "orders"]
        assert mixed.count() == rows and fresh.exceptAll(mixed).isEmpty()
        # As in another session: the rows on disk are found.
        t.frames.clear()
        assert t.at_hand(["items"])["items"]._jdf.queryExecution().analyzed().toString().count("_items")
    finally:
        spark.conf.unset("mercato.landing.dir")


def test_feature_frame_reads_tables_at_hand(monkeypatch):
    from mercato.plans import q_features

    asked = []

    class Tables(dict):
        def at_hand(self, names):
            asked.extend(names)
            return {n: n for n in names}

    monkeypatch.setattr(q_features, "tables", lambda spark, d: Tables())
    monkeypatch.setattr(q_features.fe, "order_features", sorted)
    assert q_features.order_features_frame(None, "x") == sorted(asked) == sorted(fe.FEATURE_TABLES)


def test_first_product_of_an_order(spark):
    rows = [(1, 2, "b"), (1, 1, None), (1, 3, "a"), (2, 1, None), (3, None, "z"), (3, 1, "y"), (4, 1, "q"), (4, 1, "p")]
    items = spark.createDataFrame(rows, "order_id int, order_item_id int, product_id string").selectExpr(
        "*", "cast(1.5 as decimal(18,2)) price", "cast(0.5 as decimal(18,2)) freight_value"
    )
    got = {r["order_id"]: (r["product_id"], r["n_items"], r["price"]) for r in fe.order_item_rollup(items).collect()}
    assert got == {1: ("b", 3, 4.5), 2: (None, 1, 1.5), 3: ("z", 1, 3.0), 4: ("p", 2, 3.0)}
