"""Model smoke tests (small forests) and physical-plan checks."""

from __future__ import annotations

import contextlib
import io
import os
from functools import partial

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from mercato.functions.common import materialized_folder
from mercato.functions.ranking import rank_rows
from mercato.operators import evaluation as ev
from mercato.operators import features as fe
from mercato.operators import models as mo
from mercato.plans.catalog import tables


def _plan(df) -> str:
    """The formatted physical plan, as ``df.explain`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_delay_forest_learns_and_is_repeatable(spark):
    feats = fe.order_features(tables(spark, SF_MID))
    data = mo.materialize(fe.with_split(fe.delay_model_input(feats)), "order_id")
    train, test = data.where(F.col("split") == "train"), data.where(F.col("split") == "test")
    m1 = mo.fit_delay_model(train, fe.DELAY_FEATURES, num_trees=20, max_depth=6)
    auc1 = ev.roc_auc(mo.predict_delay(m1, test), "is_late", "score").first().roc_auc
    m2 = mo.fit_delay_model(train, fe.DELAY_FEATURES, num_trees=20, max_depth=6)
    auc2 = ev.roc_auc(mo.predict_delay(m2, test), "is_late", "score").first().roc_auc
    assert auc1 > 0.7
    assert auc1 == auc2


def test_kmeans_best_of_restarts(spark):
    from mercato.plans.q_features import rfm_scaled_frame

    scaled = mo.materialize(rfm_scaled_frame(spark, SF_SMALL), "customer_unique_id")
    fitted = mo.fit_kmeans(scaled, restarts=3)
    assert fitted.cost <= min(fitted.costs) + 1e-9
    seg = mo.assign_segments(fitted, scaled)
    assert set(r.segment for r in seg.select("segment").distinct().collect()) <= set(mo.CLUSTER_NAMES_BY_SPEND)


def test_silhouette_matches_mllib_definition(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import VectorAssembler

    from mercato.plans.q_features import rfm_scaled_frame

    z = rfm_scaled_frame(spark, SF_SMALL).withColumn(
        "cluster", ((F.col("recency") > 180).cast("int") * 2 + (F.col("frequency") > 7).cast("int")).cast("double")
    )
    cols = ["recency_z", "frequency_z", "monetary_z"]
    ours = ev.silhouette_sq_euclidean(z, cols, "cluster").first().silhouette
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(z)
    mllib = ClusteringEvaluator(predictionCol="cluster").evaluate(vec)
    assert abs(ours - mllib) < 1e-9


def _tree(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return [ln for ln in buf.getvalue().splitlines() if ln.strip()]


def test_ranker_has_no_single_partition_exchange(spark):
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("v"), F.col("id"))
    ranked = rank_rows(df, ["v", "id"])
    ranked.write.format("noop").mode("overwrite").save()
    lines = _tree(ranked)
    # A single-partition exchange may only appear inside the broadcast side
    # (the offsets table: one row per partition), never above the ranked rows.
    depth = None
    for ln in lines:
        indent = len(ln) - len(ln.lstrip(" :+-"))
        if "BroadcastExchange" in ln:
            depth = indent
        if "SinglePartition" in ln:
            assert depth is not None and indent > depth, ln
    from pyspark.sql import Window

    naive = df.withColumn("r", F.row_number().over(Window.orderBy("v", "id")))
    assert any("SinglePartition" in ln for ln in _tree(naive))


def test_scan_prunes_columns_and_pushes_filters(spark, queries):
    plan = _plan(queries["delivered_rate"](spark, SF_SMALL))
    assert "ReadSchema: struct<order_status:string>" in plan
    fact_plan = _plan(queries["monthly_revenue"](spark, SF_SMALL))
    assert "payment_sequential" not in fact_plan  # unused columns never read
    assert "Bucketed: true" in fact_plan
    assert "PushedFilters: [IsNotNull(order_id)" in fact_plan


def test_cohort_matrix_matches_pandas_pivot(spark, queries):
    from mercato.operators.cohort import cohort_matrix

    counts = queries["cohort_counts"](spark, SF_SMALL)
    got = cohort_matrix(counts).toPandas().set_index("cohort")
    cells = queries["cohort_matrix"](spark, SF_SMALL).toPandas()
    long = queries["cohort_counts"](spark, SF_SMALL).toPandas()
    want = long.pivot(index="cohort", columns="period", values="customers")
    dense = want.reindex(columns=range(int(long["period"].max()) + 1))
    got_cells = cells.pivot(index="cohort", columns="period", values="customers").astype(float)
    pd.testing.assert_frame_equal(got_cells, dense.astype(float), check_names=False, check_column_type=False)
    want.columns = [f"p{c}" for c in want.columns]
    pd.testing.assert_frame_equal(got.astype(float), want.astype(float), check_names=False)


def test_forests_keep_reached_nodes_and_stay_the_same(spark):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    x = spark.range(400).select(
        F.col("id").alias("order_id"),
        *[(F.col("id") * (7 + i) % (11 + 3 * i)).cast("double").alias(f"x{i}") for i in range(4)],
        (F.col("id") * 5 % 13 > 8).cast("int").alias("is_late"),
        (F.col("id") % 5).cast("double").alias("review_score"),
    )
    train, cols = mo.materialize(x, "order_id", 2), [f"x{i}" for i in range(4)]
    delay = mo.fit_delay_model(train, cols, num_trees=5, max_depth=4).model.stages[-1]
    review = mo.fit_review_model(train, cols, num_trees=5, max_depth=4).forest.model.stages[-1]
    assert delay.getCacheNodeIds() and review.getCacheNodeIds()
    weighted = VectorAssembler(inputCols=cols, outputCol="features").transform(fe.with_class_weights(train, "is_late", "weight"))
    plain = RandomForestClassifier(labelCol="is_late", weightCol="weight", numTrees=5, maxDepth=4, seed=mo.SEED, featureSubsetStrategy="sqrt")
    trees = lambda m: m.toDebugString.split("\n", 1)[1]
    assert trees(plain.fit(weighted)) == trees(delay)


def _few(spark):
    rows = spark.range(400).select(
        F.col("id").alias("order_id"),
        *[(F.col("id") * (7 + i) % (11 + 3 * i)).cast("double").alias(f"x{i}") for i in range(4)],
        (F.col("id") * 5 % 13 > 8).cast("int").alias("is_late"),
        (F.col("id") % 5).cast("double").alias("review_score"),
    )
    return mo.materialize(rows, "order_id", 2), [f"x{i}" for i in range(4)]


def test_trees_grow_in_groups_whose_rows_fit_the_cache(spark, monkeypatch):
    assert mo._storage_memory(spark) > 0
    assert mo.tree_groups(spark, 400, 200) == [200]  # small inputs: the plain forest
    monkeypatch.setattr(mo, "_storage_memory", lambda s: 10**12)
    assert mo.tree_groups(spark, 999_999, 200) == [200]
    assert mo.tree_groups(spark, 10**7, 200) == [25] * 8
    monkeypatch.setattr(mo, "_storage_memory", lambda s: 10**9)
    for rows in (300_000, 1_700_000):
        sizes = mo.tree_groups(spark, rows, 200)
        assert sum(sizes) == 200 and max(sizes) - min(sizes) <= 1
        assert rows * (mo.CACHED_ROW_BYTES + max(sizes) * mo.CACHED_TREE_BYTES) <= 10**9
    assert min(mo.tree_groups(spark, 10**12, 200)) == mo.LEAST_TREES
    assert mo.tree_groups(spark, 10**12, 3) == [3]


def test_groups_of_trees_vote_as_one_forest(spark):
    train, cols = _few(spark)
    folder = materialized_folder(spark).removeprefix("file:")
    kept = set(os.listdir(folder))
    spark.conf.set("mercato.forest.trees", "2")
    try:
        delay = mo.fit_delay_model(train, cols, num_trees=5, max_depth=4)
        review = mo.fit_review_model(train, cols, num_trees=5, max_depth=4)
    finally:
        spark.conf.unset("mercato.forest.trees")
    assert set(os.listdir(folder)) == kept  # the vectors are gone
    assert [g.getNumTrees for g in delay.groups] == [g.getNumTrees for g in review.forest.groups] == [2, 2, 1]
    for fitted in (delay, review.forest):
        grown = [t.toDebugString.split("\n", 1)[1] for g in fitted.groups for t in g.trees]
        assert len(set(grown)) == 5  # other draws in each group

    trees = [t for g in delay.groups for t in g.trees]
    rows = delay.model.stages[0].transform(train).select("order_id", "features").limit(40).collect()
    got = {r.order_id: r for r in mo.predict_delay(delay, train).collect()}
    assert len(got) == 400
    for r in rows:
        raw = [t.predictRaw(r.features).toArray() for t in trees]
        late = sum(v[1] / v.sum() for v in raw) / 5
        assert abs(got[r.order_id].score - late) < 1e-9
        assert got[r.order_id].prediction == int(late > 0.5)

    means = {r.order_id: r for r in mo.predict_review(review, train).collect()}
    z = review.forest.model.stages[0].transform(fe.standardize(train, train, cols)).select("order_id", "features").limit(40).collect()
    trees = [t for g in review.forest.groups for t in g.trees]
    for r in z:
        assert abs(means[r.order_id].prediction - sum(t.predict(r.features) for t in trees) / 5) < 1e-9

    for fitted in (delay, review.forest):
        single = [t.featureImportances.toArray() for g in fitted.groups for t in g.trees]
        want = dict(zip(cols, sum(single) / 5))
        assert all(abs(r.importance - want[r.feature]) < 1e-9 for r in fitted.importances(spark).collect())


def test_report_builds_its_inputs_from_one_feature_table(spark, queries, monkeypatch):
    from mercato.plans import q_features, q_models

    alone = [q_models._split(spark, SF_MID, x) for x in ("delay", "review")] + [q_models._scaled(spark, SF_MID)]
    seen, build = [], q_features.order_features_frame
    for module in (q_features, q_models):
        monkeypatch.setattr(module, "order_features_frame", lambda s, d: seen.append(d) or build(s, d))
    monkeypatch.setattr(q_models, "_CACHE", {})
    monkeypatch.setattr(q_models, "MANY_ORDERS", 15_000)
    monkeypatch.setattr(mo, "fit_delay_model", partial(mo.fit_delay_model, num_trees=2, max_depth=2))
    monkeypatch.setattr(mo, "fit_review_model", partial(mo.fit_review_model, num_trees=2, max_depth=2))
    monkeypatch.setattr(mo, "fit_kmeans", partial(mo.fit_kmeans, restarts=1))
    assert queries["model_metrics"](spark, SF_MID).count() > 10
    assert seen == [SF_MID]
    shared = [q_models._split(spark, SF_MID, x) for x in ("delay", "review")] + [q_models._scaled(spark, SF_MID)]
    for a, b, key in zip(alone, shared, ("order_id", "order_id", "customer_unique_id")):
        frames = [df.toPandas().sort_values(key, ignore_index=True) for df in (a, b)]
        pd.testing.assert_frame_equal(*frames, rtol=1e-9)  # sums of doubles follow the order of the rows


def test_training_rows_lie_beside_their_like(spark):
    rows = spark.range(0, 3000, 1, 7).select(
        F.col("id").alias("order_id"), (F.col("id") * 7 % 5).alias("a"), (F.col("id") * 13 % 11).cast("double").alias("b")
    )
    once = mo.materialize(rows, "order_id", 3, near=["a", "b"])
    again = mo.materialize(rows.repartition(5, "b"), "order_id", 3, near=["a", "b"])
    listed = lambda df: sorted([tuple(r) for r in g] for g in _by_file(df))
    assert listed(once) == listed(again)  # whatever order the rows came in
    assert all([r[1:] + r[:1] for r in g] == sorted(r[1:] + r[:1] for r in g) for g in listed(once))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, rows.collect()))


def _by_file(df):
    """Rows of each written file in their order."""
    import pyarrow.parquet as pq

    return [[tuple(r.values()) for r in pq.read_table(f.removeprefix("file:")).to_pylist()] for f in df.inputFiles()]


def test_split_of_the_rule_carries_its_columns_only(spark, queries, monkeypatch):
    from mercato.plans import q_features

    seen = []
    split = q_features.fe.with_stratified_split
    monkeypatch.setattr(q_features.fe, "with_stratified_split", lambda df, *a, **k: seen.append(df.columns) or split(df, *a, **k))
    queries["confusion_matrix"](spark, SF_MID)
    queries["train_test_split_balance"](spark, SF_MID)
    assert seen == [["order_id", "purchase_month", "estimated_delivery_days", "is_late"], ["order_id", "is_late"]]
