"""Whole runs: the analysis tables, the BI mart export, the model report, the KPI set.

Each run composes the operators over one set of canonical tables; outputs
are DataFrames (lazy) or written folders.  Command line::

    python -m mercato.plans.runs --csv orders=FILE payments=FILE ... --out OUT marts
    python -m mercato.plans.runs --testdata DIR --out OUT marts|analysis|models|dashboard
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from mercato.operators import cohort as co
from mercato.operators import customers as cu
from mercato.operators import evaluation as ev
from mercato.operators import features as fe
from mercato.functions.common import drop_materialized, reuse_checkpointed
from mercato.operators import marts
from mercato.operators import models as mo
from mercato.operators.fact import sales_by_order, sales_fact
from mercato.operators.report import model_report
from mercato.sources.sinks import MART_FILES, export_marts, write_parquet, write_report


def bi_marts(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The ten flat marts of the BI export (distinct-order RFM frequency)."""
    sales = reuse_checkpointed(sales_by_order(t))  # read by six marts
    out = {
        "kpi_summary": marts.kpi_summary(sales),
        "monthly_revenue": marts.monthly_revenue(sales),
        "revenue_by_state": marts.revenue_by_state(sales),
        "revenue_by_city": marts.revenue_by_city(sales),
        "payment_methods": marts.payment_methods(sales_fact(t)),
        "order_status": marts.order_status(t["orders"]),
        "top_categories": marts.top_categories(t["items"], t["products"], t["category_translation"]),
        "top_sellers": marts.top_sellers(t["items"], t["sellers"], t["reviews"]),
        "delivery_performance": marts.delivery_performance(t["orders"]),
        "rfm_segments": cu.rfm_segments(cu.rfm_scored(cu.rfm_base(sales))),
    }
    assert list(out) == MART_FILES
    return out


def analysis_tables(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The analysis run: trend, value segments, payments, geography, satisfaction, cohorts, RFM."""
    fact = sales_fact(t)
    sales = reuse_checkpointed(sales_by_order(t))
    segments = cu.customer_value_segments(fact)
    counts = co.cohort_counts(co.cohort_assignment(sales))
    retention = co.cohort_retention(counts)
    scored = cu.rfm_scored(cu.rfm_base(fact, frequency="rows"))
    return {
        "monthly_revenue": marts.monthly_revenue(sales),
        "customer_value_segments": segments,
        "value_segment_describe": cu.value_segment_describe(segments),
        "value_segment_counts": cu.value_segment_counts(segments),
        "spend_histogram": cu.spend_histogram(fact),
        "customer_value_median": cu.customer_value_median(fact),
        "payment_mix": marts.payment_mix(fact),
        "geo_top10": marts.geo_top10(sales),
        "repeat_customers": cu.repeat_customers(fact),
        "satisfaction_correlation": cu.satisfaction_correlation(fact),
        "cohort_retention": retention,
        "cohort_matrix": co.cohort_matrix(counts),
        "cohort_retention_corner": co.cohort_retention_corner(retention),
        "rfm_segments": cu.rfm_segments(scored),
        "rfm_spend_by_segment": cu.rfm_spend_by_segment(scored),
        "executive_summary": marts.executive_summary(sales),
    }


def dashboard_tables(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """KPI tiles, banner and the chart tables of the one-page dashboard."""
    fact = sales_fact(t)
    sales = reuse_checkpointed(sales_by_order(t))
    return {
        "kpi_summary": marts.kpi_summary(sales),
        "kpi_banner": marts.kpi_banner(sales, t["orders"]),
        "delivered_rate": marts.delivered_rate(t["orders"]),
        "monthly_revenue": marts.monthly_revenue(sales),
        "top_states": marts.geo_top10(sales),
        "payment_mix": marts.payment_mix(fact),
        "order_status": marts.order_status(t["orders"]),
        "review_distribution": marts.review_distribution(fact),
    }


def model_run(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Feature table -> delay forest, review forest, k-means segments, and their metrics."""
    from pyspark.sql import functions as F

    feats = reuse_checkpointed(fe.order_features(t))  # read by the three models
    delay = mo.materialize(fe.with_stratified_split(fe.delay_model_input(feats), "is_late"), "order_id", near=mo.DELAY_NEAR)
    review = mo.materialize(fe.with_split(fe.review_model_input(feats)), "order_id", near=mo.REVIEW_NEAR)
    delay_fit = mo.fit_delay_model(delay.where(F.col("split") == "train"), fe.DELAY_FEATURES)
    review_fit = mo.fit_review_model(review.where(F.col("split") == "train"), fe.REVIEW_FEATURES)
    dp = mo.predict_delay(delay_fit, delay.where(F.col("split") == "test"))
    rp = mo.predict_review(review_fit, review.where(F.col("split") == "test"))
    rfm = fe.customer_rfm_from_features(feats)
    scaled = mo.materialize(fe.standardize(rfm, rfm, mo.RFM_COLUMNS), "customer_unique_id")
    segs = mo.assign_segments(mo.fit_kmeans(scaled), scaled)
    spark = feats.sparkSession
    importances = delay_fit.importances(spark), review_fit.forest.importances(spark)
    return {
        "model_metrics": model_report(dp, rp, segs, *importances),
        "delay_predictions": dp,
        "delay_confusion_matrix": ev.confusion_matrix(dp, "is_late", "prediction"),
        "delay_roc_curve": ev.roc_curve(dp, "is_late", "score"),
        "delay_feature_importance": importances[0],
        "review_predictions": rp,
        "review_feature_importance": importances[1],
        "customer_segments": segs.drop(*[c + "_z" for c in mo.RFM_COLUMNS]),
        "cluster_profile": mo.cluster_profile(segs),
    }


def _tables(spark: SparkSession, args) -> dict[str, DataFrame]:
    if args.csv:
        from mercato.sources.landing import land_tables
        from mercato.sources.readers import load_csv_tables

        files = dict(x.split("=", 1) for x in args.csv)
        if args.max_rejected is not None:
            from mercato.operators.quarantine import load_csv_gated

            split = load_csv_gated(spark, files, args.max_rejected)
            for name, q in split.items():
                write_parquet(q.rejected, f"{args.out.rstrip('/')}/rejected/{name}")
            return land_tables(spark, sorted(files.values()), list(files), lambda: {n: q.accepted for n, q in split.items()})
        return land_tables(spark, sorted(files.values()), list(files), lambda: load_csv_tables(spark, files))
    from mercato.plans.catalog import tables

    return tables(spark, args.testdata)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", nargs="+", metavar="TABLE=FILE", help="CSV file of each canonical table")
    src.add_argument("--testdata", help="folder of the TPC-H-like test tables")
    ap.add_argument("--out", required=True)
    ap.add_argument(
        "--max-rejected",
        type=float,
        metavar="SHARE",
        help="with --csv: put rows that fail a quality rule aside under OUT/rejected; more than this share of a table stops the run",
    )
    ap.add_argument("run", choices=["marts", "analysis", "models", "dashboard"])
    args = ap.parse_args(argv)

    from mercato.session import get_session

    spark = get_session("mercato-run")
    t = _tables(spark, args)
    if args.run == "marts":
        export_marts(bi_marts(t), args.out)
        drop_materialized(spark)
        return
    frames = {"analysis": analysis_tables, "models": model_run, "dashboard": dashboard_tables}[args.run](t)
    for name, df in frames.items():
        write_parquet(df, f"{args.out.rstrip('/')}/{name}")
    if args.run == "models":
        write_report(frames["model_metrics"], f"{args.out.rstrip('/')}/model_report.txt")
    drop_materialized(spark)


if __name__ == "__main__":
    main()
