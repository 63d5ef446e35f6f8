"""Registered queries that fit models on the whole test tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from basketry.functions.expressions import product_label, stock_code_of
from basketry.operators import (
    churn,
    churn_model,
    daily,
    density,
    drift,
    forecasting,
    rfm,
    runs,
    segmentation,
    series,
    stationarity,
)
from basketry.plans import jobs
from basketry.plans import prepared as P
from basketry.plans.retail_queries import QUERIES, query
from basketry.session import cut, scratch_path
from basketry.sources import readers, sinks
from basketry.sources.schemas import RAW, RUNS


def _scaled(spark, sf_dir):
    return segmentation.scaled_rfm(rfm.compute_rfm(P.customers(spark, sf_dir)))


def _split_series(spark, sf_dir):
    return series.train_test_split(P.demand(spark, sf_dir), P.TEST_DAYS, P.VALIDATION_DAYS)


def _dataset(spark, sf_dir):
    return churn.enriched_dataset(P.customers(spark, sf_dir), P.CUTOFF, home_country=P.HOME)


def _churn_split(spark, sf_dir):
    return jobs.churn_split(_dataset(spark, sf_dir))


def _churn_fit(split) -> PipelineModel:
    features = [*churn.FEATURES, *churn.TREND_FEATURES]
    return churn_model.fit_trees(split, features, "churned", churn_model.TREE_SWEEP[0])


@query
def strat_split(spark, sf_dir):
    table = churn.churn_labels(P.customers(spark, sf_dir), P.CUTOFF)
    return churn_model.stratified_split(table, "customer_id", "churned", 0.2)


@query
def kmeans_sweep(spark, sf_dir):
    vectors = segmentation.as_vectors(cut(_scaled(spark, sf_dir))).cache()
    sweep, _ = segmentation.sweep_kmeans(vectors)
    vectors.unpersist()
    return sweep


@query
def kmeans_segments(spark, sf_dir):
    table = rfm.compute_rfm(P.customers(spark, sf_dir))
    return jobs.segmentation_job(table).segments


@query
def dbscan(spark, sf_dir):
    scaled = cut(_scaled(spark, sf_dir))
    return density.dbscan(scaled, "customer_id", segmentation.SCALED, 0.3, jobs.MIN_SAMPLES)


@query
def dbscan_sweep(spark, sf_dir):
    """All radii, and whether the density clustering is viable with one of them."""
    scaled = cut(_scaled(spark, sf_dir))
    table = density.sweep_eps(scaled, "customer_id", segmentation.SCALED, jobs.EPS_VALUES, jobs.MIN_SAMPLES)
    return table.withColumn("viable", F.col("n_clusters").between(*jobs.TARGET_RANGE))


@query
def pca2(spark, sf_dir):
    table, explained = segmentation.project_2d(segmentation.as_vectors(_scaled(spark, sf_dir)))
    return table.withColumns({"explained_1": F.lit(explained[0]), "explained_2": F.lit(explained[1])})


@query
def stationarity_report(spark, sf_dir):
    flagged = P.daily_flagged(spark, sf_dir, "country")
    long = None
    for column in ("quantity", "revenue"):
        rows = daily.demand_series(flagged, column).withColumn("column", F.lit(column))
        long = rows if long is None else long.unionByName(rows)
    return stationarity.diagnostics(long).select(
        "series_id", "column", "n_observations", "level_verdict", "diff1_verdict",
        F.col("adf_level.statistic").alias("adf_level"), F.col("kpss_level.statistic").alias("kpss_level"),
        F.col("adf_diff1.statistic").alias("adf_diff1"), F.col("kpss_diff1.statistic").alias("kpss_diff1"),
    )


QUERIES["stationarity"] = QUERIES.pop("stationarity_report")


@query
def additive_forecast(spark, sf_dir):
    return jobs.additive_job(cut(_split_series(spark, sf_dir)))[0]


@query
def lag_model(spark, sf_dir):
    features = jobs.with_calendar(_split_series(spark, sf_dir))
    return jobs.lag_job(features)[0]


@query
def ensemble_run(spark, sf_dir):
    """The ensemble of the configurations that both sweeps chose."""
    return jobs.forecast_job(cut(_split_series(spark, sf_dir)))[0]


@query
def whatif_forecast(spark, sf_dir):
    history = cut(P.demand(spark, sf_dir))
    config = (forecasting.AdditiveConfig(),)
    coefs, spans = forecasting.fit_additive(history, config)
    future = forecasting.predict_additive(forecasting.future_dates(history, 30), coefs, spans, config)
    return forecasting.what_if(future, 10)


@query
def gbt_churn(spark, sf_dir):
    return jobs.churn_sweep_job(_churn_split(spark, sf_dir))[0]


@query
def churn_search(spark, sf_dir):
    return jobs.churn_search_job(_churn_split(spark, sf_dir))[0]


@query
def feature_importance(spark, sf_dir):
    split = _churn_split(spark, sf_dir)
    contributions = churn_model.shapley_values(
        _churn_fit(split), split.filter("split = 'test'"), split.filter("split = 'train'")
    )
    return churn_model.feature_importance(contributions)


@query
def risk_scores(spark, sf_dir):
    path = scratch_path(spark, "churn_model")
    churn_model.save_model(_churn_fit(_churn_split(spark, sf_dir)), path)
    model = churn_model.load_model(spark, path, spark.createDataFrame([], RUNS), jobs.SEARCH_RUN)
    return churn_model.score_customers(model, _dataset(spark, sf_dir).drop("churned"))


@query
def runs_append(spark, sf_dir):
    path = scratch_path(spark, "runs")
    jobs.additive_job(cut(_split_series(spark, sf_dir)), path)
    records = readers.read_table_or_empty(spark, path, RUNS)
    return runs.best_run(records, "mape")


@query
def monitoring(spark, sf_dir):
    """Drift of both models, and the targets against records that the ensemble job wrote before."""
    from basketry.plans.retail_queries import _churn_snapshots, _demand_snapshots

    records = scratch_path(spark, "runs")
    jobs.forecast_job(cut(_split_series(spark, sf_dir)), runs_path=records)
    summary = jobs.monitoring_job(
        spark, _churn_snapshots(spark, sf_dir), _demand_snapshots(spark, sf_dir), records, scratch_path(spark, "log"),
    )
    return summary.select(
        F.round("drift.churn_drift.drifted_share", 6).alias("drifted_share"),
        "drift.churn_drift.retrain_recommended",
        F.round("drift.demand_drift.drifted_share", 6).alias("demand_drifted_share"),
        F.array_join("retrain_targets", ",").alias("retrain_targets"),
        F.col("constraints.forecast.mape").isNotNull().alias("mape_known"),
        F.col("constraints.churn.auc_roc").isNull().alias("churn_without_run"),
    )


@query
def retraining(spark, sf_dir):
    """The models that drift asks to retrain are retrained; their fresh metrics against the targets."""
    from basketry.plans.retail_queries import _checked

    targets = [r["model"] for r in drift.retrain_targets(_checked(spark, sf_dir)).collect()]  # at most two
    dataset = _dataset(spark, sf_dir) if "churn" in targets else None
    report = jobs.retraining_job(
        spark, targets, dataset, cut(_split_series(spark, sf_dir)), scratch_path(spark, "runs"),
        scratch_path(spark, "model"), scratch_path(spark, "log"),
    )
    return report.select(
        F.lit(",".join(sorted(targets))).alias("targets"),
        F.col("retrained_churn.auc_roc").alias("auc_roc"),
        F.col("retrained_forecast.mape").alias("mape"),
    )


# --- stored tables ------------------------------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    """Raw lines written as a CSV extract and read back by its header and suffix."""
    path = scratch_path(spark, "extract") + ".csv"
    sinks.export_csv(P.raw_lines(spark, sf_dir), RAW.fieldNames(), path)
    return readers.read_extract(spark, path)


@query
def cleaned_tables(spark, sf_dir):
    """The cleaned tables as written: rows, pieces and revenue of each."""
    written = jobs.cleaned_tables_job(P.raw_lines(spark, sf_dir), scratch_path(spark, "cleaned"))
    out = None
    for name, path in written.items():
        rows = spark.read.parquet(path).agg(
            F.lit(name).alias("table"), F.count("*").alias("n_rows"), F.sum("quantity").alias("quantity"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query
def audit_log(spark, sf_dir):
    """Two monitoring summaries appended to the log and read back."""
    from basketry.plans.retail_queries import _churn_snapshots, _demand_snapshots

    log = scratch_path(spark, "log")
    for _ in range(2):
        jobs.monitoring_job(
            spark, _churn_snapshots(spark, sf_dir), _demand_snapshots(spark, sf_dir), scratch_path(spark, "runs"), log
        )
    entries = readers.read_pipeline_log(spark, log)
    return entries.groupBy("dag").agg(
        F.count("*").alias("n_entries"),
        F.round(F.max("drift.churn_drift.drifted_share"), 6).alias("churn_share"),
        F.round(F.max("drift.demand_drift.drifted_share"), 6).alias("demand_share"),
    )


@query
def artifact_status(spark, sf_dir):
    """The tables of the input folder and one that nobody wrote."""
    names = ["customer", "lineitem", "orders", "events", "nothing_here"]
    return readers.artifact_status(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})


@query
def product_labels(spark, sf_dir):
    """Labels of the recommended products, and the codes taken back out of them."""
    from basketry.plans.retail_queries import _recommended

    label = product_label(F.col("stock_code"), F.col("description"))
    return _recommended(spark, sf_dir).select("stock_code", label.alias("label"), stock_code_of(label).alias("code"))


@query
def additive_total(spark, sf_dir):
    """The additive sweep for the total series."""
    split = series.train_test_split(P.demand(spark, sf_dir, None), P.TEST_DAYS, P.VALIDATION_DAYS)
    return jobs.additive_job(cut(split))[0]
