"""Whole jobs: segmentation, forecasting, churn, monitoring and retraining.

Each job takes tables, logs its run records and returns result tables, so that any scheduler can
call it as a plain function.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import UTC, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import (
    churn,
    churn_model,
    cleaning,
    density,
    drift,
    forecasting,
    runs,
    segmentation,
    series,
)
from basketry.session import cut
from basketry.sources import readers, sinks
from basketry.sources.schemas import RUNS

TARGET_RANGE = (6, 8)
MIN_SAMPLES = 10
EPS_VALUES = [round(0.2 + 0.1 * i, 1) for i in range(19)]
EXPERIMENTS = {"segments": "customer_segmentation", "forecast": "demand_forecasting", "churn": "churn_prediction"}
SEARCH_RUN, ENSEMBLE_RUN = "churn_search", "ensemble"
CHECKS = [
    ("churn", EXPERIMENTS["churn"], SEARCH_RUN, "best_test_auc", ">=", runs.AUC_TARGET),
    ("churn", EXPERIMENTS["churn"], SEARCH_RUN, "best_test_precision_at_top20pct", ">=", runs.PRECISION_TARGET),
    ("forecast", EXPERIMENTS["forecast"], ENSEMBLE_RUN, "best_ensemble_mape", "<=", runs.MAPE_TARGET),
]


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _log(table: DataFrame, path: str | None, experiment: str, name: str, params: list[str], metrics: list[str], started) -> None:
    if path is not None:
        runs.append_runs(runs.run_records(table, experiment, F.lit(name), params, metrics, started), path)


def _log_sweep(
    table: DataFrame, path: str | None, experiment: str, name: str, key: str, params: list[str], metrics: list[str],
    best: str, smallest: bool, started,
) -> None:
    """One record per configuration below one record of the sweep."""
    if path is not None:
        child = F.concat(F.lit(f"{name}_"), F.col(key).cast("string"))
        records = runs.nested_records(
            table, experiment, f"{name}_sweep", child, params, metrics, best, smallest, started
        )
        runs.append_runs(records, path)


# --- cleaning ---------------------------------------------------------------------------------


def cleaned_tables_job(raw: DataFrame, folder: str, subset: list[str] | None = None) -> dict[str, str]:
    """Write the three cleaned tables; their common parent is computed once."""
    flagged = cut(cleaning.flag_lines(cleaning.dedupe(raw, subset)))
    return sinks.write_tables(cleaning.tables_of(flagged), folder)


# --- segmentation -----------------------------------------------------------------------------


@dataclass
class Segmentation:
    segments: DataFrame
    kmeans_sweep: DataFrame
    dbscan_sweep: DataFrame | None
    chosen_k: int
    dbscan_viable: bool


def segmentation_job(
    rfm: DataFrame,
    ks: range = range(2, 13),
    n_init: int = 10,
    eps_values: list[float] | None = None,
    runs_path: str | None = None,
) -> Segmentation:
    """Sweep k-means and DBSCAN; k-means with the best k in the target range names the segments.

    DBSCAN counts as viable when some eps gives a number of clusters in the target range.
    """
    started = _now()
    scaled = cut(segmentation.scaled_rfm(rfm))
    vectors = segmentation.as_vectors(scaled).cache()
    sweep, models = segmentation.sweep_kmeans(vectors, ks, n_init=n_init)
    k = segmentation.choose_k(sweep, TARGET_RANGE)
    labelled = models[k].assign(vectors)
    segments = cut(segmentation.label_segments(labelled.drop("features", *segmentation.SCALED)))
    vectors.unpersist()
    _log_sweep(sweep, runs_path, EXPERIMENTS["segments"], "kmeans", "k", ["k"],
               ["inertia", "silhouette", "davies_bouldin"], "silhouette", False, started)
    by_eps, viable = None, False
    if eps_values:
        by_eps = density.sweep_eps(scaled, "customer_id", segmentation.SCALED, eps_values, MIN_SAMPLES)
        viable = not by_eps.filter(F.col("n_clusters").between(*TARGET_RANGE)).isEmpty()
        _log_sweep(by_eps, runs_path, EXPERIMENTS["segments"], "dbscan", "eps", ["eps"],
                   ["n_clusters", "n_noise", "noise_pct", "silhouette"], "silhouette", False, started)
    return Segmentation(segments, sweep, by_eps, k, viable)


# --- forecasting ------------------------------------------------------------------------------


def with_calendar(split: DataFrame) -> DataFrame:
    """Split series with calendar features, cut once for the model fits."""
    return cut(series.series_features(split, series.uk_holidays(split)))


def additive_job(split: DataFrame, runs_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Sweep of the additive model: metrics per series and configuration, holdout comparison."""
    started = _now()
    naive = series.naive_seasonal(split)
    metrics, predicted = forecasting.additive_sweep(split, naive)
    metrics, predicted = cut(metrics), cut(predicted)
    best = predicted.join(forecasting.best_config(metrics), ["series_id", "config"])
    comparison = best.join(naive.select("series_id", "ds", "naive"), ["series_id", "ds"]).select(
        "series_id", "ds", "actual", F.col("yhat").alias("additive_yhat"), F.col("naive").alias("naive_seasonal")
    )
    measured = ["mae", "rmse", "mape", "val_mape", "vs_naive_mape_delta"]
    over_series = metrics.groupBy("config").agg(F.count("*").alias("n_series"), *[F.avg(m).alias(m) for m in measured])
    _log_sweep(over_series, runs_path, EXPERIMENTS["forecast"], "additive_config", "config", ["config", "n_series"],
               measured, "mape", True, started)
    return metrics, comparison


def lag_job(
    features: DataFrame,
    configs: tuple[dict, ...] = forecasting.LAG_SWEEP,
    max_iter: int = 50,
    runs_path: str | None = None,
) -> tuple[DataFrame, dict, DataFrame]:
    """Sweep of the lag-window model: metrics, the configuration with the best mean validation
    MAPE, and its holdout comparison."""
    started = _now()
    metrics, models = forecasting.lag_sweep(features, configs, max_iter)
    metrics = cut(metrics)
    scores = metrics.filter("split = 'val'").groupBy("config").agg(F.avg("mape").alias("score"))
    best = scores.agg(F.min_by("config", F.struct("score", "config"))).first()[0]
    model, lookback = models[best]
    holdout = forecasting.predict_lag_model(model, forecasting.window_rows(features, lookback)).filter("split = 'test'")
    measured = ["mae", "rmse", "mape"]
    of = lambda m, part: F.avg(F.when(F.col("split") == part, F.col(m)))
    over_series = metrics.groupBy("config", *configs[0]).agg(
        F.countDistinct("series_id").alias("n_series"),
        *[of(m, "test").alias(m) for m in measured],
        of("mape", "val").alias("val_mape"),
    )
    _log_sweep(over_series, runs_path, EXPERIMENTS["forecast"], "lag_config", "config", ["config", "n_series", *configs[0]],
               [*measured, "val_mape"], "mape", True, started)
    return metrics, configs[best], holdout


def ensemble_job(
    features: DataFrame,
    config: forecasting.AdditiveConfig = forecasting.AdditiveConfig(),
    lag_config: dict = forecasting.LAG_SWEEP[0],
    max_iter: int = 50,
    runs_path: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both models on validation and holdout, weights, ensembled holdout and best strategy."""
    started = _now()
    validation, holdout = forecasting.joined_predictions(features, config, lag_config, max_iter)
    combined, metrics, _, _ = forecasting.ensemble(cut(validation), cut(holdout))
    metrics = cut(metrics)
    best = forecasting.best_strategy(metrics, runs.MAPE_TARGET)
    # The target holds for all series, so the run's figure is that of the worst one.
    worst = best.agg(
        F.max("best_ensemble_mape").alias("best_ensemble_mape"),
        F.avg("best_ensemble_mape").alias("mean_ensemble_mape"),
        F.max_by("series_id", "best_ensemble_mape").alias("worst_series"),
        F.count("*").alias("n_series"),
    )
    settings = asdict(config) | lag_config
    worst = worst.select("*", *[F.lit(value).alias(name) for name, value in settings.items()])
    _log(worst, runs_path, EXPERIMENTS["forecast"], ENSEMBLE_RUN, ["n_series", "worst_series", *settings],
         ["best_ensemble_mape", "mean_ensemble_mape"], started)
    return combined, metrics, best


def forecast_job(split: DataFrame, lag_iterations: int = 50, runs_path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sweeps, then the ensemble of the configurations they chose by validation MAPE."""
    features = with_calendar(split)
    metrics, _ = additive_job(split, runs_path)
    additive = forecasting.ADDITIVE_SWEEP[forecasting.best_config(metrics, ()).first()["config"]]
    _, lag, _ = lag_job(features, max_iter=lag_iterations, runs_path=runs_path)
    return ensemble_job(features, additive, lag, lag_iterations, runs_path)


# --- churn ------------------------------------------------------------------------------------


def churn_split(dataset: DataFrame, seed: int = 42) -> DataFrame:
    return cut(churn_model.three_way_split(cut(dataset), "customer_id", "churned", seed=seed))


def churn_sweep_job(
    split: DataFrame, configs=churn_model.TREE_SWEEP, runs_path: str | None = None
) -> tuple[DataFrame, PipelineModel]:
    """Manual sweep; the configuration with the best validation AUC is kept."""
    started = _now()
    table, models = churn_model.sweep(split, list(churn.FEATURES), "churned", configs)
    best = table.agg(F.max_by("config", F.struct("val_auc", -F.col("config")))).first()[0]
    _log_sweep(table, runs_path, EXPERIMENTS["churn"], "trees_config", "config", ["config", *asdict(configs[0])],
               ["val_auc", "auc_roc", "precision_at_top20pct"], "auc_roc", False, started)
    return table, models[best]


def churn_search_job(
    split: DataFrame,
    n_trials: int = 60,
    max_iter: tuple[int, int] = (100, 800),
    model_path: str | None = None,
    runs_path: str | None = None,
) -> tuple[DataFrame, str, PipelineModel]:
    """Search with the base and the enriched features; saves and logs the better model."""
    started = _now()
    sets = {"baseline": list(churn.FEATURES), "enriched": [*churn.FEATURES, *churn.TREND_FEATURES]}
    table, winner, model = churn_model.compare_feature_sets(
        split, sets, "churned", n_trials=n_trials, max_iter=max_iter
    )
    if model_path is not None:
        churn_model.save_model(model, model_path)
    best = table.filter(F.col("feature_set") == winner).select(
        F.col("feature_set").alias("best_feature_set"),
        F.lit(model_path).cast("string").alias("model_path"),
        F.col("auc_roc").alias("best_test_auc"),
        F.col("precision_at_top20pct").alias("best_test_precision_at_top20pct"),
    )
    _log(best, runs_path, EXPERIMENTS["churn"], SEARCH_RUN, ["best_feature_set", "model_path"],
         ["best_test_auc", "best_test_precision_at_top20pct"], started)
    return table, winner, model


# --- monitoring -------------------------------------------------------------------------------


def monitoring_job(
    spark: SparkSession, churn_snapshots: DataFrame, demand_snapshots: DataFrame, runs_path: str, log_path: str | None
) -> DataFrame:
    """Drift of both models, latest metrics against targets and retrain targets, as one row."""
    checked = cut(drift.check_drift(churn_snapshots, demand_snapshots))
    records = readers.read_table_or_empty(spark, runs_path, RUNS)
    summary = _summary(checked, _constraints(records))
    if log_path is not None:
        sinks.append_pipeline_log(summary.withColumn("dag", F.lit("daily_batch")), log_path)
    return summary


def _constraints(records: DataFrame) -> DataFrame:
    metrics = sorted({c[3] for c in CHECKS})
    checks = runs.constraints(runs.latest_runs(records, metrics), CHECKS)

    def pick(metric: str, column: str):
        return F.max(F.when(F.col("metric") == metric, F.col(column)))

    auc, precision, mape = (c[3] for c in CHECKS)
    return checks.agg(
        F.struct(
            F.struct(
                pick(auc, "value").alias("auc_roc"),
                pick(auc, "meets_target").alias("auc_meets_target"),
                pick(precision, "value").alias("precision_at_top20pct"),
                pick(precision, "meets_target").alias("precision_meets_target"),
            ).alias("churn"),
            F.struct(
                pick(mape, "value").alias("mape"), pick(mape, "meets_target").alias("mape_meets_target")
            ).alias("forecast"),
        ).alias("constraints")
    )


def _summary(checked: DataFrame, constraints: DataFrame) -> DataFrame:
    def result(model: str):
        return F.max_by(F.struct("drifted_share", "retrain_recommended"), F.col("model") == model)

    return checked.agg(
        F.struct(result("churn").alias("churn_drift"), result("forecast").alias("demand_drift")).alias("drift"),
        F.sort_array(F.collect_list(F.when(F.col("retrain_recommended"), F.col("model")))).alias("retrain_targets"),
    ).select("drift", constraints.scalar().alias("constraints"), "retrain_targets")


def retraining_job(
    spark: SparkSession,
    targets: list[str],
    churn_dataset: DataFrame,
    demand_split: DataFrame,
    runs_path: str,
    model_path: str,
    log_path: str | None = None,
    n_trials: int = 60,
    max_iter: tuple[int, int] = (100, 800),
    lag_iterations: int = 50,
) -> DataFrame:
    """Retrain the named models and report the fresh metrics against the targets."""
    if "churn" in targets:
        churn_search_job(churn_split(churn_dataset), n_trials, max_iter, model_path, runs_path)
    if "forecast" in targets:
        forecast_job(demand_split, lag_iterations, runs_path)
    after = _constraints(readers.read_table_or_empty(spark, runs_path, RUNS))
    churned = F.when(F.lit("churn" in targets), F.col("constraints.churn"))
    forecast = F.when(F.lit("forecast" in targets), F.col("constraints.forecast"))
    report = after.select(
        churned.alias("retrained_churn"),
        forecast.alias("retrained_forecast"),
        F.col("constraints").alias("constraints_after_retraining"),
    )
    if log_path is not None:
        sinks.append_pipeline_log(report.withColumn("dag", F.lit("model_retraining")), log_path)
    return report
