"""Additive regression and lag-window forecasts for many series, ensembles and what-if totals.

Design matrices are column expressions; only the ridge solve of one series runs in numpy.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators import evaluation
from basketry.operators.series import lag_windows, scale_series, uk_holidays, unscale
from basketry.session import cut

CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
WEEKLY_ORDER, YEARLY_ORDER = 3, 10
SEASONAL_PRIOR = HOLIDAY_PRIOR = 10.0
TREND_PRIOR = 5.0
# Order of the holiday columns.
HOLIDAYS = (
    "New Year's Day", "Good Friday", "Easter Monday", "May Day", "Spring Bank Holiday",
    "Late Summer Bank Holiday", "Christmas Day", "Boxing Day",
)


@dataclass(frozen=True)
class AdditiveConfig:
    changepoint_prior_scale: float = 0.05
    seasonality_mode: str = "additive"
    holidays: bool = True
    saturday_regressor: bool = False


# The sweep of the additive model.
ADDITIVE_SWEEP = (
    AdditiveConfig(0.05, "additive"),
    AdditiveConfig(0.05, "multiplicative"),
    AdditiveConfig(0.5, "additive"),
    AdditiveConfig(0.01, "additive"),
    AdditiveConfig(0.05, "additive", saturday_regressor=True),
)
# Lookbacks and tree depths tried by the lag-window model.
LAG_SWEEP = ({"lookback": 14, "depth": 3}, {"lookback": 14, "depth": 5},
             {"lookback": 28, "depth": 3}, {"lookback": 28, "depth": 5})
WINDOW_FEATURES = ("y_scaled", "dow_sin", "dow_cos", "is_saturday", "is_uk_holiday")


# --- additive regression ----------------------------------------------------------------------


def _fourier(days: Column, period: float, order: int) -> list[Column]:
    angle = days * (2 * math.pi / period)
    return [f(angle * k) for k in range(1, order + 1) for f in (F.sin, F.cos)]


def additive_design(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Adds ``x``, the design row: trend, hinges, weekly and yearly waves, holidays, Saturday.

    ``spans`` holds each series' first day, last fitted day and scale (``fitted_spans``).
    """
    calendar = uk_holidays(rows)
    flags = calendar.groupBy(F.col("date").alias("ds")).agg(
        F.array(*[F.max((F.col("name") == h).cast("double")) for h in HOLIDAYS]).alias("_holidays")
    )
    days = F.datediff("ds", F.lit("1970-01-01").cast("date"))
    t = F.col("_t")
    hinges = [
        F.greatest(t - CHANGEPOINT_RANGE * j / CHANGEPOINTS, F.lit(0.0)) for j in range(1, CHANGEPOINTS + 1)
    ]
    waves = _fourier(days, 7, WEEKLY_ORDER) + _fourier(days, 365.25, YEARLY_ORDER)
    no_holiday = F.array(*[F.lit(0.0)] * len(HOLIDAYS))
    return (
        rows.join(spans, "series_id")
        .join(F.broadcast(flags), "ds", "left")  # a few days per year
        .withColumn("_t", F.datediff("ds", "first_ds") / F.greatest(F.datediff("last_ds", "first_ds"), F.lit(1)))
        .withColumn(
            "x",
            F.concat(
                F.array(F.lit(1.0), t, *hinges, *waves),
                F.coalesce("_holidays", no_holiday),
                F.array((F.weekday("ds") == 5).cast("double")),
            ),
        )
        .drop("_t", "_holidays", "first_ds", "last_ds")
    )


def fitted_spans(history: DataFrame) -> DataFrame:
    """First and last day and the largest absolute value of every fitted series."""
    return history.groupBy("series_id").agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.greatest(F.max(F.abs("y")), F.lit(1e-9)).alias("y_scale"),
    )


def _prior_scales(config: AdditiveConfig) -> np.ndarray:
    off = 1e-6
    return np.array(
        [TREND_PRIOR, TREND_PRIOR]
        + [config.changepoint_prior_scale] * CHANGEPOINTS
        + [SEASONAL_PRIOR] * (2 * WEEKLY_ORDER + 2 * YEARLY_ORDER)
        + [HOLIDAY_PRIOR if config.holidays else off] * len(HOLIDAYS)
        + [SEASONAL_PRIOR if config.saturday_regressor else off]
    )


def ridge(x: np.ndarray, y: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """Normal prior on every coefficient; the noise variance is re-estimated in three rounds."""
    gram, moment = x.T @ x, x.T @ y
    noise = max(float(np.var(y)) * 0.25, 1e-8)
    for _ in range(3):
        coef = np.linalg.solve(gram + np.diag(noise / scales**2), moment)
        noise = max(float(np.mean((y - x @ coef) ** 2)), 1e-8)
    return coef


def fit_additive(
    history: DataFrame, configs: tuple[AdditiveConfig, ...] = ADDITIVE_SWEEP
) -> tuple[DataFrame, DataFrame]:
    """Coefficients of every series under every configuration, and the series' spans.

    One group is one series: at most one row per calendar day.
    """
    spans = fitted_spans(history)
    design = additive_design(history, spans).select("series_id", "x", (F.col("y") / F.col("y_scale")).alias("v"))

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        x, v = np.vstack(group["x"].to_numpy()), group["v"].to_numpy(dtype=float)
        found = []
        for i, config in enumerate(configs):
            target = np.log1p(np.maximum(v, 0.0)) if config.seasonality_mode == "multiplicative" else v
            coef = ridge(x, target, _prior_scales(config))
            found.append((group["series_id"].iloc[0], i, coef.tolist()))
        return pd.DataFrame(found, columns=["series_id", "config", "coef"])

    coefs = design.groupBy("series_id").applyInPandas(
        solve, "series_id string, config int, coef array<double>"
    )
    return coefs, spans


def predict_additive(
    dates: DataFrame, coefs: DataFrame, spans: DataFrame, configs: tuple[AdditiveConfig, ...] = ADDITIVE_SWEEP
) -> DataFrame:
    """``yhat`` for every date, series and configuration of ``coefs``."""
    logged = [i for i, c in enumerate(configs) if c.seasonality_mode == "multiplicative"]
    product = F.zip_with("x", "coef", lambda a, b: a * b)
    value = F.aggregate(product, F.lit(0.0), lambda acc, p: acc + p)
    value = F.when(F.col("config").isin(logged or [-1]), F.expm1(value)).otherwise(value)
    return (
        additive_design(dates, spans)
        .join(coefs, "series_id")
        .withColumn("yhat", value * F.col("y_scale"))
        .drop("x", "coef", "y_scale")
    )


def additive_sweep(
    split: DataFrame, naive: DataFrame, configs: tuple[AdditiveConfig, ...] = ADDITIVE_SWEEP
) -> tuple[DataFrame, DataFrame]:
    """Metrics per series and configuration, and the holdout predictions.

    The holdout is predicted from everything before it. ``val_mape`` comes from a fit on the train
    rows alone and is NULL without validation rows. ``naive`` has the seasonal-naive holdout
    forecast; each configuration's MAPE difference to it is added.
    """

    def predictions(fit_on: str, part: str) -> DataFrame:
        coefs, spans = fit_additive(split.filter(fit_on), configs)
        rows = split.filter(F.col("split") == part).select("series_id", "ds", F.col("y").alias("actual"))
        return predict_additive(rows, coefs, spans, configs)

    def metrics(predicted: DataFrame, *columns) -> DataFrame:
        return predicted.groupBy("series_id", "config").agg(*columns)

    measures = evaluation.forecast_metrics(F.col("actual"), F.col("yhat"))
    predicted = predictions("split <> 'test'", "test")
    validation = metrics(predictions("split = 'train'", "val"), measures[2].alias("val_mape"))
    base = naive.groupBy("series_id").agg(
        evaluation.forecast_metrics(F.col("y"), F.col("naive"))[2].alias("naive_mape")
    )
    compared = (
        metrics(predicted, *measures)
        .join(validation, ["series_id", "config"], "left")
        .join(base, "series_id")
        .withColumn("vs_naive_mape_delta", F.col("mape") - F.col("naive_mape"))
    )
    return compared, predicted


def best_config(metrics: DataFrame, by: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """Configuration with the lowest validation MAPE, the first one on a tie.

    Without validation rows the holdout MAPE decides.
    """
    score = F.avg(F.coalesce("val_mape", "mape")).alias("score")
    scored = metrics.groupBy(*by, "config").agg(score)
    return scored.groupBy(*by).agg(F.min_by("config", F.struct("score", "config")).alias("config"))


# --- lag-window model -------------------------------------------------------------------------


def window_rows(features: DataFrame, lookback: int, columns: tuple[str, ...] = WINDOW_FEATURES) -> DataFrame:
    """Scaled lag windows as vectors; ``features`` has split and calendar columns."""
    windows = lag_windows(scale_series(features), lookback, columns)
    return windows.withColumn("features", array_to_vector(F.flatten("window"))).drop("window")


def fit_lag_model(rows: DataFrame, depth: int = 5, max_iter: int = 50, seed: int = 42) -> GBTRegressionModel:
    """One boosted-tree model over the windows of all series; stops on validation loss."""
    fitting = rows.filter("split <> 'test'").withColumn("is_val", F.col("split") == "val")
    return GBTRegressor(
        featuresCol="features", labelCol="y_scaled", validationIndicatorCol="is_val", maxDepth=depth,
        maxIter=max_iter, stepSize=0.1, subsamplingRate=0.8, seed=seed,
    ).fit(fitting)


def predict_lag_model(model: GBTRegressionModel, rows: DataFrame) -> DataFrame:
    """Predictions in demand units, never negative."""
    return model.transform(rows).select(
        "series_id", "ds", "split", F.col("y").alias("actual"), unscale(F.col("prediction")).alias("yhat")
    )


def lag_sweep(
    features: DataFrame, configs: tuple[dict, ...] = LAG_SWEEP, max_iter: int = 50, seed: int = 42
) -> tuple[DataFrame, list[tuple[GBTRegressionModel, int]]]:
    """Validation and holdout metrics of every (lookback, depth), and the fitted models."""
    rows = {b: cut(window_rows(features, b)) for b in {c["lookback"] for c in configs}}

    def fit(config: dict) -> GBTRegressionModel:
        return fit_lag_model(rows[config["lookback"]], config["depth"], max_iter, seed)

    with ThreadPoolExecutor(len(configs)) as pool:
        models = list(pool.map(fit, configs))
    out = None
    for i, (config, model) in enumerate(zip(configs, models, strict=True)):
        metrics = (
            predict_lag_model(model, rows[config["lookback"]])
            .filter("split <> 'train'")
            .groupBy("series_id", "split")
            .agg(*evaluation.forecast_metrics(F.col("actual"), F.col("yhat")))
            .select(F.lit(i).alias("config"), *[F.lit(v).alias(k) for k, v in config.items()], "*")
        )
        out = metrics if out is None else out.unionByName(metrics)
    return out, [(m, c["lookback"]) for m, c in zip(models, configs, strict=True)]


# --- ensemble and what-if ---------------------------------------------------------------------


def joined_predictions(
    features: DataFrame, config: AdditiveConfig, lag_config: dict, max_iter: int = 50
) -> tuple[DataFrame, DataFrame]:
    """Validation and holdout predictions of both models, joined by series and date.

    For the validation rows both models see the inner train rows only; for the holdout the
    additive model is refitted on everything before it.
    """
    rows = cut(window_rows(features, lag_config["lookback"]))
    model = fit_lag_model(rows, lag_config["depth"], max_iter)
    sequence = predict_lag_model(model, rows).withColumnRenamed("yhat", "sequence_pred")

    def additive(fit_on: str, predict_on: str) -> DataFrame:
        coefs, spans = fit_additive(features.filter(fit_on).select("series_id", "ds", "y"), (config,))
        dates = features.filter(predict_on).select("series_id", "ds")
        return predict_additive(dates, coefs, spans, (config,)).select(
            "series_id", "ds", F.col("yhat").alias("additive_pred")
        )

    def both(part: str, fit_on: str) -> DataFrame:
        return (
            sequence.filter(F.col("split") == part)
            .drop("split")
            .join(additive(fit_on, f"split = '{part}'"), ["series_id", "ds"])
        )

    return both("val", "split = 'train'"), both("test", "split <> 'test'")


def ensemble(validation: DataFrame, holdout: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Ensembled holdout, metrics per series and model, global weights and day-type weights."""
    global_weights = evaluation.best_weight(evaluation.weight_sweep(validation))
    day_weights = evaluation.day_type_weights(validation)
    combined = evaluation.apply_weights(holdout, global_weights, day_weights)
    models = ["additive_pred", "sequence_pred", "ensemble_global", "ensemble_day_type"]
    return combined, evaluation.evaluate_forecasts(combined, models), global_weights, day_weights


def best_strategy(metrics: DataFrame, mape_target: float) -> DataFrame:
    """Better ensemble per series (day type must beat global) with the target check."""
    mape = {m: F.max(F.when(F.col("model") == m, F.col("mape"))) for m in ("ensemble_global", "ensemble_day_type")}
    both = metrics.groupBy("series_id").agg(*[v.alias(k) for k, v in mape.items()])
    day_wins = F.coalesce(F.col("ensemble_day_type") < F.col("ensemble_global"), F.lit(False))
    best = F.when(day_wins, F.col("ensemble_day_type")).otherwise(F.col("ensemble_global"))
    return both.select(
        "series_id",
        F.when(day_wins, "day_type").otherwise("global").alias("best_strategy"),
        best.alias("best_ensemble_mape"),
        (best <= mape_target).alias("meets_target"),
    )


def future_dates(history: DataFrame, horizon: int) -> DataFrame:
    """The next ``horizon`` days after the end of every series."""
    last = history.groupBy("series_id").agg(F.max("ds").alias("last"))
    return last.select(
        "series_id", F.explode(F.sequence(F.date_add("last", 1), F.date_add("last", horizon))).alias("ds")
    )


def what_if(forecast: DataFrame, adjustment_pct: float) -> DataFrame:
    """Totals of a future forecast, clipped at zero, before and after a percentage adjustment."""
    baseline = F.greatest(F.col("yhat"), F.lit(0.0))
    adjusted = baseline * (1 + adjustment_pct / 100)
    return forecast.groupBy("series_id").agg(
        F.count("*").alias("horizon_days"),
        F.count_if(F.col("yhat") < 0).alias("n_negative"),
        F.sum(baseline).alias("total_baseline"),
        F.sum(adjusted).alias("total_adjusted"),
        F.sum(adjusted - baseline).alias("delta"),
    )
