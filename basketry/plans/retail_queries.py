"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import (
    churn,
    cleaning,
    daily,
    drift,
    evaluation,
    inventory,
    profile,
    rfm,
    runs,
    segmentation,
    series,
    serving,
)
from basketry.plans import prepared as P
from basketry.sources import readers
from basketry.sources.order_sales import sales_lines
from basketry.sources.schemas import SOURCE_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return P.present(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return fn


# --- sources and cleaning -----------------------------------------------------------------


@query
def union_yearly(spark, sf_dir):
    """Two period extracts, tagged with their origin and stacked again."""
    early = F.coalesce(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(False))
    extracts = {"before 1998": early, "from 1998": ~early}
    return readers.union_yearly(
        {name: sales_lines(spark, sf_dir, of).drop("source_sheet") for name, of in extracts.items()}
    )


@query
def normalize_schema(spark, sf_dir):
    """Source column names back to canonical ones; the unknown column stays."""
    lines = P.raw_lines(spark, sf_dir)
    source = lines.withColumnsRenamed({name: src for src, name in SOURCE_COLUMNS.items()})
    return readers.normalize_schema(source.withColumn("Till", F.lit("T1")))


@query
def dedupe(spark, sf_dir):
    return cleaning.dedupe(P.raw_lines(spark, sf_dir))


def _fresh_flags(spark, sf_dir):
    return cleaning.flag_lines(cleaning.dedupe(P.raw_lines(spark, sf_dir)))


@query
def clean_flags(spark, sf_dir):
    return _fresh_flags(spark, sf_dir)


@query
def completed_sales(spark, sf_dir):
    return cleaning.clean_transactions(P.raw_lines(spark, sf_dir))["completed_sales"]


@query
def excluded_sales(spark, sf_dir):
    return cleaning.clean_transactions(P.raw_lines(spark, sf_dir))["excluded"]


@query
def customer_sales(spark, sf_dir):
    return cleaning.clean_transactions(P.raw_lines(spark, sf_dir))["customer_sales"]


@query
def exclusion_reasons(spark, sf_dir):
    return cleaning.exclusion_reasons(_fresh_flags(spark, sf_dir))


@query
def clean_counts(spark, sf_dir):
    return cleaning.table_counts(P.raw_lines(spark, sf_dir), _fresh_flags(spark, sf_dir))


# --- data profile ---------------------------------------------------------------------------


def _with_total(spark, sf_dir):
    return P.raw_lines(spark, sf_dir).withColumn("total", F.col("quantity") * F.col("unit_price"))


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(P.raw_lines(spark, sf_dir))


@query
def describe_numeric(spark, sf_dir):
    described = profile.describe_numeric(P.raw_lines(spark, sf_dir), ["quantity", "unit_price"])
    return P.rounded(described, 4, *[c for c in described.columns if c not in ("column", "count")])


@query
def describe_rfm(spark, sf_dir):
    table = rfm.compute_rfm(P.customers(spark, sf_dir))
    described = profile.describe_numeric(table, list(rfm.METRICS), (0.25, 0.5, 0.75))
    return P.rounded(described, 4, *[c for c in described.columns if c not in ("column", "count")])


@query
def quality_counts(spark, sf_dir):
    return P.rounded(profile.quality_counts(P.raw_lines(spark, sf_dir)), 6, "pct")


@query
def monthly_lines(spark, sf_dir):
    return daily.monthly_lines(P.raw_lines(spark, sf_dir))


@query
def corr_matrix(spark, sf_dir):
    matrix = profile.correlation_matrix(
        _with_total(spark, sf_dir), ["quantity", "unit_price", "total"]
    )
    return P.rounded(matrix, 8, "corr")


@query
def histogram(spark, sf_dir):
    return profile.histogram(P.raw_lines(spark, sf_dir), "quantity", -50, 50, 50)


@query
def top_countries(spark, sf_dir):
    return profile.top_countries(P.raw_lines(spark, sf_dir))


@query
def top_transactions(spark, sf_dir):
    return profile.top_transactions(P.completed(spark, sf_dir), "17")


# --- customer features ----------------------------------------------------------------------


@query
def rfm_table(spark, sf_dir):
    return rfm.compute_rfm(P.customers(spark, sf_dir))


QUERIES["rfm"] = QUERIES.pop("rfm_table")


@query
def rfm_scores(spark, sf_dir):
    return rfm.add_rfm_scores(rfm.compute_rfm(P.customers(spark, sf_dir)))


@query
def rfm_segments(spark, sf_dir):
    return rfm.segment_sizes(rfm.add_rfm_scores(rfm.compute_rfm(P.customers(spark, sf_dir))))


@query
def churn_labels(spark, sf_dir):
    return churn.churn_labels(P.customers(spark, sf_dir), P.CUTOFF)


RATIOS = ("avg_order_value", "avg_days_between_purchases", "monetary_per_day")


@query
def churn_features(spark, sf_dir):
    return P.rounded(churn.churn_features(P.customers(spark, sf_dir), P.CUTOFF, P.HOME), 6, *RATIOS)


@query
def churn_dataset(spark, sf_dir):
    table = churn.churn_dataset(P.customers(spark, sf_dir), P.CUTOFF, home_country=P.HOME)
    return P.rounded(table, 6, *RATIOS)


@query
def churn_enriched(spark, sf_dir):
    table = churn.enriched_dataset(P.customers(spark, sf_dir), P.CUTOFF, home_country=P.HOME)
    return P.rounded(table, 6, *RATIOS, *churn.TREND_FEATURES)


# --- daily series ---------------------------------------------------------------------------


@query
def daily_dense(spark, sf_dir):
    return daily.daily_aggregates(P.completed(spark, sf_dir)).select("date", *daily.MEASURES)


@query
def rolling(spark, sf_dir):
    table = daily.add_rolling(daily.daily_aggregates(P.completed(spark, sf_dir), "country"))
    added = [c for c in table.columns if "_roll" in c]
    return P.rounded(table.select("series_id", "date", *added), 4, *added)


@query
def daily_range(spark, sf_dir):
    table = daily.date_range(
        daily.add_rolling(daily.daily_aggregates(P.completed(spark, sf_dir)), (30,), ("revenue",)),
        "1999-01-01",
        "1999-12-31",
    )
    return P.rounded(table.select("date", "revenue", "revenue_roll30_mean"), 4, "revenue_roll30_mean")


@query
def dow_profile(spark, sf_dir):
    profile_ = daily.weekday_profile(P.demand(spark, sf_dir))
    return P.rounded(profile_, 6, "mean_y", "pct_zero_days")


@query
def partial_days(spark, sf_dir):
    return P.daily_flagged(spark, sf_dir, "country").select("series_id", "date", "is_partial_day")


@query
def demand_series(spark, sf_dir):
    return P.demand(spark, sf_dir)


@query
def period_growth(spark, sf_dir):
    flagged = P.daily_flagged(spark, sf_dir, "country").filter(~F.col("is_partial_day"))
    return P.rounded(
        daily.period_growth(flagged, P.DEMAND_SPLIT), 6, "mean_before", "mean_after", "growth_pct"
    )


# --- inventory ------------------------------------------------------------------------------


@query
def abc(spark, sf_dir):
    table = inventory.abc_classification(P.completed(spark, sf_dir))
    return P.rounded(table, 9, "revenue_share", "cumulative_share")


@query
def tier_summary(spark, sf_dir):
    table = inventory.tier_summary(inventory.abc_classification(P.completed(spark, sf_dir)))
    return P.rounded(table, 6, "pct_of_skus", "pct_of_revenue")


DEMAND = ("daily_demand_mean", "daily_demand_std", "avg_unit_price")


@query
def demand_stats(spark, sf_dir):
    return P.rounded(inventory.demand_stats(P.completed(spark, sf_dir)), 9, *DEMAND)


@query
def winsor_effect(spark, sf_dir):
    table = inventory.winsor_effect(P.completed(spark, sf_dir), (0.9999999, 0.9))
    return P.rounded(table, 6, "uncapped_mean", "uncapped_std", "capped_mean", "capped_std")


def _recommended(spark, sf_dir):
    return inventory.recommendations(P.completed(spark, sf_dir))


@query
def inventory_reco(spark, sf_dir):
    table = P.rounded(_recommended(spark, sf_dir), 9, "revenue_share", "cumulative_share", *DEMAND)
    return P.rounded(table, 5, "safety_stock", "reorder_point", "eoq")


@query
def reorder_trigger(spark, sf_dir):
    """Stock on hand stands in as a fixed share of the product key."""
    stock = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("stock_code"),
        (F.col("p_partkey") % 40).cast("double").alias("on_hand"),
    )
    table = inventory.reorder_trigger(_recommended(spark, sf_dir), stock).select(
        "stock_code", "on_hand", "reorder_point", "should_reorder", "recommended_order_qty"
    )
    return P.rounded(table, 5, "reorder_point", "recommended_order_qty")


# --- time series ----------------------------------------------------------------------------


def _split(spark, sf_dir):
    return series.train_test_split(P.demand(spark, sf_dir), P.TEST_DAYS, P.VALIDATION_DAYS)


@query
def diff1(spark, sf_dir):
    return series.first_difference(P.demand(spark, sf_dir))


@query
def decompose(spark, sf_dir):
    table = series.decompose(P.demand(spark, sf_dir))
    return P.rounded(table, 6, "trend", "seasonal", "resid")


@query
def seasonal_by_dow(spark, sf_dir):
    table = series.seasonal_by_weekday(series.decompose(P.demand(spark, sf_dir)))
    return P.rounded(table, 6, "mean_seasonal")


@query
def stationarity_verdict(spark, sf_dir):
    """Verdict per series from two simple flags that stand in for the test results."""
    stats = P.demand(spark, sf_dir).groupBy("series_id").agg(
        (F.max("ds") > F.lit("2001-07-30").cast("date")).alias("adf_stationary"),
        (F.count_if(F.col("y") == 0) < 10).alias("kpss_stationary"),
    )
    verdict = series.stationarity_verdict(F.col("adf_stationary"), F.col("kpss_stationary"))
    return stats.withColumn("verdict", verdict)


@query
def series_features(spark, sf_dir):
    demand = P.demand(spark, sf_dir)
    table = series.series_features(demand, series.uk_holidays(demand))
    return P.rounded(table, 9, "dow_sin", "dow_cos")


@query
def ts_split(spark, sf_dir):
    return _split(spark, sf_dir).select("series_id", "ds", "split")


@query
def scale_series(spark, sf_dir):
    table = series.scale_series(_split(spark, sf_dir))
    return P.rounded(table.select("series_id", "ds", "y_mean", "y_std", "y_scaled"), 6, "y_mean", "y_std", "y_scaled")


@query
def lag_windows(spark, sf_dir):
    windows = series.lag_windows(series.scale_series(_split(spark, sf_dir)), 14)
    table = windows.select("series_id", "ds", "split", F.posexplode("window").alias("pos", "step"))
    return P.rounded(table.withColumn("step", F.col("step")[0]), 6, "step")


@query
def naive_forecast(spark, sf_dir):
    return series.naive_seasonal(_split(spark, sf_dir)).select("series_id", "ds", "y", "naive")


# --- forecast evaluation and ensemble ---------------------------------------------------------
# Two simple forecasts stand in for the models: lag 7 and the mean of the previous 7 rows.


def _stand_in_forecasts(spark, sf_dir):
    rows = series.in_order().rowsBetween(-7, -1)
    return _split(spark, sf_dir).select(
        "series_id",
        "ds",
        "split",
        F.col("y").alias("actual"),
        F.lag("y", 7).over(series.in_order()).alias("additive_pred"),
        F.avg("y").over(rows).alias("sequence_pred"),
    )


def _val_and_test(spark, sf_dir):
    rows = _stand_in_forecasts(spark, sf_dir)
    return rows.filter("split = 'val'").drop("split"), rows.filter("split = 'test'").drop("split")


@query
def forecast_eval(spark, sf_dir):
    _, test = _val_and_test(spark, sf_dir)
    table = evaluation.evaluate_forecasts(test, ["additive_pred", "sequence_pred"])
    return P.rounded(table, 6, "mae", "rmse", "mape")


@query
def ape_by_dow(spark, sf_dir):
    _, test = _val_and_test(spark, sf_dir)
    return P.rounded(evaluation.ape_by_weekday(test, ["additive_pred", "sequence_pred"]), 6, "ape")


@query
def weight_sweep(spark, sf_dir):
    val, _ = _val_and_test(spark, sf_dir)
    return P.rounded(evaluation.weight_sweep(val), 6, "mape")


@query
def best_weight(spark, sf_dir):
    val, _ = _val_and_test(spark, sf_dir)
    return evaluation.best_weight(evaluation.weight_sweep(val))


@query
def day_type_weights(spark, sf_dir):
    val, _ = _val_and_test(spark, sf_dir)
    return evaluation.day_type_weights(val)


@query
def ensemble_apply(spark, sf_dir):
    val, test = _val_and_test(spark, sf_dir)
    table = evaluation.apply_weights(
        test, evaluation.best_weight(evaluation.weight_sweep(val)), evaluation.day_type_weights(val)
    )
    return P.rounded(table, 6, "sequence_pred", "ensemble_global", "ensemble_day_type")


# --- segments and risk ------------------------------------------------------------------------
# Clusters stand in as customer_id % 6 with every 50th customer as noise, risk scores as recency
# relative to the longest recency.


def _rfm(spark, sf_dir):
    return rfm.compute_rfm(P.customers(spark, sf_dir))


def _clustered(table):
    noise = F.col("customer_id") % 50 == 0
    return table.withColumn("cluster", F.when(noise, -1).otherwise(F.col("customer_id") % 6).cast("int"))


@query
def scaled_rfm(spark, sf_dir):
    table = segmentation.scaled_rfm(_rfm(spark, sf_dir)).select("customer_id", *segmentation.SCALED)
    return P.rounded(table, 6, *segmentation.SCALED)


@query
def label_segments(spark, sf_dir):
    return segmentation.label_segments(_clustered(_rfm(spark, sf_dir)))


@query
def davies_bouldin(spark, sf_dir):
    labelled = _clustered(segmentation.scaled_rfm(_rfm(spark, sf_dir)))
    return P.rounded(segmentation.davies_bouldin(labelled, segmentation.SCALED), 6, "davies_bouldin")


def _segments(spark, sf_dir):
    return rfm.add_rfm_scores(_rfm(spark, sf_dir)).withColumnRenamed("rfm_segment", "segment_name")


def _risk(spark, sf_dir):
    """Stand-in scores for the customers active by the cutoff, with their churn label."""
    table = churn.churn_dataset(P.customers(spark, sf_dir), P.CUTOFF, home_country=P.HOME)
    score = F.pmod(F.col("customer_id") * 37 + F.col("recency_days"), F.lit(1000)) / 1000.0
    return table.withColumn("churn_probability", score)


def _scored(spark, sf_dir):
    """Scores in steps of 0.01, so that many customers tie."""
    return _risk(spark, sf_dir).select(
        "customer_id",
        (F.floor(F.round(F.col("churn_probability") * 1000) / 10) / 100.0).alias("score"),
        F.col("churned").alias("label"),
    )


@query
def segment_profile(spark, sf_dir):
    return serving.segment_profile(_segments(spark, sf_dir))


@query
def risk_by_segment(spark, sf_dir):
    table = serving.risk_by_segment(_segments(spark, sf_dir), _risk(spark, sf_dir))
    return P.rounded(table, 6, "churn_probability")


@query
def risk_list(spark, sf_dir):
    return serving.risk_list(
        _segments(spark, sf_dir), _risk(spark, sf_dir), 0.5, ["champions", "lost", "regular"]
    )


@query
def kpis(spark, sf_dir):
    return serving.kpis(
        daily.daily_aggregates(P.completed(spark, sf_dir)), _rfm(spark, sf_dir), _risk(spark, sf_dir)
    )


@query
def inventory_search(spark, sf_dir):
    table = serving.inventory_search(_recommended(spark, sf_dir), "RING", sort_by="reorder_point")
    return P.rounded(table, 4, "daily_demand_mean", "safety_stock", "reorder_point", "eoq")


@query
def report_top10(spark, sf_dir):
    return serving.report_top10(_risk(spark, sf_dir), _recommended(spark, sf_dir))


@query
def precision_at_k(spark, sf_dir):
    return P.rounded(evaluation.precision_at_top_k(_scored(spark, sf_dir), "customer_id"), 6, "precision")


@query
def precision_curve(spark, sf_dir):
    fractions = [i / 20 for i in range(1, 21)]
    table = evaluation.precision_curve(_scored(spark, sf_dir), "customer_id", fractions)
    return P.rounded(table, 6, "precision")


@query
def roc_curve(spark, sf_dir):
    return P.rounded(evaluation.roc_curve(_scored(spark, sf_dir)), 9, "fpr", "tpr")


@query
def churn_eval(spark, sf_dir):
    table = evaluation.classification_metrics(_scored(spark, sf_dir), "customer_id")
    return P.rounded(table, 9, *table.columns)


# --- drift and runs -----------------------------------------------------------------------------


def _churn_snapshots(spark, sf_dir):
    return drift.churn_snapshots(P.customers(spark, sf_dir), P.REFERENCE_CUTOFF, P.CUTOFF, P.HOME)


def _demand_snapshots(spark, sf_dir):
    return drift.demand_snapshots(P.daily_flagged(spark, sf_dir), P.DEMAND_SPLIT)


def _distances(table, *columns):
    return P.rounded(table.select("column", "n_reference", "n_current", *columns), 6, *columns)


@query
def drift_ks(spark, sf_dir):
    table = drift.drift_distances(_demand_snapshots(spark, sf_dir), drift.DEMAND_COLUMNS)
    return _distances(table, "ks_distance", "ks_p_asymptotic")


@query
def drift_wasserstein(spark, sf_dir):
    table = drift.drift_distances(_churn_snapshots(spark, sf_dir), drift.CHURN_COLUMNS)
    return _distances(table, "wasserstein_normed")


@query
def drift_churn(spark, sf_dir):
    table = drift.churn_summary(_churn_snapshots(spark, sf_dir))
    return P.rounded(table, 6, "value")


@query
def drift_demand(spark, sf_dir):
    table = drift.demand_summary(_demand_snapshots(spark, sf_dir))
    return P.rounded(table, 6, "value")


def _checked(spark, sf_dir):
    return drift.check_drift(_churn_snapshots(spark, sf_dir), _demand_snapshots(spark, sf_dir))


@query
def drift_share(spark, sf_dir):
    return P.rounded(_checked(spark, sf_dir), 6, "drifted_share")


@query
def retrain_targets(spark, sf_dir):
    return drift.retrain_targets(_checked(spark, sf_dir))


def _runs(spark, sf_dir):
    """Run records that stand in for logged runs: one per event type and user."""
    groups = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type", "user_id").agg(
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
    )
    metrics = F.create_map(
        F.lit("mape"), F.col("low"), F.lit("auc"), F.col("high") / 500, F.lit("precision"), F.col("high") / 400
    )
    return groups.select(
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("run_id"),
        F.lit(None).cast("string").alias("parent_run_id"),
        F.col("event_type").alias("experiment"),
        F.concat(F.lit("run_"), (F.col("user_id") % 7).cast("string")).alias("run_name"),
        "start_time",
        "end_time",
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("params"),
        metrics.alias("metrics"),
    )


RUN_METRICS = ["mape", "auc", "precision"]


@query
def latest_run(spark, sf_dir):
    return runs.latest_runs(_runs(spark, sf_dir), RUN_METRICS).drop("start_time")


@query
def best_run(spark, sf_dir):
    return runs.best_run(_runs(spark, sf_dir), "mape")


@query
def constraints(spark, sf_dir):
    latest = runs.latest_runs(_runs(spark, sf_dir), RUN_METRICS)
    return runs.constraints(
        latest,
        [
            ("churn", "signup", "run_1", "auc", ">=", runs.AUC_TARGET),
            ("churn", "signup", "run_1", "precision", ">=", runs.PRECISION_TARGET),
            ("forecast", "purchase", "run_2", "mape", "<=", runs.MAPE_TARGET),
        ],
    )


@query
def model_evolution(spark, sf_dir):
    return runs.model_evolution(
        _runs(spark, sf_dir),
        [
            ("manual sweep", "signup", "run_1", "auc"),
            ("search", "signup", "run_3", "auc"),
            ("additive", "purchase", "run_2", "mape"),
            ("sequence", "purchase", "run_4", "mape"),
            ("ensemble", "purchase", "run_5", "mape"),
        ],
    )
