"""Distribution drift between two snapshots and the retraining decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import ratio
from basketry.operators.churn import HOME_COUNTRY, snapshot_features
from basketry.operators.scale import running_totals

# Verdict thresholds, columns, methods.
P_THRESHOLD = 0.05
DISTANCE_THRESHOLD = 0.1
SHARE_THRESHOLD = 0.5
CHURN_COLUMNS = (
    "recency_days", "frequency", "monetary", "avg_order_value", "tenure_days", "monetary_per_day",
    "n_distinct_products",
)
DEMAND_COLUMNS = ("revenue", "quantity", "n_invoices", "n_customers")
KS_METHOD = "K-S p_value"
DISTANCE_METHOD = "Wasserstein distance (normed)"
KS_TERMS = 100


def _distribution_gaps(snapshots: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Per column and distinct value: both empirical distributions and the gap to the next value.

    ``snapshots`` has a ``snapshot`` column with ``reference`` and ``current``.
    """
    is_ref = F.col("snapshot") == "reference"
    counts = (
        snapshots.select("snapshot", *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot("snapshot", list(columns), "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count_if(is_ref).alias("ref"), F.count_if(~is_ref).alias("cur"))
    )
    return running_totals(
        counts,
        {"value": F.col("value")},
        {"ref": F.col("ref"), "cur": F.col("cur")},
        group=["column"],
        following={"next": "value"},
    )


def kolmogorov_p(distance: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value: ``2 * sum((-1)^(j-1) * exp(-2 j^2 x^2))``."""
    x2 = distance * distance * n * m / (n + m)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        lambda j: F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(j * j * x2 * -2),
    )
    total = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    # The series converges slowly near 0, where the probability is 1.
    return F.when(x2 < 0.04, 1.0).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def drift_distances(snapshots: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """K-S distance with p-value and Wasserstein distance in reference deviations, per column."""
    gaps = _distribution_gaps(snapshots, columns)
    apart = F.abs(ratio(F.col("ref_running"), F.col("ref_all")) - ratio(F.col("cur_running"), F.col("cur_all")))
    n = F.col("n_reference")
    mean = ratio(F.col("_sum"), n)
    return (
        gaps.groupBy("column")
        .agg(
            F.max(apart).alias("ks_distance"),
            F.sum(apart * (F.col("next") - F.col("value"))).alias("_area"),
            F.max("ref_all").alias("n_reference"),
            F.max("cur_all").alias("n_current"),
            F.sum(F.col("value") * F.col("ref")).alias("_sum"),
            F.sum(F.col("value") * F.col("value") * F.col("ref")).alias("_sum_sq"),
        )
        .withColumn("_std", F.sqrt(F.greatest(ratio(F.col("_sum_sq"), n) - mean * mean, F.lit(0.0))))
        .select(
            "column",
            "n_reference",
            "n_current",
            "ks_distance",
            kolmogorov_p(F.col("ks_distance"), n, F.col("n_current")).alias("ks_p_asymptotic"),
            # A constant reference is normed by a small constant instead of zero.
            (F.coalesce("_area", F.lit(0.0)) / F.greatest("_std", F.lit(0.001))).alias("wasserstein_normed"),
        )
    )


def drift_summary(snapshots: DataFrame, columns: tuple[str, ...], method: str) -> DataFrame:
    """(column, method, value, drifted) by the named method, whatever the number of rows."""
    if method not in (KS_METHOD, DISTANCE_METHOD):
        raise ValueError(f"unknown drift method {method!r}")
    by_test = method == KS_METHOD
    value = F.col("ks_p_asymptotic") if by_test else F.col("wasserstein_normed")
    verdict = value < P_THRESHOLD if by_test else value > DISTANCE_THRESHOLD
    return drift_distances(snapshots, columns).select(
        "column", F.lit(method).alias("method"), value.alias("value"), verdict.alias("drifted")
    )


def drift_share(summary: DataFrame, share_threshold: float = SHARE_THRESHOLD) -> DataFrame:
    """Number and share of drifted columns and the retraining recommendation, as one row."""
    share = F.coalesce(F.avg(F.col("drifted").cast("int")), F.lit(0.0))
    return summary.agg(
        F.count_if("drifted").alias("n_drifted"),
        share.alias("drifted_share"),
        (share >= share_threshold).alias("retrain_recommended"),
    )


def churn_snapshots(
    sales: DataFrame, reference_cutoff: str, current_cutoff: str, home_country: str = HOME_COUNTRY
) -> DataFrame:
    """Churn features at both cutoffs from one scan."""
    return snapshot_features(
        sales, {"reference": reference_cutoff, "current": current_cutoff}, home_country
    )


def demand_snapshots(flagged_daily: DataFrame, split_date: str) -> DataFrame:
    """Daily measures tagged by the period before or from the split date on."""
    days = flagged_daily.filter(~F.col("is_partial_day"))
    before = F.col("date") < F.lit(split_date).cast("date")
    return days.select(F.when(before, "reference").otherwise("current").alias("snapshot"), *DEMAND_COLUMNS)


def churn_summary(snapshots: DataFrame) -> DataFrame:
    """Churn features by their distance."""
    return drift_summary(snapshots, CHURN_COLUMNS, DISTANCE_METHOD)


def demand_summary(snapshots: DataFrame) -> DataFrame:
    """Daily demand by the two-sample test."""
    return drift_summary(snapshots, DEMAND_COLUMNS, KS_METHOD)


def check_drift(churn: DataFrame, demand: DataFrame) -> DataFrame:
    """Both monitored models: share of drifted columns and recommendation."""
    return (
        drift_share(churn_summary(churn))
        .withColumn("model", F.lit("churn"))
        .unionByName(drift_share(demand_summary(demand)).withColumn("model", F.lit("forecast")))
        .select("model", "n_drifted", "drifted_share", "retrain_recommended")
    )


def retrain_targets(checked: DataFrame) -> DataFrame:
    return checked.filter("retrain_recommended").select("model")
