"""Recency, frequency, monetary value, quintile scores and rule segments per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import days_later, elapsed_days, ntz, quantile_bin, rule_segment
from basketry.operators.scale import running_totals

METRICS = ("recency_days", "frequency", "monetary")


def compute_rfm(customer_sales: DataFrame, snapshot_date: str | Column | None = None) -> DataFrame:
    """One row per customer; the default snapshot is one day after the latest sale."""
    if snapshot_date is None:
        snapshot = days_later(customer_sales.agg(F.max("invoice_date")).scalar(), 1)
    else:
        snapshot = ntz(snapshot_date)
    per_customer = customer_sales.groupBy("customer_id").agg(
        F.max("invoice_date").alias("last_purchase"),
        F.countDistinct("invoice").alias("frequency"),
        F.sum("total").alias("monetary"),
    )
    return per_customer.select(
        "customer_id",
        elapsed_days(F.col("last_purchase"), snapshot).alias("recency_days"),
        "frequency",
        "monetary",
    )


def add_rfm_scores(rfm: DataFrame, n_bins: int = 5) -> DataFrame:
    """Add quantile scores (ties broken by customer_id) and the rule-based segment.

    The three metrics are ranked in one pass over (metric, value, customer) rows.
    """
    kept = [c for c in rfm.columns if c not in METRICS]
    long = rfm.select(*kept, *[F.col(c).cast("decimal(28,4)").alias(c) for c in METRICS]).unpivot(
        kept, list(METRICS), "metric", "value"
    )
    ranked = running_totals(
        long,
        {"value": F.col("value"), "customer_id": F.col("customer_id")},
        {"rank": F.lit(1).cast("long")},
        group=["metric"],
    ).withColumn("bin", quantile_bin(F.col("rank_running"), F.col("rank_all"), n_bins))

    def of(metric: str, column: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(column)))

    scored = ranked.groupBy("customer_id").agg(
        *[F.first(c).alias(c) for c in kept if c != "customer_id"],
        *[of(c, "value").cast(rfm.schema[c].dataType).alias(c) for c in METRICS],
        (F.lit(n_bins + 1) - of("recency_days", "bin")).alias("r_score"),
        of("frequency", "bin").alias("f_score"),
        of("monetary", "bin").alias("m_score"),
    )
    return scored.withColumn("rfm_segment", rule_segment(F.col("r_score"), F.col("f_score"), F.col("m_score")))


def segment_sizes(scored: DataFrame) -> DataFrame:
    return scored.groupBy("rfm_segment").agg(
        F.count("*").alias("customers"), F.sum("monetary").alias("revenue")
    )
