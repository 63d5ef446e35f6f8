"""Summary and list queries that dashboards and reports read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import money_text, percent_text, product_label

SORTS = ("total_revenue", "reorder_point", "eoq", "safety_stock")
RISK_COLUMNS = ["customer_id", "segment_name", "churn_probability", "recency_days", "frequency", "monetary"]
STOCK_COLUMNS = ["stock_code", "description", "tier", "daily_demand_mean", "safety_stock", "reorder_point", "eoq"]


def segment_profile(segments: DataFrame) -> DataFrame:
    """Customers and mean R, F, M per segment, rounded to 1."""
    return segments.groupBy("segment_name").agg(
        F.count("*").alias("customers"),
        *[F.round(F.avg(F.col(c).cast("double")), 1).alias(c) for c in ("recency_days", "frequency", "monetary")],
    )


def with_risk(segments: DataFrame, risk: DataFrame) -> DataFrame:
    return segments.join(risk.select("customer_id", "churn_probability"), "customer_id")


def risk_by_segment(segments: DataFrame, risk: DataFrame) -> DataFrame:
    """Mean churn probability per segment, highest first."""
    return (
        with_risk(segments, risk)
        .groupBy("segment_name")
        .agg(F.avg("churn_probability").alias("churn_probability"), F.count("*").alias("customers"))
        .orderBy(F.desc("churn_probability"), "segment_name")
    )


def risk_list(
    segments: DataFrame, risk: DataFrame, threshold: float = 0.5, names: list[str] | None = None, limit: int | None = 200
) -> DataFrame:
    """Customers at or above a risk threshold, highest risk first; ``limit=None`` exports all."""
    found = with_risk(segments, risk).filter(F.col("churn_probability") >= threshold)
    if names:
        found = found.filter(F.col("segment_name").isin(*names))
    listed = found.orderBy(F.desc("churn_probability"), "customer_id").select(*RISK_COLUMNS)
    return listed if limit is None else listed.limit(limit)


def inventory_search(
    recommended: DataFrame,
    text: str = "",
    tiers: tuple[str, ...] = ("A", "B"),
    sort_by: str = "total_revenue",
    limit: int | None = 200,
    regex: bool = False,
) -> DataFrame:
    """Products whose description or code contains ``text``, ignoring case.

    The text is literal unless ``regex`` is set.
    """
    if sort_by not in SORTS:
        raise ValueError(f"sort_by must be one of {SORTS}")
    found = recommended.filter(F.col("tier").isin(*tiers))
    if text:
        def holds(column: str):
            match = (
                F.col(column).rlike("(?i)" + text)
                if regex
                else F.contains(F.lower(column), F.lower(F.lit(text)))
            )
            return F.coalesce(match, F.lit(False))

        found = found.filter(holds("description") | holds("stock_code"))
    listed = found.orderBy(F.desc(sort_by), "stock_code").select(
        *STOCK_COLUMNS, product_label(F.col("stock_code"), F.col("description")).alias("label")
    )
    return listed if limit is None else listed.limit(limit)


def kpis(daily: DataFrame, segments: DataFrame, risk: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Total revenue, customers segmented and customers at risk, as one row."""
    at_risk = risk.agg(F.count_if(F.col("churn_probability") >= threshold))
    revenue = F.sum("revenue").cast("double")
    return daily.agg(revenue.alias("total_revenue")).select(
        "total_revenue",
        segments.agg(F.count("*")).scalar().alias("customers_segmented"),
        at_risk.scalar().alias("customers_at_risk"),
        money_text(F.col("total_revenue")).alias("total_revenue_text"),
    )


def top_risk(risk: DataFrame, n: int = 10) -> DataFrame:
    """Report table: the customers with the highest risk, formatted."""
    return (
        risk.orderBy(F.desc("churn_probability"), "customer_id")
        .limit(n)
        .select(
            F.col("customer_id").cast("string").alias("item"),
            percent_text(F.col("churn_probability")).alias("value"),
            money_text(F.col("monetary")).alias("detail"),
        )
    )


def top_reorder(recommended: DataFrame, n: int = 10) -> DataFrame:
    """Report table: the products with the highest reorder points, formatted."""
    return (
        recommended.orderBy(F.desc("reorder_point"), "stock_code")
        .limit(n)
        .select(
            F.col("stock_code").alias("item"),
            F.format_number("reorder_point", 0).alias("value"),
            F.substring("description", 1, 30).alias("detail"),
        )
    )


def report_top10(risk: DataFrame, recommended: DataFrame, n: int = 10) -> DataFrame:
    """Both report tables, tagged by list."""
    return (
        top_risk(risk, n)
        .withColumn("list", F.lit("risk"))
        .unionByName(top_reorder(recommended, n).withColumn("list", F.lit("reorder")))
    )
