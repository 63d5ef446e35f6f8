"""Churn labels, behavioural features and activity trends per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import days_later, elapsed_days, ntz, ratio
from basketry.operators.scale import attach_by_key

# Model feature order.
FEATURES = (
    "recency_days", "frequency", "monetary", "total_quantity", "n_distinct_products",
    "avg_order_value", "tenure_days", "avg_days_between_purchases", "monetary_per_day", "is_uk",
)
TREND_FEATURES = ("recency_ratio", "frequency_trend", "monetary_trend")
CHURN_WINDOW_DAYS = 90
HOME_COUNTRY = "United Kingdom"


def churn_labels(sales: DataFrame, cutoff: str, window_days: int = CHURN_WINDOW_DAYS) -> DataFrame:
    """Customers active by the cutoff; churned = 1 without a purchase in the window after it."""
    at = ntz(cutoff)
    window_end = days_later(at, window_days)
    when = F.col("invoice_date")
    return (
        sales.filter(when <= window_end)
        .groupBy("customer_id")
        .agg(F.min(when).alias("first"), F.max(when).alias("last"))
        .filter(F.col("first") <= at)
        .select("customer_id", (F.col("last") <= at).cast("int").alias("churned"))
    )


def _features(sales: DataFrame, cutoffs: dict[str, Column], home_country: str) -> DataFrame:
    """Features per (snapshot, customer) for one or more cutoffs, from rows up to each cutoff.

    Lines are combined per (customer, invoice) and per (customer, product) first, with one set of
    conditional sums per cutoff. A customer with a third of all lines is spread over many tasks,
    and distinct counts become plain counts of the combined rows.
    """
    when = F.col("invoice_date")
    home = F.coalesce(F.col("country") == home_country, F.lit(False)).cast("long")
    at_all = list(cutoffs.values())
    seen = sales.filter(when <= (F.greatest(*at_all) if len(at_all) > 1 else at_all[0]))

    line_sums = {"total": F.col("total"), "quantity": F.col("quantity"), "home": home, "lines": F.lit(1).cast("long")}
    per_invoice = []
    for name, at in cutoffs.items():
        per_invoice += [F.sum(F.when(when <= at, v)).alias(f"{c}_{name}") for c, v in line_sums.items()]
        per_invoice += [F.min(F.when(when <= at, when)).alias(f"first_{name}"), F.max(F.when(when <= at, when)).alias(f"last_{name}")]
    invoices = seen.groupBy("customer_id", "invoice").agg(*per_invoice)

    per_customer = []
    for name in cutoffs:
        per_customer += [F.sum(f"{c}_{name}").alias(f"{c}_{name}") for c in line_sums]
        per_customer += [
            F.min(f"first_{name}").alias(f"first_{name}"),
            F.max(f"last_{name}").alias(f"last_{name}"),
            F.count(f"lines_{name}").alias(f"frequency_{name}"),
        ]
    customers = invoices.groupBy("customer_id").agg(*per_customer)
    products = (
        seen.groupBy("customer_id", "stock_code")
        .agg(F.min(when).alias("first_sold"))
        .groupBy("customer_id")
        .agg(*[F.count_if(F.col("first_sold") <= at).alias(f"products_{n}") for n, at in cutoffs.items()])
    )

    def snapshot(name: str, at: Column) -> Column:
        def of(column: str) -> Column:
            return F.col(f"{column}_{name}")

        tenure = elapsed_days(of("first"), at)
        values = {
            "snapshot": F.lit(name),
            "recency_days": elapsed_days(of("last"), at),
            "frequency": of("frequency"),
            "monetary": of("total"),
            "total_quantity": of("quantity"),
            "n_distinct_products": of("products"),
            "avg_order_value": ratio(of("total"), of("frequency")),
            "tenure_days": tenure,
            "avg_days_between_purchases": ratio(tenure, F.greatest(of("frequency"), F.lit(1))),
            "monetary_per_day": ratio(of("total"), F.greatest(tenure, F.lit(1))),
            "is_uk": (ratio(of("home"), of("lines")) >= 0.5).cast("int"),
            "first_purchase": of("first"),
            "n_lines": of("lines"),
        }
        return F.struct(*[v.alias(c) for c, v in values.items()])

    snapshots = F.array(*[snapshot(name, at) for name, at in cutoffs.items()])
    return (
        customers.join(products, "customer_id")
        .select("customer_id", F.explode(snapshots).alias("s"))
        .select("customer_id", "s.*")
        .filter(F.col("n_lines") > 0)
    )


def churn_features(
    sales: DataFrame, cutoff: str, home_country: str = HOME_COUNTRY, keep_spans: bool = False
) -> DataFrame:
    """The ten behavioural features from rows up to the cutoff.

    ``keep_spans`` keeps ``first_purchase`` and ``n_lines`` for the trend features.
    """
    extra = ["first_purchase", "n_lines"] if keep_spans else []
    features = _features(sales, {"cutoff": ntz(cutoff)}, home_country)
    return features.select("customer_id", *FEATURES, *extra)


def snapshot_features(
    sales: DataFrame, cutoffs: dict[str, str], home_country: str = HOME_COUNTRY
) -> DataFrame:
    """Churn features at several cutoffs from one pass, tagged by ``snapshot``."""
    moments = {name: ntz(at) for name, at in cutoffs.items()}
    return _features(sales, moments, home_country).select("snapshot", "customer_id", *FEATURES)


def churn_dataset(
    sales: DataFrame,
    cutoff: str,
    window_days: int = CHURN_WINDOW_DAYS,
    home_country: str = HOME_COUNTRY,
) -> DataFrame:
    """Features joined with labels; both sides are already partitioned by customer."""
    return churn_features(sales, cutoff, home_country).join(
        churn_labels(sales, cutoff, window_days), "customer_id"
    )


def add_recency_ratio(features: DataFrame) -> DataFrame:
    """Recency over the customer's own purchase gap; 0 when undefined."""
    own_gap = ratio(F.col("recency_days"), F.col("avg_days_between_purchases"))
    return features.withColumn("recency_ratio", F.coalesce(own_gap, F.lit(0.0)))


def add_trend_features(sales: DataFrame, features: DataFrame, cutoff: str) -> DataFrame:
    """Recent-half activity over older-half activity, split at each customer's midpoint.

    Activity is summed per invoice before customers are compared, so a customer with a third of
    all lines is spread over many tasks. ``features`` must carry ``first_purchase`` and
    ``n_lines`` (``churn_features(keep_spans=True)``).
    """
    at = ntz(cutoff)
    lines = sales.filter(F.col("invoice_date") <= at).select(
        "customer_id", "invoice", "invoice_date", "total"
    )
    placed = attach_by_key(lines, features.select("customer_id", "first_purchase", "n_lines"), "customer_id", "n_lines")
    elapsed = F.timestamp_diff("MICROSECOND", F.col("first_purchase"), F.col("invoice_date"))
    span = F.timestamp_diff("MICROSECOND", F.col("first_purchase"), at)
    per_invoice = placed.groupBy("customer_id", "invoice", (elapsed * 2 > span).alias("recent")).agg(
        F.sum("total").alias("total")
    )
    recent = F.col("recent")
    halves = per_invoice.groupBy("customer_id").agg(
        F.count_if(recent).alias("recent_n"),
        F.count_if(~recent).alias("older_n"),
        F.sum(F.when(recent, F.col("total")).otherwise(0)).alias("recent_total"),
        F.sum(F.when(~recent, F.col("total")).otherwise(0)).alias("older_total"),
    )

    def trend(half: str):
        value = ratio(F.col(f"recent_{half}"), F.col(f"older_{half}") + 1)
        return F.when(F.col("frequency") == 1, 1.0).otherwise(F.coalesce(value, F.lit(1.0)))

    return (
        features.join(halves, "customer_id", "left")
        .withColumns({"frequency_trend": trend("n"), "monetary_trend": trend("total")})
        .drop("recent_n", "older_n", "recent_total", "older_total")
    )


def enriched_features(
    sales: DataFrame, cutoff: str, home_country: str = HOME_COUNTRY
) -> DataFrame:
    """The ten base features plus the three ratio and trend features."""
    base = churn_features(sales, cutoff, home_country, keep_spans=True)
    return add_trend_features(sales, add_recency_ratio(base), cutoff).select(
        "customer_id", *FEATURES, *TREND_FEATURES
    )


def enriched_dataset(
    sales: DataFrame,
    cutoff: str,
    window_days: int = CHURN_WINDOW_DAYS,
    home_country: str = HOME_COUNTRY,
) -> DataFrame:
    return enriched_features(sales, cutoff, home_country).join(
        churn_labels(sales, cutoff, window_days), "customer_id"
    )
