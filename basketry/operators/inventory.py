"""ABC tiers, demand statistics, stock policy and reorder decisions per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import days_later, normal_quantile, ntz, ratio
from basketry.operators.scale import exact_quantiles, running_totals

# Policy defaults.
LEAD_TIME_DAYS = 7
SERVICE_LEVEL = 0.95
ORDER_COST = 20.0
HOLDING_COST_RATE = 0.20
DEMAND_LOOKBACK_DAYS = 90
QUANTITY_CAP_PERCENTILE = 0.999
TIER_A_CUTOFF = 0.80
TIER_B_CUTOFF = 0.95


def abc_classification(
    sales: DataFrame, tier_a_cutoff: float = TIER_A_CUTOFF, tier_b_cutoff: float = TIER_B_CUTOFF
) -> DataFrame:
    """Revenue share, cumulative share, revenue rank and tier per product."""
    revenue = sales.groupBy("stock_code").agg(F.sum("total").alias("total_revenue"))
    placed = running_totals(
        revenue,
        {"revenue": -F.col("total_revenue"), "stock_code": F.col("stock_code")},
        {"total": F.col("total_revenue"), "rank": F.lit(1).cast("long")},
    )
    share = ratio(F.col("total_running"), F.col("total_all"))
    return placed.select(
        "stock_code",
        "total_revenue",
        ratio(F.col("total_revenue"), F.col("total_all")).alias("revenue_share"),
        share.alias("cumulative_share"),
        F.when(share <= tier_a_cutoff, "A").when(share <= tier_b_cutoff, "B").otherwise("C").alias("tier"),
        F.col("rank_running").alias("revenue_rank"),
    )


def tier_summary(abc: DataFrame, tiers: tuple[str, ...] = ("A", "B", "C")) -> DataFrame:
    """Products and revenue per tier with their shares of the chosen tiers."""
    kept = abc.filter(F.col("tier").isin(*tiers))
    sums = kept.groupBy("tier").agg(
        F.count("*").alias("n_products"), F.sum("total_revenue").alias("total_revenue")
    )
    overall = sums.agg(F.sum("n_products").alias("n"), F.sum("total_revenue").alias("r"))
    n, r = overall.select("n").scalar(), overall.select("r").scalar()
    return sums.withColumns(
        {
            "pct_of_skus": ratio(F.col("n_products"), n) * 100,
            "pct_of_revenue": ratio(F.col("total_revenue"), r) * 100,
        }
    )


def quantity_caps(sales: DataFrame, percentiles: tuple[float, ...]) -> Column:
    """Exact quantiles of the line quantity over the whole table, as one scalar array."""
    points = exact_quantiles(sales, ["quantity"], list(percentiles))
    of = lambda p: F.max(F.when(F.col("probability") == p, F.col("value")))
    return points.agg(F.array(*[of(float(p)) for p in percentiles]).alias("caps")).scalar()


def demand_stats(
    sales: DataFrame,
    lookback_days: int = DEMAND_LOOKBACK_DAYS,
    reference_date: str | None = None,
    quantity_cap_percentile: float = QUANTITY_CAP_PERCENTILE,
) -> DataFrame:
    """Mean and population deviation of daily demand over a dense lookback, per product.

    Days without a sale count as zero through the closed form, so no day is materialised. Sales
    later on the first calendar day of the window count for description and price only.
    """
    caps = quantity_caps(sales, (quantity_cap_percentile,))
    capped = _capped_demand(sales, [F.get(caps, F.lit(0))], lookback_days, reference_date)
    return capped.select("stock_code", F.col("mean_0").alias("daily_demand_mean"), F.col("std_0").alias("daily_demand_std"), "description", "avg_unit_price")


def _capped_demand(sales: DataFrame, caps: list[Column], lookback_days: int, reference_date: str | None) -> DataFrame:
    """``mean_i`` and ``std_i`` of demand under every cap, description and price, from one pass over the window."""
    reference = (
        sales.agg(F.max("invoice_date")).scalar() if reference_date is None else ntz(reference_date)
    )
    start = days_later(reference, -lookback_days)
    kinds = range(len(caps))
    window = sales.filter(
        (F.col("invoice_date") > start) & (F.col("invoice_date") <= reference)
    ).select(
        "stock_code",
        "description",
        F.to_date("invoice_date").alias("date"),
        *[F.least(F.col("quantity").cast("double"), cap).alias(f"q{i}") for i, cap in enumerate(caps)],
        "unit_price",
    )
    # (product, day, description) rows first: a hot product is combined before it is shuffled.
    partial = window.groupBy("stock_code", "date", "description").agg(
        *[F.sum(f"q{i}").alias(f"q{i}") for i in kinds],
        F.sum("unit_price").alias("price_sum"),
        F.count("*").alias("n_lines"),
    )
    in_days = F.col("date") > F.to_date(start)
    per_day = partial.groupBy("stock_code", "date").agg(*[F.sum(f"q{i}").alias(f"q{i}") for i in kinds])
    n = F.lit(float(lookback_days))
    demand = per_day.groupBy("stock_code").agg(
        *[(F.coalesce(F.sum(F.when(in_days, F.col(f"q{i}"))), F.lit(0.0)) / n).alias(f"mean_{i}") for i in kinds],
        *[(F.coalesce(F.sum(F.when(in_days, F.col(f"q{i}") * F.col(f"q{i}"))), F.lit(0.0)) / n).alias(f"sq_{i}") for i in kinds],
    )
    spread = lambda i: F.sqrt(F.greatest(F.col(f"sq_{i}") - F.col(f"mean_{i}") * F.col(f"mean_{i}"), F.lit(0.0)))
    demand = demand.select("stock_code", *[F.col(f"mean_{i}") for i in kinds], *[spread(i).alias(f"std_{i}") for i in kinds])
    by_text = partial.groupBy("stock_code", "description").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("price_sum").alias("price_sum")
    )
    # Most frequent description, the smallest one on a tie.
    texts = by_text.groupBy("stock_code").agg(
        F.min_by("description", F.struct(-F.col("n_lines"), "description")).alias("description"),
        ratio(F.sum("price_sum"), F.sum("n_lines")).alias("avg_unit_price"),
    )
    return demand.join(texts, "stock_code")


def safety_stock(daily_std: Column, lead_time_days: int, service_level: float) -> Column:
    return daily_std * (normal_quantile(service_level) * lead_time_days**0.5)


def reorder_point(daily_mean: Column, lead_time_days: int, safety: Column) -> Column:
    return daily_mean * lead_time_days + safety


def economic_order_quantity(daily_mean: Column, order_cost: float, holding_cost: Column) -> Column:
    """``sqrt(2 * annual demand * order cost / holding cost)``; 0 without a holding cost."""
    return F.coalesce(F.sqrt(ratio(daily_mean * 365 * 2 * order_cost, holding_cost)), F.lit(0.0))


def recommendations(
    sales: DataFrame,
    tiers: tuple[str, ...] = ("A", "B"),
    lead_time_days: int = LEAD_TIME_DAYS,
    service_level: float = SERVICE_LEVEL,
    order_cost: float = ORDER_COST,
    holding_cost_rate: float = HOLDING_COST_RATE,
    lookback_days: int = DEMAND_LOOKBACK_DAYS,
    quantity_cap_percentile: float = QUANTITY_CAP_PERCENTILE,
) -> DataFrame:
    """Stock policy for every product of the chosen tiers sold in the lookback window."""
    stats = demand_stats(
        sales, lookback_days=lookback_days, quantity_cap_percentile=quantity_cap_percentile
    )
    abc = abc_classification(sales).filter(F.col("tier").isin(*tiers)).drop("revenue_rank")
    safety = safety_stock(F.col("daily_demand_std"), lead_time_days, service_level)
    holding = F.col("avg_unit_price") * holding_cost_rate
    return (
        abc.join(stats, "stock_code")
        .withColumn("safety_stock", safety)
        .withColumn(
            "reorder_point",
            reorder_point(F.col("daily_demand_mean"), lead_time_days, F.col("safety_stock")),
        )
        .withColumn("eoq", economic_order_quantity(F.col("daily_demand_mean"), order_cost, holding))
        .withColumn("lead_time_days", F.lit(lead_time_days))
        .withColumn("service_level", F.lit(service_level))
    )


def reorder_trigger(recommended: DataFrame, stock: DataFrame) -> DataFrame:
    """Order the EOQ for every product whose stock is below its reorder point."""
    below = F.col("on_hand") < F.col("reorder_point")
    return recommended.join(stock, "stock_code").withColumns(
        {
            "should_reorder": below,
            "recommended_order_qty": F.when(below, F.col("eoq")).otherwise(0.0),
        }
    )


def winsor_effect(
    sales: DataFrame, caps: tuple[float, float] = (0.9999999, QUANTITY_CAP_PERCENTILE)
) -> DataFrame:
    """Per product: lines above the cap, and demand statistics before and after capping.

    Both caps come from one ordering of the quantities, both statistics from one pass.
    """
    both = quantity_caps(sales, caps)
    uncapped, capped = F.get(both, F.lit(0)), F.get(both, F.lit(1))
    names = {"mean_0": "uncapped_mean", "std_0": "uncapped_std", "mean_1": "capped_mean", "std_1": "capped_std"}
    demand = _capped_demand(sales, [uncapped, capped], DEMAND_LOOKBACK_DAYS, None)
    above = sales.groupBy("stock_code").agg(F.count_if(F.col("quantity") > capped).alias("lines_above_cap"))
    return demand.select("stock_code", *[F.col(c).alias(n) for c, n in names.items()]).join(above, "stock_code")
