"""Dense daily series, rolling features and calendar profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.expressions import day_of_week, ratio

WINDOWS = (7, 14, 30)
MEASURES = ("revenue", "quantity", "n_invoices", "n_customers")
CLOSE_HOUR = 17


def daily_aggregates(sales: DataFrame, series: Column | str | None = None) -> DataFrame:
    """Revenue, quantity, invoices and known customers per series and calendar day, dense.

    ``series`` is the column that splits the table into series; by default everything is one
    series named ``all``. ``latest_sale`` is NULL on filled days.
    """
    series = F.lit("all") if series is None else F.col(series) if isinstance(series, str) else series
    # One row per invoice and customer first: the distinct counts then expand these rows, not the lines.
    baskets = sales.groupBy(series.alias("series_id"), F.to_date("invoice_date").alias("date"), "invoice", "customer_id").agg(
        F.sum("total").alias("revenue"), F.sum("quantity").alias("quantity"), F.max("invoice_date").alias("latest_sale")
    )
    types = {m: baskets.schema[m].dataType for m in ("revenue", "quantity")}
    per_day = baskets.groupBy("series_id", "date").agg(
        *[F.sum(m).cast(kind).alias(m) for m, kind in types.items()],
        F.countDistinct("invoice").alias("n_invoices"),
        F.countDistinct("customer_id").alias("n_customers"),
        F.max("latest_sale").alias("latest_sale"),
    )
    return fill_days(per_day, MEASURES)


def fill_days(per_day: DataFrame, measures: tuple[str, ...]) -> DataFrame:
    """Insert the missing calendar days of every series with zero measures.

    Each day is expanded up to the day before the next one, so no calendar join is needed.
    """
    following = F.lead("date").over(W.partitionBy("series_id").orderBy("date"))
    last_day = F.coalesce(F.date_sub("_next", 1), F.col("date"))
    expanded = per_day.withColumn("_next", following).withColumn(
        "_day", F.explode(F.sequence("date", last_day))
    )
    sold = F.col("_day") == F.col("date")
    zero = {m: F.when(sold, F.col(m)).otherwise(F.lit(0).cast(per_day.schema[m].dataType)) for m in measures}
    kept = {c: F.when(sold, F.col(c)) for c in per_day.columns if c not in {"series_id", "date", *measures}}
    return expanded.withColumns(zero | kept).withColumn("date", F.col("_day")).select(*per_day.columns)


def add_rolling(
    daily: DataFrame, windows: tuple[int, ...] = WINDOWS, columns: tuple[str, ...] = ("revenue", "quantity")
) -> DataFrame:
    """Trailing mean and sample deviation over full windows; NULL until a window is full."""
    added = {}
    for size in windows:
        frame = W.partitionBy("series_id").orderBy("date").rowsBetween(1 - size, 0)
        full = F.count(F.lit(1)).over(frame) == size
        for c in columns:
            value = F.col(c).cast("double")
            added[f"{c}_roll{size}_mean"] = F.when(full, F.avg(value).over(frame))
            added[f"{c}_roll{size}_std"] = F.when(full, F.stddev_samp(value).over(frame))
    return daily.withColumns(added)


def flag_partial_days(daily: DataFrame, close_hour: int = CLOSE_HOUR) -> DataFrame:
    """Flag a series' first or last day when its latest sale is before closing time."""
    whole = W.partitionBy("series_id")
    boundary = (F.col("date") == F.min("date").over(whole)) | (F.col("date") == F.max("date").over(whole))
    early = F.coalesce(F.hour("latest_sale") < close_hour, F.lit(False))
    return daily.withColumn("is_partial_day", boundary & early)


def demand_series(flagged: DataFrame, column: str = "quantity", exclude_partial: bool = True) -> DataFrame:
    """(series_id, ds, y) without partial boundary days."""
    kept = flagged.filter(~F.col("is_partial_day")) if exclude_partial else flagged
    return kept.select("series_id", F.col("date").alias("ds"), F.col(column).cast("double").alias("y"))


def date_range(daily: DataFrame, first: str, last: str) -> DataFrame:
    return daily.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def weekday_profile(series: DataFrame) -> DataFrame:
    """Mean demand and share of zero days per day of week."""
    return series.groupBy("series_id", day_of_week(F.col("ds")).alias("dow")).agg(
        F.avg("y").alias("mean_y"),
        (F.avg((F.col("y") == 0).cast("int")) * 100).alias("pct_zero_days"),
    )


def monthly_lines(lines: DataFrame) -> DataFrame:
    """Line count per month start, months without lines included."""
    counts = lines.groupBy(
        F.lit("all").alias("series_id"), F.trunc("invoice_date", "month").alias("date")
    ).agg(F.count("*").alias("n_lines"))
    following = F.lead("date").over(W.partitionBy("series_id").orderBy("date"))
    last = F.coalesce(F.add_months("_next", -1), F.col("date"))
    return (
        counts.withColumn("_next", following)
        .withColumn("month", F.explode(F.sequence("date", last, F.expr("interval 1 month"))))
        .select("month", F.when(F.col("month") == F.col("date"), F.col("n_lines")).otherwise(0).alias("n_lines"))
    )


def period_growth(daily: DataFrame, split_date: str, columns: tuple[str, ...] = MEASURES) -> DataFrame:
    """Mean per measure before and after a date, and the growth in percent."""
    later = F.col("date") >= F.lit(split_date).cast("date")
    long = daily.select(
        "series_id", later.alias("later"), *[F.col(c).cast("double").alias(c) for c in columns]
    ).unpivot(["series_id", "later"], list(columns), "measure", "value")
    means = long.groupBy("series_id", "measure").agg(
        F.avg(F.when(~F.col("later"), F.col("value"))).alias("mean_before"),
        F.avg(F.when(F.col("later"), F.col("value"))).alias("mean_after"),
    )
    return means.withColumn(
        "growth_pct", (ratio(F.col("mean_after"), F.col("mean_before")) - 1) * 100
    )
