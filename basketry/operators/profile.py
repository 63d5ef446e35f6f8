"""Data-quality profile of the raw lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.cleaning import is_cancellation
from basketry.operators.scale import exact_quantiles

PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, count and percent rounded to 2."""
    counted = df.agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    ).unpivot("_n", df.columns, "column", "missing_count")
    share = F.try_divide(F.col("missing_count") * 100.0, F.col("_n"))
    return counted.select("column", "missing_count", F.round(share, 2).alias("missing_pct"))


def describe_numeric(
    df: DataFrame, columns: list[str], percentiles: tuple[float, ...] = PERCENTILES
) -> DataFrame:
    """Count, mean, sample deviation, min, exact percentiles and max, one row per column."""
    moments = (
        df.select([F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .groupBy("column")
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    points = exact_quantiles(df, columns, list(percentiles))
    wide = points.groupBy("column").agg(
        *[
            F.max(F.when(F.col("probability") == p, F.col("value"))).alias(f"p{round(p * 100)}")
            for p in percentiles
        ]
    )
    return moments.join(wide, "column")


def quality_counts(df: DataFrame) -> DataFrame:
    """Negative quantity, negative price, zero price and cancellation lines with their share."""
    checks = {
        "negative_quantity": F.col("quantity") < 0,
        "negative_price": F.col("unit_price") < 0,
        "zero_price": F.col("unit_price") == 0,
        "cancellation": is_cancellation(),
    }
    counted = df.agg(
        F.count("*").alias("_n"), *[F.count_if(c).alias(name) for name, c in checks.items()]
    ).unpivot("_n", list(checks), "check", "n_lines")
    return counted.select(
        "check", "n_lines", F.try_divide(F.col("n_lines") * 100.0, F.col("_n")).alias("pct")
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one_row = df.agg(
        F.map_from_arrays(
            F.array(*[F.lit(f"{a}|{b}") for a, b in pairs]),
            F.array(
                *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")) for a, b in pairs]
            ),
        ).alias("m")
    ).select(F.explode("m").alias("pair", "corr"))
    left, right = F.split("pair", r"\|")[0], F.split("pair", r"\|")[1]
    both = F.when(left == right, F.array(F.struct(left.alias("x"), right.alias("y")))).otherwise(
        F.array(
            F.struct(left.alias("x"), right.alias("y")), F.struct(right.alias("x"), left.alias("y"))
        )
    )
    return one_row.select(F.explode(both).alias("p"), "corr").select("p.x", "p.y", "corr")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts over equal bins of a clipped column; the last bin includes the upper edge."""
    clipped = F.greatest(F.least(F.col(column).cast("double"), F.lit(float(high))), F.lit(float(low)))
    bucket = F.least(F.floor((clipped - low) * bins / (high - low)) + 1, F.lit(bins)).cast("int")
    return df.filter(F.col(column).isNotNull()).groupBy(bucket.alias("bin")).agg(F.count("*").alias("n_lines"))


def top_countries(df: DataFrame, n: int = 15) -> DataFrame:
    return (
        df.groupBy("country")
        .agg(F.count("*").alias("n_lines"))
        .orderBy(F.desc("n_lines"), "country")
        .limit(n)
    )


def top_transactions(sales: DataFrame, stock_code: str, n: int = 3) -> DataFrame:
    """Largest lines of one product by quantity."""
    return (
        sales.filter(F.col("stock_code") == stock_code)
        .orderBy(F.desc("quantity"), "invoice_date", "invoice", "unit_price")
        .select("invoice", "invoice_date", "quantity", "unit_price")
        .limit(n)
    )
