"""Deduplication, flags and the completed / customer / excluded split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.sources.schemas import MONEY

# Stock codes for postage, fees, adjustments, samples and tests.
ADMIN_STOCK_CODES = (
    "POST", "DOT", "M", "C2", "D", "S", "B", "BANK CHARGES", "ADJUST", "ADJUST2",
    "AMAZONFEE", "CRUK", "PADS", "TEST001", "TEST002",
)
FLAGS = ("is_cancellation", "is_admin_code")


def is_cancellation() -> Column:
    return F.coalesce(F.col("invoice").startswith("C"), F.lit(False))


def is_admin_code() -> Column:
    return F.coalesce(F.upper("stock_code").isin(*ADMIN_STOCK_CODES), F.lit(False))


def is_real_sale() -> Column:
    """True for a genuine priced sale; NULL quantity or price counts as not a sale."""
    return F.coalesce(
        ~F.col("is_cancellation")
        & ~F.col("is_admin_code")
        & (F.col("quantity") > 0)
        & (F.col("unit_price") > 0),
        F.lit(False),
    )


def dedupe(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop exact duplicate rows; copies collapse in the map-side combine."""
    return df.dropDuplicates(subset) if subset else df.distinct()


def flag_lines(df: DataFrame) -> DataFrame:
    """Fill descriptions, flag cancellations and admin codes, add the exact line total."""
    return df.withColumns(
        {
            "description": F.coalesce("description", F.lit("UNKNOWN")),
            "is_cancellation": is_cancellation(),
            "is_admin_code": is_admin_code(),
            "total": (F.col("quantity") * F.col("unit_price")).cast(MONEY),
        }
    )


def completed_sales(flagged: DataFrame) -> DataFrame:
    return flagged.filter(is_real_sale()).drop(*FLAGS)


def excluded_sales(flagged: DataFrame) -> DataFrame:
    """Exact complement of ``completed_sales``, flags kept."""
    return flagged.filter(~is_real_sale())


def customer_sales(completed: DataFrame) -> DataFrame:
    return completed.filter(F.col("customer_id").isNotNull()).withColumn(
        "customer_id", F.col("customer_id").cast("long")
    )


def clean_transactions(raw: DataFrame, subset: list[str] | None = None) -> dict[str, DataFrame]:
    """All three cleaned tables of a raw transaction table."""
    return tables_of(flag_lines(dedupe(raw, subset)))


def tables_of(flagged: DataFrame) -> dict[str, DataFrame]:
    """The three cleaned tables of deduplicated, flagged lines; keep ``flagged`` if all are read."""
    completed = completed_sales(flagged)
    return {
        "completed_sales": completed,
        "customer_sales": customer_sales(completed),
        "excluded": excluded_sales(flagged),
    }


def exclusion_reasons(flagged: DataFrame) -> DataFrame:
    """Number of excluded lines per reason; the first matching reason counts."""
    reason = (
        F.when(F.col("is_cancellation"), "cancellation")
        .when(F.col("is_admin_code"), "admin_code")
        .when(F.col("quantity") <= 0, "non_positive_quantity")
        .when(F.col("unit_price") <= 0, "non_positive_price")
    )
    return (
        excluded_sales(flagged).groupBy(reason.alias("reason")).agg(F.count("*").alias("n_lines"))
    )


def table_counts(raw: DataFrame, flagged: DataFrame) -> DataFrame:
    """Row counts of the raw and the cleaned tables, in two aggregations."""
    known = F.col("customer_id").isNotNull()
    cleaned = flagged.agg(
        F.count("*").alias("deduplicated"),
        F.count_if(is_real_sale()).alias("completed_sales"),
        F.count_if(is_real_sale() & known).alias("customer_sales"),
        F.count_if(~is_real_sale()).alias("excluded"),
    ).unpivot([], ["deduplicated", "completed_sales", "customer_sales", "excluded"], "table", "n_rows")
    return raw.agg(F.count("*").alias("n_rows")).select(F.lit("raw").alias("table"), "n_rows").union(
        cleaned
    )
