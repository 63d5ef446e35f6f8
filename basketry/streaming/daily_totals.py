"""Daily totals of arriving extracts, kept up to date file by file.

The batch operator is ``operators.daily.daily_aggregates``. Here each run picks up the extracts
that arrived since the last one, and a day is written once the watermark has passed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from basketry.operators.cleaning import completed_sales, flag_lines


def daily_totals(lines: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Revenue, quantity and lines per day of a stream of raw lines.

    An exact copy is dropped when it arrives within the allowed lateness.
    """
    timed = lines.withColumn("_at", F.col("invoice_date").cast("timestamp")).withWatermark("_at", lateness)
    sales = completed_sales(flag_lines(timed.dropDuplicatesWithinWatermark(lines.columns)))
    per_day = sales.groupBy(F.window("_at", "1 day")).agg(
        F.sum("total").alias("revenue"), F.sum("quantity").alias("quantity"), F.count("*").alias("n_lines")
    )
    return per_day.select(F.to_date("window.start").alias("date"), "revenue", "quantity", "n_lines")


def run_available(totals: DataFrame, path: str, state_dir: str) -> StreamingQuery:
    """Process everything that has arrived, append the finished days, then stop."""
    return (
        totals.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", state_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
