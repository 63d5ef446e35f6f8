"""Customer features kept up to date by batches of lines, without reading old lines again.

A batch leaves additive sums per (customer, invoice): an invoice may be split over days and batches, and
its parts add up. The state is a base table and the batches after it; ``compact`` folds them into
a base with the next version number. Every write is safe to repeat: a batch replaces the files of its own
id, and a version counts only once it is complete, so a job that died is simply run again.

A batch that is delivered again under its id changes nothing once it is in a base and replaces itself
before that; late lines come as a batch of their own.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.expressions import days_later, elapsed_days, ntz
from basketry.sources.sinks import write_batch

STATE = "customer_id long, invoice string, revenue decimal(28,4), quantity long, n_lines long, first_sale timestamp_ntz, last_sale timestamp_ntz"


def invoice_sums(customer_sales: DataFrame) -> DataFrame:
    """Additive sums of the lines of each (customer, invoice)."""
    return customer_sales.groupBy("customer_id", "invoice").agg(
        F.sum("total").cast("decimal(28,4)").alias("revenue"),
        F.sum("quantity").cast("long").alias("quantity"),
        F.count("*").alias("n_lines"),
        F.min("invoice_date").alias("first_sale"),
        F.max("invoice_date").alias("last_sale"),
    )


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy("customer_id", "invoice").agg(
        F.sum("revenue").cast("decimal(28,4)").alias("revenue"),
        F.sum("quantity").alias("quantity"),
        F.sum("n_lines").alias("n_lines"),
        F.min("first_sale").alias("first_sale"),
        F.max("last_sale").alias("last_sale"),
    )


def add_batch(customer_sales: DataFrame, folder: str, batch: str) -> None:
    """Store the sums of a batch under its id; the same id replaces itself."""
    write_batch(invoice_sums(customer_sales), f"{folder}/batches", batch)


def version(spark: SparkSession, folder: str) -> int:
    """Number of the newest complete base, 0 if there is none."""
    base = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/base")
    system = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(base):
        return 0
    done = system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/base/v*/applied/_SUCCESS"))
    return max((int(s.getPath().getParent().getParent().getName()[1:]) for s in done), default=0)


def _base(spark: SparkSession, folder: str, number: int) -> tuple[DataFrame, DataFrame]:
    """Sums of a base and the ids of the batches in it."""
    if not number:
        return spark.createDataFrame([], STATE), spark.createDataFrame([], "batch string")
    return (
        spark.read.schema(STATE).parquet(f"{folder}/base/v{number}/sums"),
        spark.read.schema("batch string").parquet(f"{folder}/base/v{number}/applied"),
    )


def _pending(spark: SparkSession, folder: str, applied: DataFrame) -> DataFrame:
    """Sums of the batches that are in no base yet, with their id."""
    try:
        batches = spark.read.schema(STATE + ", batch string").parquet(f"{folder}/batches")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE + ", batch string")
    return batches.join(F.broadcast(applied), "batch", "left_anti")  # one row per batch of days


def read_state(spark: SparkSession, folder: str) -> DataFrame:
    """Sums per (customer, invoice) over the newest base and all batches after it."""
    sums, applied = _base(spark, folder, version(spark, folder))
    return _added(sums.unionByName(_pending(spark, folder, applied).drop("batch")))


def compact(spark: SparkSession, folder: str) -> int:
    """Fold all batches into a base with the next number; returns the newest number."""
    number = version(spark, folder)
    sums, applied = _base(spark, folder, number)
    pending = _pending(spark, folder, applied)
    new = pending.select("batch").distinct()
    if new.isEmpty():
        return number
    target = f"{folder}/base/v{number + 1}"
    _added(sums.unionByName(pending.drop("batch"))).write.mode("overwrite").parquet(f"{target}/sums")
    # Written last: a base without it is not counted and is overwritten by the next attempt.
    applied.unionByName(new).write.mode("overwrite").parquet(f"{target}/applied")
    return number + 1


def state_rfm(state: DataFrame, snapshot_date: str | None = None) -> DataFrame:
    """The same table as ``rfm.compute_rfm`` of all lines, from the sums."""
    snapshot = days_later(state.agg(F.max("last_sale")).scalar(), 1) if snapshot_date is None else ntz(snapshot_date)
    per_customer = state.groupBy("customer_id").agg(
        F.max("last_sale").alias("last_sale"), F.count("*").alias("frequency"), F.sum("revenue").cast("decimal(28,4)").alias("monetary")
    )
    return per_customer.select("customer_id", elapsed_days(F.col("last_sale"), snapshot).alias("recency_days"), "frequency", "monetary")
