"""Prepared tables shared by the registered queries."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.operators import cleaning, daily
from basketry.session import stage
from basketry.sources.order_sales import sales_lines

# Parameters of the registered queries on the test tables.
CUTOFF = "2001-05-03 00:00:00"
REFERENCE_CUTOFF = "2001-01-22 00:00:00"
DEMAND_SPLIT = "2000-08-01"
HOME = "AFRICA"
VALIDATION_DAYS = TEST_DAYS = 56

_staged: dict[tuple, DataFrame] = {}
SOURCES = ("lineitem", "orders", "part", "supplier", "nation", "region")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir)


def _version(spark: SparkSession, sf_dir: str) -> str:
    """A digest of names, sizes and times of the source tables' files, as the file system lists them.

    One listing a table on the driver; no job runs and no row is read.
    """
    digest = hashlib.md5()
    for name in SOURCES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        # Reading a file may change its access time.
        digest.update(re.sub(r"access_time=\d+", "", spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(listed)).encode())
    return digest.hexdigest()


def flagged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated and flagged lines, written once per application and state of the input files.

    Later stages read the staged Parquet with pushed filters and pruned columns instead of
    repeating the joins and the full-row deduplication. Changed files are staged anew.

    An invoice number holds its order's key, so rows are equal with the key if they are without it; with it, equal
    rows already meet where the orders were joined, and the lines of an invoice stay together.
    """
    key = (spark.sparkContext.applicationId, sf_dir, _version(spark, sf_dir))
    if key not in _staged:
        lines = sales_lines(spark, sf_dir, carried=("l_orderkey",))
        flagged = cleaning.flag_lines(cleaning.dedupe(lines).drop("l_orderkey"))
        flagged = flagged.withColumn("is_sale", cleaning.is_real_sale())
        _staged[key] = stage(flagged.sortWithinPartitions("invoice_date"), "flagged_lines")
    return _staged[key]


def completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged_lines(spark, sf_dir).filter("is_sale").drop("is_sale", *cleaning.FLAGS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.customer_sales(completed(spark, sf_dir))


def daily_flagged(spark: SparkSession, sf_dir: str, series: str | None = None) -> DataFrame:
    return daily.flag_partial_days(daily.daily_aggregates(completed(spark, sf_dir), series))


def demand(spark: SparkSession, sf_dir: str, series: str | None = "country") -> DataFrame:
    return daily.demand_series(daily_flagged(spark, sf_dir, series))


def present(df: DataFrame) -> DataFrame:
    """Plain output types: dates and timestamps as text, decimals as doubles."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        columns.append(column.alias(field.name))
    return df.select(columns)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})
