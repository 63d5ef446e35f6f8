"""Sinks: feature tables, snapshots, JSON documents, CSV exports and the audit log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.sources.schemas import CSV_TIMESTAMP


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None
) -> str:
    """Overwrite one result table; large sales tables are best partitioned by month."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_snapshot(df: DataFrame, path: str) -> str:
    """Persist the normalized raw lines once."""
    return write_table(df, path)


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Write several named tables below one folder."""
    return {name: write_table(df, f"{folder}/{name}", fmt) for name, df in tables.items()}


def write_documents(df: DataFrame, path: str) -> str:
    """Write one nested JSON document per row."""
    df.write.mode("overwrite").json(path)
    return path


def export_csv(df: DataFrame, columns: list[str], path: str) -> str:
    """Export chosen columns as CSV with a header."""
    return write_table(df.select(*columns), path, "csv")


def write_batch(df: DataFrame, path: str, batch: str, fmt: str = "parquet") -> str:
    """Store ``df`` in a table as the batch of that id: another attempt with the same id replaces it."""
    writer = df.withColumn("batch", F.lit(batch)).write.format(fmt).mode("overwrite").partitionBy("batch")
    writer.option("partitionOverwriteMode", "dynamic").save(path)
    return path


def append_pipeline_log(df: DataFrame, path: str, batch: str | None = None) -> str:
    """Append run summaries to the JSON-lines audit log, stamped with the current time.

    A call that may be repeated names its ``batch``: however often it runs, its entries are there once.
    """
    return write_batch(df.withColumn("timestamp", F.current_timestamp()), path, batch or uuid.uuid4().hex, "json")
