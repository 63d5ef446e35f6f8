"""Scans: transaction extracts, feature tables and logs."""

from __future__ import annotations

import logging
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.sources.schemas import CSV_TIMESTAMP, PIPELINE_LOG, RAW_CSV, SOURCE_COLUMNS

log = logging.getLogger(__name__)


def missing_columns(df: DataFrame) -> list[str]:
    """Canonical columns that ``df`` lacks under either of their names."""
    return sorted(
        source
        for source, name in SOURCE_COLUMNS.items()
        if source not in df.columns and name not in df.columns
    )


def normalize_schema(df: DataFrame) -> DataFrame:
    """Rename source columns to canonical names; keep unknown ones; report missing ones."""
    missing = missing_columns(df)
    if missing:
        log.warning("source is missing expected columns: %s", missing)
    return df.withColumnsRenamed({s: n for s, n in SOURCE_COLUMNS.items() if s in df.columns})


def _typed(name: str, text: Column) -> Column:
    """A declared column from its text; NULL if the text does not fit."""
    if name == "invoice_date":
        # The format decides what fits; the cast keeps local times as they are written.
        fits = F.try_to_timestamp(text, F.lit(CSV_TIMESTAMP)).isNotNull()
        return F.when(fits, text.try_cast("timestamp_ntz"))
    if name == "customer_id":
        return text.try_cast("double").try_cast("long")
    declared = {f.name: f.dataType for f in RAW_CSV}
    return text.try_cast(declared[name]) if name in declared else text


def read_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows) of a CSV extract; together they are all of its records.

    A record is quarantined if it has too few or too many fields or a text that does not fit its
    declared type: ``record`` holds its fields, ``reasons`` the columns that do not fit, or ``_record`` for
    one that does not match the header. Missing values are no reason.
    """
    names = spark.read.csv(path, header=True, encoding="UTF-8").columns
    fields = ", ".join(f"`{n}` string" for n in [*names, "_record"])
    text = spark.read.csv(
        path, schema=fields, header=True, encoding="UTF-8", enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord="_record"
    )
    named = normalize_schema(text)
    columns = [c for c in named.columns if c != "_record"]
    misfit = lambda c: F.when(F.col(f"`{c}`").isNotNull() & _typed(c, F.col(f"`{c}`")).isNull(), F.lit(c))
    reasons = F.when(F.col("_record").isNotNull(), F.array(F.lit("_record"))).otherwise(F.array_compact(F.array(*map(misfit, columns))))
    judged = named.withColumn("reasons", reasons)
    good = judged.filter(F.size("reasons") == 0).select([_typed(c, F.col(f"`{c}`")).alias(c) for c in columns])
    whole = F.coalesce("_record", F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]))).alias("record")
    return good, judged.filter(F.size("reasons") > 0).select(whole, "reasons")


def read_csv_extract(spark: SparkSession, path: str) -> DataFrame:
    """Read a CSV extract by its header, with declared instead of inferred types."""
    text = spark.read.csv(path, header=True, encoding="UTF-8", enforceSchema=False)
    named = normalize_schema(text)
    declared = {f.name: f.dataType for f in RAW_CSV}
    typed = []
    for name in named.columns:
        column = F.col(f"`{name}`")
        if name == "invoice_date":
            column = F.to_timestamp_ntz(column, F.lit(CSV_TIMESTAMP))
        elif name == "customer_id":
            column = column.cast("double").cast("long")
        elif name in declared:
            column = column.cast(declared[name])
        typed.append(column.alias(name))
    return named.select(*typed)


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """Read one extract, choosing the reader by file suffix."""
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix == ".csv":
        return read_csv_extract(spark, path)
    if suffix == ".parquet":
        return normalize_schema(spark.read.parquet(path))
    raise ValueError(f"Unsupported source file type: {suffix}")


def union_yearly(extracts: dict[str, DataFrame]) -> DataFrame:
    """Stack yearly extracts, tagging every row with the extract it came from."""
    out = None
    for origin, df in extracts.items():
        tagged = normalize_schema(df).withColumn("source_sheet", F.lit(origin))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no extract given")
    return out


def read_table_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Read a table with a declared schema; a missing path gives an empty DataFrame."""
    try:
        reader = spark.read.schema(schema).format(fmt)
        if fmt == "csv":
            # Text that does not fit the declared type is an error, not a NULL.
            reader = reader.option("header", True).option("timestampNTZFormat", CSV_TIMESTAMP)
            reader = reader.option("mode", "FAILFAST")
        return reader.load(path).select(*schema.fieldNames())
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err.getCondition() or ""):
            raise
        return spark.createDataFrame([], schema)


def read_pipeline_log(spark: SparkSession, path: str) -> DataFrame:
    """Read the JSON-lines audit log, oldest first; blank lines and a missing log are fine."""
    entries = read_table_or_empty(spark, path, PIPELINE_LOG, "json")
    return entries.filter(F.col("timestamp").isNotNull()).orderBy("timestamp")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark finds a file or folder at ``path``."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def artifact_status(spark: SparkSession, artifacts: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """One row per named artifact: does its path exist yet, and how many rows has it?"""
    out = spark.createDataFrame([], "artifact string, ready boolean, n_rows long")
    for name, path in artifacts.items():
        if path_exists(spark, path):
            rows = spark.read.format(fmt).option("header", True).load(path).agg(F.count("*").alias("n_rows"))
            out = out.unionByName(rows.select(F.lit(name).alias("artifact"), F.lit(True).alias("ready"), "n_rows"))
        else:
            out = out.unionByName(spark.createDataFrame([(name, False, None)], out.schema))
    return out
