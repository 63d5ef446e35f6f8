"""Declared schemas and source column names."""

from __future__ import annotations

from pyspark.sql import types as T

# Source column name -> canonical column name.
SOURCE_COLUMNS = {
    "Invoice": "invoice",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
    "SourceSheet": "source_sheet",
}

_TYPES = {
    "invoice": T.StringType(),
    "stock_code": T.StringType(),
    "description": T.StringType(),
    "quantity": T.IntegerType(),
    "invoice_date": T.TimestampNTZType(),
    "unit_price": T.DoubleType(),
    "customer_id": T.DoubleType(),  # arrives as "17850.0"; cast to BIGINT after reading
    "country": T.StringType(),
    "source_sheet": T.StringType(),
}

RAW_CSV = T.StructType([T.StructField(c, t) for c, t in _TYPES.items()])
RAW = T.StructType(
    [T.StructField(c, T.LongType() if c == "customer_id" else t) for c, t in _TYPES.items()]
)
MONEY = "decimal(18,4)"
# CSV text of a timestamp, the same for reading and writing.
CSV_TIMESTAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("parent_run_id", T.StringType()),
        T.StructField("experiment", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

_DRIFT = T.StructType(
    [
        T.StructField("drifted_share", T.DoubleType()),
        T.StructField("retrain_recommended", T.BooleanType()),
    ]
)
_CHURN_CHECK = T.StructType(
    [
        T.StructField("auc_roc", T.DoubleType()),
        T.StructField("auc_meets_target", T.BooleanType()),
        T.StructField("precision_at_top20pct", T.DoubleType()),
        T.StructField("precision_meets_target", T.BooleanType()),
    ]
)
_FORECAST_CHECK = T.StructType(
    [T.StructField("mape", T.DoubleType()), T.StructField("mape_meets_target", T.BooleanType())]
)
_CONSTRAINTS = T.StructType(
    [T.StructField("churn", _CHURN_CHECK), T.StructField("forecast", _FORECAST_CHECK)]
)
PIPELINE_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("dag", T.StringType()),
        T.StructField(
            "drift",
            T.StructType([T.StructField("churn_drift", _DRIFT), T.StructField("demand_drift", _DRIFT)]),
        ),
        T.StructField("constraints", _CONSTRAINTS),
        T.StructField("retrain_targets", T.ArrayType(T.StringType())),
        T.StructField("retrained_churn", _CHURN_CHECK),
        T.StructField("retrained_forecast", _FORECAST_CHECK),
        T.StructField("constraints_after_retraining", _CONSTRAINTS),
    ]
)
