import json

import pytest
from pyspark.sql import functions as F

from basketry.operators import runs
from basketry.plans import prepared
from basketry.sources import readers, sinks
from basketry.sources.schemas import RAW, RUNS, SOURCE_COLUMNS

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country,Till\n"


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        HEADER
        + '489434,85048,"GLASS BALL, 20",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom,T1\n'
        + "C489449,22087,,-12,2009-12-01 10:33:00,2.95,,Australia,T2\n",
        encoding="utf-8",
    )
    return str(path)


def test_csv_extract_keeps_codes_and_unknown_columns(spark, csv_file):
    df = readers.read_extract(spark, csv_file)
    assert df.schema["customer_id"].dataType.simpleString() == "bigint"
    assert df.schema["invoice_date"].dataType.simpleString() == "timestamp_ntz"
    rows = {r["invoice"]: r for r in df.collect()}
    assert rows["489434"]["customer_id"] == 13085 and rows["489434"]["description"] == "GLASS BALL, 20"
    assert str(rows["489434"]["invoice_date"]) == "2009-12-01 07:45:00"
    assert rows["C489449"]["customer_id"] is None and rows["C489449"]["quantity"] == -12
    assert {r["Till"] for r in rows.values()} == {"T1", "T2"}
    assert readers.missing_columns(df) == ["SourceSheet"]


def test_unknown_suffix_is_rejected(spark):
    with pytest.raises(ValueError, match="Unsupported"):
        readers.read_extract(spark, "/tmp/sales.xlsx")


def test_yearly_extracts_are_tagged(spark, csv_file):
    df = readers.read_extract(spark, csv_file)
    both = readers.union_yearly({"Year 2009-2010": df, "Year 2010-2011": df})
    assert {r["source_sheet"]: r["count"] for r in both.groupBy("source_sheet").count().collect()} == {
        "Year 2009-2010": 2,
        "Year 2010-2011": 2,
    }
    assert set(SOURCE_COLUMNS.values()) <= set(both.columns)


def test_tables_round_trip_and_missing_ones_are_empty(spark, lines, tmp_path):
    table = lines({"invoice": "1"}, {"invoice": "2", "customer_id": None})
    paths = sinks.write_tables({"a": table, "b": table.limit(1)}, str(tmp_path), "csv")
    back = readers.read_table_or_empty(spark, paths["a"], RAW, "csv")
    assert sorted(back.collect()) == sorted(table.collect())
    assert readers.read_table_or_empty(spark, f"{tmp_path}/none", RAW).isEmpty()
    status = readers.artifact_status(spark, {"a": paths["a"], "none": f"{tmp_path}/none"}, "csv")
    assert {r["artifact"]: (r["ready"], r["n_rows"]) for r in status.collect()} == {"a": (True, 2), "none": (False, None)}
    sinks.write_snapshot(table, f"{tmp_path}/raw")
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 2
    sinks.export_csv(table, ["invoice", "country"], f"{tmp_path}/export")
    assert spark.read.csv(f"{tmp_path}/export", header=True).columns == ["invoice", "country"]


def test_partitioned_table(spark, lines, tmp_path):
    table = lines({"country": "France"}, {"country": "Spain"})
    sinks.write_table(table, f"{tmp_path}/t", partition_by=["country"])
    assert {p.name for p in (tmp_path / "t").iterdir() if p.is_dir()} == {"country=France", "country=Spain"}


def test_audit_log_appends_and_skips_blank_lines(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert readers.read_pipeline_log(spark, path).isEmpty()
    row = spark.range(1).select(
        F.lit("daily_batch").alias("dag"), F.array(F.lit("churn")).alias("retrain_targets")
    )
    sinks.append_pipeline_log(row, path)
    sinks.append_pipeline_log(row, path)
    (tmp_path / "log" / "part-extra.json").write_text("\n\n" + json.dumps({"dag": "none"}) + "\n")
    entries = readers.read_pipeline_log(spark, path).collect()
    assert [(e["dag"], e["retrain_targets"]) for e in entries] == [("daily_batch", ["churn"])] * 2


def test_run_records(spark, tmp_path):
    path = f"{tmp_path}/runs"
    sweep = spark.createDataFrame([(2, 0.5, None), (3, 0.7, 1.0)], "k int, silhouette double, extra double")
    name = F.concat(F.lit("k"), F.col("k").cast("string"))
    runs.append_runs(runs.run_records(sweep, "segments", name, ["k"], ["silhouette", "extra"]), path)
    table = readers.read_table_or_empty(spark, path, RUNS)
    best = runs.best_run(table, "silhouette", smallest=False).first()
    assert (best["run_name"], best["value"]) == ("k3", 0.7)
    latest = {r["run_name"]: r for r in runs.latest_runs(table, ["silhouette", "extra"]).collect()}
    assert latest["k2"]["extra"] is None and latest["k3"]["extra"] == 1.0


def test_staged_tables_are_dropped(spark, lines):
    from pathlib import Path

    from basketry import session

    table = session.stage(lines({"country": "France"}), "lines")
    folder = Path(table.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists()
    session.drop_staged(spark)
    assert not folder.parent.exists()
    prepared._staged.clear()
