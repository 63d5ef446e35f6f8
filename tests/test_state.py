"""Kept state: sketches, batches, quarantined records, repeated appends, changed inputs."""

import re
import shutil
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry import session
from basketry.operators import cleaning, customer_state, daily, rfm, runs, series, sketches
from basketry.plans import prepared, state_queries
from basketry.sources import readers, sinks
from basketry.sources.order_sales import sales_lines
from basketry.sources.schemas import RUNS


def test_merged_quantiles_are_within_the_rank_error(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.lognormal(0, 2, 30_000), np.full(10_000, 5.0)])
    rows = [(int(i % 40), float(v), None if i % 3 else float(-v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "day int, x double, y double")
    days = sketches.quantile_sketches(df, ["x", "y"], ["day"])
    points = [i / 50 for i in range(1, 50)]
    answers = sketches.quantiles(sketches.merged(days), points)
    checked = sketches.with_true_ranks(df, answers, ["x", "y"]).collect()
    assert len(checked) == 98 and all(r["within"] for r in checked)
    merged = {r["column"]: (r["n"], r["low"], r["high"]) for r in sketches.merged(days).collect()}
    assert merged["x"] == (40_000, values.min(), values.max()) and merged["y"][0] == 13_334
    some = sketches.merged(days.filter("day < 10")).filter("column = 'x'").first()
    assert some["n"] == 10_000


def test_distance_interval_covers_the_exact_distance(spark):
    rng = np.random.default_rng(3)
    for shift, n in ((0.0, 5000), (0.3, 3000), (4.0, 50)):
        a, b = rng.normal(0, 1, 4000), np.round(rng.normal(shift, 1, n), 1)
        rows = [("r", float(v)) for v in a] + [("c", float(v)) for v in b]
        kept = sketches.quantile_sketches(spark.createDataFrame(rows, "snapshot string, x double"), ["x"], ["snapshot"])
        row = sketches.distances(*[kept.filter(F.col("snapshot") == s) for s in "rc"]).first()
        grid = np.sort(np.concatenate([a, b]))
        exact = np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) - np.searchsorted(np.sort(b), grid, "right") / n).max()
        assert row["ks_low"] <= exact <= row["ks_high"] and row["ks_high"] - row["ks_low"] < 0.1
        assert (row["n_reference"], row["n_current"]) == (4000, n)


def test_key_movements(spark):
    seen = {"2011-01-03": [1, 2, 3], "2011-01-30": [3, 4], "2011-02-01": [2, 5, None], "2011-04-02": [1, 5, 6]}
    rows = [(d, k) for d, keys in seen.items() for k in keys * 2]
    days = sketches.key_sketches(spark.createDataFrame(rows, "d string, k long").withColumn("date", F.to_date("d")), "k", ["date"])
    got = [tuple(r)[1:] for r in sketches.key_movements(days).orderBy("month").collect()]
    assert got == [(4, 4, 0, 0), (2, 1, 1, 3), (3, 1, 1, 1)]


def test_daily_counts_of_split_invoices(lines):
    from basketry.operators.cleaning import clean_transactions

    rows = [dict(invoice=str(i % 3), customer_id=[1, 2, None][i % 3] if i < 6 else 1, quantity=i + 1, stock_code=str(i)) for i in range(9)]
    row = daily.daily_aggregates(clean_transactions(lines(*rows))["completed_sales"]).first()
    assert (row["n_invoices"], row["n_customers"], row["quantity"]) == (3, 2, 45)


def test_state_after_batches_equals_all_lines(spark, sales, tmp_path):
    rng = np.random.default_rng(5)
    rows = [
        dict(invoice=str(rng.integers(1, 60)), customer_id=int(rng.integers(1, 9)), quantity=int(rng.integers(1, 20)), unit_price=float(rng.integers(1, 900)) / 100,
             stock_code=f"8{i}", invoice_date=f"2011-0{rng.integers(1, 7)}-1{rng.integers(0, 9)} 10:00:00")
        for i in range(200)
    ]
    all_lines, folder = sales(*rows).cache(), f"{tmp_path}/state"
    month, late = F.month("invoice_date"), F.crc32("stock_code") % 7 == 0
    assert customer_state.version(spark, folder) == 0 and customer_state.read_state(spark, folder).count() == 0
    for m in range(1, 7):
        batch = all_lines.filter((month == m) & ~late)
        customer_state.add_batch(batch, folder, f"m{m}")
        if m in (2, 4):
            assert customer_state.compact(spark, folder) == m // 2
        customer_state.add_batch(batch, folder, f"m{m}")  # delivered again
    customer_state.add_batch(all_lines.filter(late), folder, "late")

    def total():
        return sorted(map(tuple, customer_state.state_rfm(customer_state.read_state(spark, folder)).collect()))

    wanted = sorted(map(tuple, rfm.compute_rfm(all_lines).collect()))
    assert total() == wanted
    # A job that died while it wrote version 3: sums are there, the list of batches is not.
    customer_state.read_state(spark, folder).limit(3).write.parquet(f"{folder}/base/v3/sums")
    assert customer_state.version(spark, folder) == 2 and total() == wanted
    assert customer_state.compact(spark, folder) == 3 and total() == wanted
    assert customer_state.compact(spark, folder) == 3  # nothing new


def test_broken_records_are_quarantined(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text(
        "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
        "1,a,mug,2,2011-01-01 10:00:00,1.5,17850.0,UK\n"
        "2,b,,x,2011-01-01 10:00:00,n/a,17850.0,UK\n"
        "3,c,cup,2,01/02/2011,1.5,,UK\n"
        "4,d,few,2\n"
        "5,e,many,2,2011-01-01 10:00:00,1.5,1,UK,extra\n"
        "6,f,\"a, b\",-3,2011-01-02 11:00:00.5,0,,\n"
    )
    good, bad = readers.read_csv_checked(spark, str(path))
    assert {r["invoice"]: (r["quantity"], r["customer_id"], str(r["invoice_date"])) for r in good.collect()} == {
        "1": (2, 17850, "2011-01-01 10:00:00"), "6": (-3, None, "2011-01-02 11:00:00.500000")
    }
    reasons = sorted(sorted(r["reasons"]) for r in bad.collect())
    assert reasons == [["_record"], ["_record"], ["invoice_date"], ["quantity", "unit_price"]]
    assert all(r["record"] for r in bad.collect())
    whole = readers.read_csv_extract(spark, str(path)).schema
    assert [f.dataType for f in good.schema] == [f.dataType for f in whole]


def test_a_repeated_append_leaves_one_record(spark, tmp_path):
    records = spark.createDataFrame([("r", None, "e", "n", None, None, {"a": "1"}, {"m": 2.0})], RUNS)
    for batch in ("b1", "b1", "b2", None, None):
        runs.append_runs(records, f"{tmp_path}/runs", batch)
    table = readers.read_table_or_empty(spark, f"{tmp_path}/runs", RUNS)
    assert table.count() == 4 and table.columns == RUNS.fieldNames()
    entry = spark.sql("SELECT 'daily_batch' AS dag")
    for batch in ("x", "x", "y"):
        sinks.append_pipeline_log(entry, f"{tmp_path}/log", batch)
    assert readers.read_pipeline_log(spark, f"{tmp_path}/log").count() == 2


def test_changed_inputs_are_noticed_without_a_job(spark, sf, tmp_path):
    for name in prepared.SOURCES:
        shutil.copy(f"{sf}/{name}.parquet", tmp_path)
    before = spark._jsc.sc().dagScheduler().nextJobId()
    first = prepared._version(spark, str(tmp_path))
    open(f"{tmp_path}/part.parquet", "rb").read()
    assert prepared._version(spark, str(tmp_path)) == first
    shutil.copy(f"{sf}/orders.parquet", f"{tmp_path}/part.parquet")
    assert prepared._version(spark, str(tmp_path)) != first
    assert spark._jsc.sc().dagScheduler().nextJobId() == before


def _weekly(spark, spoil):
    season = np.array([10.0, 12, 8, 15, 20, 30, 5])
    rng = np.random.default_rng(1)
    y = np.array([200 + season[i % 7] + rng.normal(0, 0.5) for i in range(140)])
    if spoil:
        y[52] += 3000
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)], "series_id string, i int, y double")
    return df.select("series_id", F.date_add(F.lit("2010-01-04").cast("date"), F.col("i")).alias("ds"), "y")


def test_one_outlier_does_not_move_the_seasonal_means(spark):
    def means(table):
        return {r["ds"].weekday(): r["seasonal"] for r in table.collect()}

    clean, robust = (means(series.decompose_robust(_weekly(spark, s))) for s in (False, True))
    assert all(robust[d] == pytest.approx(clean[d], abs=0.01 * max(map(abs, clean.values()))) for d in range(7))
    plain = means(series.decompose(_weekly(spark, True)))
    assert max(abs(plain[d] - clean[d]) for d in range(7)) > 10
    weights = series.decompose_robust(_weekly(spark, True)).orderBy("weight").first()
    assert weights["weight"] == 0 and weights["observed"] > 3000


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}


def test_staged_and_cut_tables_leave_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(session.FREED)
    summed = spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count()
    staged, checkpointed = session.stage(summed, "freed"), session.cut(summed)
    assert not _shuffle_files(spark) - before
    assert sorted(staged.collect()) == sorted(checkpointed.collect()) == sorted(summed.collect())
    assert spark.conf.get(session.FREED) == setting


def test_equal_lines_meet_where_the_orders_are_joined(spark, tmp_path):
    """Without an exchange for the full rows; keys may repeat and be missing."""
    for name in prepared.SOURCES:
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name in ("orders", "lineitem", "part"):
            key = rows.columns[0]
            none = rows.limit(20).withColumn(key, F.lit(None).cast(rows.schema[key].dataType))
            rows = rows.unionByName(rows.filter(F.col(key) % 3 == 0)).unionByName(none)
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = sales_lines(spark, str(tmp_path), carried=("l_orderkey",))
        text = cleaning.dedupe(lines)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"HashAggregate\(.*\n\s*\+- HashAggregate\(.*\n\s*\+- Project", text)
        got = prepared.flagged_lines(spark, str(tmp_path)).drop("is_sale")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    expected = cleaning.flag_lines(cleaning.dedupe(sales_lines(spark, str(tmp_path), F.lit(True))))
    assert expected.count() > 1000 and got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_drift_interval_reads_its_snapshots_once(spark, sf):
    files = state_queries.drift_interval(spark, sf).inputFiles()
    assert files and not [f for f in files if "flagged_lines" in f]
