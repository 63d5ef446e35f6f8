"""Registered queries on kept state: sketches, incremental sums, quarantined records, tests in the JVM."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from basketry.operators import customer_state, daily, drift, segmentation, series, sketches, stationarity
from basketry.plans import prepared as P
from basketry.plans.model_queries import _scaled
from basketry.plans.retail_queries import _churn_snapshots, _demand_snapshots, query
from basketry.session import scratch_path, stage
from basketry.sources import readers, sinks
from basketry.sources.schemas import CSV_TIMESTAMP, RAW

LINE_COLUMNS = ["quantity", "unit_price"]
POINTS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


# --- sketches -----------------------------------------------------------------------------------


def _day_sketches(spark, sf_dir):
    """One stored sketch per day and column; later reports merge these and leave the lines alone."""
    lines = P.completed(spark, sf_dir).withColumn("date", F.to_date("invoice_date"))
    return stage(sketches.quantile_sketches(lines, LINE_COLUMNS, ["date"]), "day_sketches")


def _answered(spark, sf_dir):
    lines = P.completed(spark, sf_dir)
    answers = sketches.quantiles(sketches.merged(_day_sketches(spark, sf_dir)), POINTS)
    return sketches.with_true_ranks(lines, answers, LINE_COLUMNS), lines


@query
def quantile_sketches(spark, sf_dir):
    """Quantiles from merged day sketches beside the exact ones, with the rank error."""
    from basketry.operators.scale import exact_quantiles

    answers, lines = _answered(spark, sf_dir)
    exact = exact_quantiles(lines, LINE_COLUMNS, POINTS).withColumnRenamed("value", "exact")
    return answers.join(exact, ["column", "probability"])


@query
def quantile_bounds(spark, sf_dir):
    """Rows under every sketch, and whether each answer is within the stated rank error."""
    answers, _ = _answered(spark, sf_dir)
    sizes = sketches.merged(_day_sketches(spark, sf_dir)).select("column", "n", F.col("low").alias("low"), F.col("high").alias("high"))
    table = answers.join(sizes, "column").select("column", "probability", "n", "low", "high", "within")
    return P.rounded(table, 6, "low", "high")


@query
def customer_movements(spark, sf_dir):
    """Active, new, retained and lost customers per month from daily sketches of their numbers."""
    lines = P.customers(spark, sf_dir).withColumn("date", F.to_date("invoice_date"))
    days = stage(sketches.key_sketches(lines, "customer_id", ["date"]), "customer_sketches")
    return P.present(sketches.key_movements(days))


@query
def drift_interval(spark, sf_dir):
    """Exact two-sample distances, and whether the interval from stored sketches of both snapshots covers them."""
    out = None
    for model, rows, columns in (
        ("churn", _churn_snapshots(spark, sf_dir), drift.CHURN_COLUMNS),
        ("forecast", _demand_snapshots(spark, sf_dir), drift.DEMAND_COLUMNS),
    ):
        rows = stage(rows, "snapshots")  # for the sketches and the exact distances
        kept = stage(sketches.quantile_sketches(rows, list(columns), ["snapshot"]), "snapshot_sketches")
        part = [kept.filter(F.col("snapshot") == s) for s in ("reference", "current")]
        interval = sketches.distances(*part).select("column", "ks_low", "ks_high")
        exact = drift.drift_distances(rows, columns).select("column", "n_reference", "n_current", "ks_distance")
        table = exact.join(interval, "column").select(
            F.lit(model).alias("model"), "column", "n_reference", "n_current", "ks_distance",
            F.col("ks_distance").between(F.col("ks_low") - 1e-9, F.col("ks_high") + 1e-9).alias("covered"),
        )
        out = table if out is None else out.unionByName(table)
    return P.rounded(out, 6, "ks_distance")


# --- incremental state and checked input --------------------------------------------------------


@query
def customer_state_rfm(spark, sf_dir):
    """RFM from batches: a year each, with some lines delivered late and two batches delivered twice."""
    lines, folder = P.customers(spark, sf_dir), scratch_path(spark, "customer_state")
    year, late = F.year("invoice_date"), F.pmod(F.xxhash64("invoice", "stock_code"), F.lit(50)) == 0
    years = [r[0] for r in lines.select(year).distinct().orderBy(year).collect()]  # a calendar's years
    for number, of in enumerate(years):
        customer_state.add_batch(lines.filter((year == of) & ~late), folder, f"year-{of}")
        if number == len(years) // 2:
            customer_state.compact(spark, folder)
    for of in (years[0], years[-1]):  # one that is in the base, one that is not
        customer_state.add_batch(lines.filter((year == of) & ~late), folder, f"year-{of}")
    customer_state.add_batch(lines.filter(late), folder, "late")
    return customer_state.state_rfm(customer_state.read_state(spark, folder)).select("customer_id", "recency_days", "frequency", F.col("monetary").cast("double"))


@query
def csv_quarantine(spark, sf_dir):
    """An extract with broken prices and times read back: good rows, and rejected rows by reason."""
    lines = P.raw_lines(spark, sf_dir)
    text = lines.withColumn("invoice_date", F.date_format("invoice_date", CSV_TIMESTAMP)).select([F.col(c).cast("string").alias(c) for c in RAW.fieldNames()])
    price = F.when(F.col("quantity").cast("int") % 11 == 0, "n/a").otherwise(F.col("unit_price"))
    moment = F.when(F.col("quantity").cast("int") % 13 == 0, "yesterday").otherwise(F.col("invoice_date"))
    path = scratch_path(spark, "broken") + ".csv"
    sinks.write_table(text.withColumns({"unit_price": price, "invoice_date": moment}), path, "csv")
    good, rejected = readers.read_csv_checked(spark, path)
    kept = good.agg(F.lit("good").alias("part"), F.count("*").alias("n_rows"), F.sum("quantity").alias("quantity"))
    reason = F.array_join(F.array_sort("reasons"), ",")
    parts = rejected.groupBy(reason.alias("part")).agg(F.count("*").alias("n_rows")).withColumn("quantity", F.lit(None).cast("long"))
    return kept.unionByName(parts)


# --- tests and models without Python workers ----------------------------------------------------


@query
def level_stationarity(spark, sf_dir):
    """The level-stationarity test of quantity and revenue per country, as it is and differenced."""
    flagged, long = P.daily_flagged(spark, sf_dir, "country"), None
    for column in ("quantity", "revenue"):
        rows = daily.demand_series(flagged, column).withColumn("column", F.lit(column))
        long = rows if long is None else long.unionByName(rows)
    tested = stationarity.run_tests(long).select("series_id", "column", "form", "n_observations", "kpss_statistic", "kpss_p_value", "kpss_n_lags")
    return P.rounded(tested, 6, "kpss_statistic", "kpss_p_value")


@query
def decompose_robust(spark, sf_dir):
    table = series.decompose_robust(P.demand(spark, sf_dir))
    return P.rounded(P.present(table), 5, "trend", "seasonal", "resid", "weight")


@query
def nearest_centers(spark, sf_dir):
    """Customers and squared distances per center, for centers given as means of five groups."""
    scaled = _scaled(spark, sf_dir)
    group = F.pmod(F.col("customer_id"), F.lit(5))
    means = scaled.groupBy(group.alias("g")).agg(*[F.avg(c).alias(c) for c in segmentation.SCALED]).orderBy("g").collect()
    centers = np.array([[r[c] for c in segmentation.SCALED] for r in means])
    placed = segmentation.Centers(centers, 0.0, 0).assign(scaled)
    return P.rounded(segmentation.inertia(placed, centers), 4, "inertia")
