"""Unit-root and level-stationarity tests, one small regression problem per series.

A series has one row per calendar day, so its values are an array bounded by the length of the calendar.
Regressions are Gram matrices of lagged arrays, eliminated by array expressions: no Python worker runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.expressions import normal_cdf
from basketry.functions.linear import corner_path, diagonal, dot, eliminate
from basketry.operators.series import first_difference, stationarity_verdict

# Published coefficients (constant, no trend) for the unit-root test.
# Response surface of the critical values, c0 + c1/n + c2/n^2 + c3/n^3.
ADF_CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}
# Polynomials whose normal CDF is the p-value, below and above the switch point.
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_SWITCH, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74
# Level-stationarity test: critical values and their p-values.
KPSS_CRITICAL = {"10%": 0.347, "5%": 0.463, "2.5%": 0.574, "1%": 0.739}
KPSS_P = (0.10, 0.05, 0.025, 0.01)
LEVEL = 0.05
TESTS = ("adf_statistic", "adf_p_value", "adf_n_lags", "adf_n_obs", "adf_critical", "kpss_statistic", "kpss_p_value", "kpss_n_lags")


def _lags(z: Column, k: Column, n: Column) -> Column:
    """Autocovariance of a centred array at lag k."""
    return dot(F.slice(z, k + 1, n - k), F.slice(z, F.lit(1), n - k)) / n


def level_test(series: DataFrame) -> DataFrame:
    """Adds the level-stationarity test (data-driven lag rule) to rows of (z, upto, n): standardized values and
    their running sums from 0 on."""
    z, n = F.col("z"), F.col("n")
    pilot = F.transform(F.sequence(F.lit(0), F.floor(F.pow(n, F.lit(2 / 9))).cast("int")), lambda k: _lags(z, k, n))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    s0 = 2 * total(F.col("_pilot")) - F.get("_pilot", F.lit(0))
    s1 = 2 * total(F.transform("_pilot", lambda c, k: c * k))
    width = 1.1447 * F.pow(F.pow(F.try_divide(s1, s0), 2), F.lit(1 / 3)) * F.pow(n, F.lit(1 / 3))
    lags = F.least(F.coalesce(F.floor(width).cast("int"), F.lit(0)), n - 1)
    chosen = F.col("kpss_n_lags")
    # The triangular weights add up to squared sums of ``chosen + 1`` neighbours, zero beyond the ends.
    square = lambda x: x * x
    window = lambda j: F.get("upto", F.least(n, j + chosen + 1)) - F.get("upto", F.greatest(F.lit(0), j))
    windows = F.aggregate(F.sequence(-chosen, n - 1), F.lit(0.0), lambda acc, j: acc + square(window(j)))
    partial = F.aggregate("upto", F.lit(0.0), lambda acc, x: acc + square(x))
    statistic = F.try_divide(partial, n.cast("double") * n * F.col("_long"))
    points = list(zip(KPSS_CRITICAL.values(), KPSS_P, strict=True))
    p_value = F.lit(points[-1][1])
    for (x0, p0), (x1, p1) in reversed(list(zip(points, points[1:], strict=False))):
        p_value = F.when(F.col("kpss_statistic") < x1, p0 + (F.col("kpss_statistic") - x0) * ((p1 - p0) / (x1 - x0))).otherwise(p_value)
    p_value = F.when(F.col("kpss_statistic") <= points[0][0], points[0][1]).otherwise(p_value)
    nan = F.lit(math.nan)
    return (
        series.withColumn("_pilot", pilot)
        .withColumn("kpss_n_lags", F.when(F.col("flat"), F.lit(0)).otherwise(lags))
        .withColumn("_long", windows / (n * (chosen + 1)))
        .withColumn("kpss_statistic", F.when(F.col("flat"), nan).otherwise(F.coalesce(statistic, nan)))
        .withColumn("kpss_p_value", F.when(F.isnan("kpss_statistic"), nan).otherwise(p_value))
        .drop("_pilot", "_long")
    )


CONSTANT, LEVEL_AT = -2, -1  # in the order of a regression's columns; 0 is the target, k the change k days before


def _order(lags: Column, level_last: bool) -> Column:
    shifted = _counting(F.lit(1), lags)
    constant, level, target = (F.array(F.lit(i)) for i in (CONSTANT, LEVEL_AT, 0))
    return F.concat(constant, shifted, level, target) if level_last else F.concat(constant, level, shifted, target)


def _counting(first: Column, last: Column) -> Column:
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _across(lags: Column, skip: Column) -> Column:
    """``[d][i]``: sum of products of the changes i and i + d days before, from position ``skip`` on.

    From one i to the next the products only differ at both ends of the rows, so every d needs one pass.
    """
    rows = F.size("change") - skip
    before = lambda k: F.slice("change", skip - k + 1, rows)
    at = lambda i: F.get("change", i)

    def diagonal_of(d: Column) -> Column:
        ends = lambda r: at(skip - 1 - r) * at(skip - 1 - r - d) - at(skip + rows - 1 - r) * at(skip + rows - 1 - r - d)
        first = F.array(dot(before(F.lit(0)), before(d)))
        return F.aggregate(_counting(F.lit(1), lags - d), first, lambda acc, i: F.concat(acc, F.array(F.element_at(acc, -1) + ends(i - 1))))

    return F.transform(F.sequence(F.lit(0), lags), diagonal_of)


def _products(lags: Column, skip: Column, across: Column) -> Column:
    """Sums and products of constant, level and lagged changes: lag by lag, again from both ends of the rows.

    The level is the level a day before plus the change since, which adds the products of changes.
    """
    rows = F.size("change") - skip
    level, target = F.slice("z", skip + 1, rows), F.slice("change", skip + 1, rows)
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    change, height = (lambda i: F.get("change", i)), (lambda i: F.get("z", i))

    def following(first: Column, step) -> Column:
        return F.aggregate(_counting(F.lit(1), lags), F.array(first), lambda acc, k: F.concat(acc, F.array(F.element_at(acc, -1) + step(k))))

    def moved(k: Column) -> Column:
        return height(skip - 1) * change(skip - k) - height(skip + rows - 1) * change(skip + rows - k) + F.get(F.get(across, k - 1), F.lit(1))

    return F.struct(
        rows.cast("double").alias("rows"),
        total(level).alias("level"),
        dot(level, level).alias("level_level"),
        following(total(target), lambda k: change(skip - k) - change(skip + rows - k)).alias("sums"),
        following(dot(level, target), moved).alias("with_level"),
        across.alias("across"),
    )


def _gram(products: Column, order: Column) -> Column:
    def entry(a: Column, b: Column) -> Column:
        low, high = F.least(a, b), F.greatest(a, b)
        with_constant = F.when(high == CONSTANT, products["rows"]).when(high == LEVEL_AT, products["level"]).otherwise(F.get(products["sums"], high))
        with_level = F.when(high == LEVEL_AT, products["level_level"]).otherwise(F.get(products["with_level"], high))
        return F.when(low == CONSTANT, with_constant).when(low == LEVEL_AT, with_level).otherwise(F.get(F.get(products["across"], high - low), low))

    return F.transform(order, lambda a: F.transform(order, lambda b: entry(a, b)))


def unit_root_test(series: DataFrame) -> DataFrame:
    """Adds the augmented Dickey-Fuller test with constant to rows of (z, n).

    One elimination of the Gram matrix with the most lags leaves the residual sums of all lag orders on a
    common sample, of which AIC picks; the chosen order is fitted on all of its rows.
    """
    n = F.col("n")
    most = F.least(F.ceil(12 * F.pow(n / 100, F.lit(0.25))).cast("int"), F.floor(n / 2).cast("int") - 2)
    rows = F.size("change") - F.col("_most")
    aic = F.transform(
        F.slice("_path", 3, F.col("_most") + 1),
        lambda rss, k: rows * (F.ln(2 * math.pi * F.greatest(rss, F.lit(1e-300)) / rows) + 1) + 2 * (k + 2),
    )
    width, used = F.col("adf_n_lags") + 2, F.size("change") - F.col("adf_n_lags")
    # What is left of level and target once constant and lags are taken out.
    own = F.get(F.get("_left", width - 1), width - 1)
    cross, rest = F.get(F.get("_left", width - 1), width), F.get(F.get("_left", width), width)
    slope = F.try_divide(cross, own)
    error = F.sqrt(F.greatest(F.try_divide(rest - slope * cross, (used - width) * own), F.lit(0.0)))
    tested = ~F.col("flat") & (F.col("_most") >= 0)
    return (
        series.withColumn("change", F.zip_with(F.slice("z", F.lit(2), n - 1), F.slice("z", F.lit(1), n - 1), lambda a, b: a - b))
        .withColumn("_most", F.when(F.col("flat"), F.lit(-1)).otherwise(most))
        .withColumn("_across", F.when(F.col("_most") >= 0, _across(F.col("_most"), F.col("_most"))))
        .withColumn("_products", F.when(F.col("_most") >= 0, _products(F.col("_most"), F.col("_most"), F.col("_across"))))
        .withColumn("_order", F.when(F.col("_most") >= 0, _order(F.col("_most"), False)))
        .withColumn("_gram", _gram(F.col("_products"), F.col("_order")))
        .withColumn("_lengths", diagonal(F.col("_gram")))
        .withColumn("_path", corner_path(F.col("_gram"), F.col("_most") + 2, F.col("_lengths")))
        .withColumn("_aic", aic)
        .withColumn("adf_n_lags", F.when(tested, (F.array_position("_aic", F.array_min("_aic")) - 1).cast("int")).otherwise(0))
        .withColumn("_across", F.when(tested, _across(F.col("adf_n_lags"), F.col("adf_n_lags"))))
        .withColumn("_products", F.when(tested, _products(F.col("adf_n_lags"), F.col("adf_n_lags"), F.col("_across"))))
        .withColumn("_order", F.when(tested, _order(F.col("adf_n_lags"), True)))
        .withColumn("_gram", _gram(F.col("_products"), F.col("_order")))
        .withColumn("_lengths", diagonal(F.col("_gram")))
        .withColumn("_left", eliminate(F.col("_gram"), F.col("adf_n_lags") + 1, F.col("_lengths")))
        .withColumn("adf_statistic", F.coalesce(F.when(tested, F.try_divide(slope, error)), F.lit(math.nan)))
        .withColumn("adf_n_obs", F.when(tested, used).otherwise(0))
        .withColumn("adf_p_value", unit_root_p_value(F.col("adf_statistic")))
        .withColumn("adf_critical", _critical(F.col("adf_n_obs")))
        .drop("change", "_most", "_across", "_products", "_order", "_gram", "_lengths", "_path", "_aic", "_left")
    )


def unit_root_p_value(statistic: Column) -> Column:
    def polynomial(powers: tuple[float, ...]) -> Column:
        out = F.lit(0.0)
        for c in reversed(powers):
            out = out * statistic + c
        return out

    z = F.when(statistic <= ADF_SWITCH, polynomial(ADF_SMALL_P)).otherwise(polynomial(ADF_LARGE_P))
    inside = normal_cdf(z)
    return F.when(F.isnan(statistic), statistic).when(statistic >= ADF_MAX, 1.0).when(statistic <= ADF_MIN, 0.0).otherwise(inside)


def _critical(rows: Column) -> Column:
    inverse = F.try_divide(F.lit(1.0), rows.cast("double"))
    pairs = []
    for name, (c0, c1, c2, c3) in ADF_CRITICAL.items():
        pairs += [F.lit(name), c0 + inverse * (c1 + inverse * (c2 + inverse * c3))]
    return F.when(rows > 0, F.create_map(*pairs)).otherwise(F.create_map().cast("map<string,double>"))


def run_tests(long: DataFrame) -> DataFrame:
    """Both tests per (series, column) for the level and the first difference.

    ``long`` has (series_id, column, ds, y).
    """
    keyed = long.withColumn("_series", F.col("series_id")).withColumn(
        "series_id", F.concat_ws("\u0001", "series_id", "column")
    )
    both = keyed.withColumn("form", F.lit("level")).unionByName(
        first_difference(keyed).withColumn("form", F.lit("diff1"))
    )
    # Moments and running sums are taken over rows: an expression over the array would be evaluated for every element.
    running = F.sum(F.col("y").cast("double")).over(W.partitionBy("_series", "column", "form").orderBy("ds"))
    day = F.struct("ds", F.col("y").cast("double").alias("y"), "running")
    values = both.withColumn("running", running).groupBy(F.col("_series").alias("series_id"), "column", "form").agg(
        F.array_sort(F.collect_list(day)).alias("days"), F.count("*").cast("int").alias("n"),
        F.avg("y").alias("_mean"), F.stddev_pop("y").alias("_spread"), (F.min("y") == F.max("y")).alias("flat"),
    )
    # Both statistics are the same for any origin and scale, and sums of products are exact enough for this one.
    scaled = lambda value: F.coalesce(F.try_divide(value, F.col("_spread")), F.lit(0.0))
    z = F.transform("days", lambda r: scaled(r["y"] - F.col("_mean")))
    sums = F.transform("days", lambda r, i: scaled(r["running"] - (i + 1) * F.col("_mean")))
    series = values.withColumns({"z": z, "upto": F.concat(F.array(F.lit(0.0)), sums)}).drop("days", "_mean", "_spread")
    tested = unit_root_test(level_test(series))
    return tested.select("series_id", "column", "form", F.col("n").cast("long").alias("n_observations"), *TESTS)


def diagnostics(long: DataFrame) -> DataFrame:
    """One nested document per (series, column): tests and verdicts of level and difference."""
    adf = F.struct(
        F.lit("ADF").alias("test"),
        F.col("adf_statistic").alias("statistic"),
        F.col("adf_p_value").alias("p_value"),
        F.col("adf_n_lags").alias("n_lags"),
        F.col("adf_n_obs").alias("n_obs"),
        F.col("adf_critical").alias("critical_values"),
        (F.col("adf_p_value") < LEVEL).alias("is_stationary"),
    )
    critical = F.create_map(*[F.lit(v) for pair in KPSS_CRITICAL.items() for v in pair])
    kpss = F.struct(
        F.lit("KPSS").alias("test"),
        F.col("kpss_statistic").alias("statistic"),
        F.col("kpss_p_value").alias("p_value"),
        F.col("kpss_n_lags").alias("n_lags"),
        critical.alias("critical_values"),
        (F.col("kpss_p_value") >= LEVEL).alias("is_stationary"),
    )
    tested = run_tests(long).select(
        "series_id", "column", "form", "n_observations", adf.alias("adf"), kpss.alias("kpss")
    ).withColumn(
        "verdict",
        stationarity_verdict(F.col("adf.is_stationary"), F.col("kpss.is_stationary")),
    )

    def of(form: str, name: str):
        return F.max_by(name, F.col("form") == form)

    return tested.groupBy("series_id", "column").agg(
        of("level", "n_observations").alias("n_observations"),
        of("level", "adf").alias("adf_level"),
        of("level", "kpss").alias("kpss_level"),
        of("level", "verdict").alias("level_verdict"),
        of("diff1", "adf").alias("adf_diff1"),
        of("diff1", "kpss").alias("kpss_diff1"),
        of("diff1", "verdict").alias("diff1_verdict"),
    )
