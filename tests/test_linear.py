"""Least squares in the JVM against numpy, and the tests built on it."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.functions import linear
from basketry.functions.expressions import normal_cdf
from basketry.operators import stationarity
from basketry.operators.stationarity import ADF_CRITICAL, ADF_LARGE_P, ADF_MAX, ADF_MIN, ADF_SMALL_P, ADF_SWITCH, KPSS_CRITICAL, KPSS_P


def adf_test(y: np.ndarray) -> tuple[float, float, int, int]:
    """Augmented Dickey-Fuller with constant; lag order by AIC over a common sample.

    Returns statistic, p-value, lags and observations used.
    """
    n = len(y)
    change = np.diff(y)
    max_lag = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    if max_lag < 0 or np.ptp(y) == 0:
        return math.nan, math.nan, 0, 0

    def regress(lags: int, skip: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        target = change[skip:]
        rows = len(target)
        columns = [np.ones(rows), y[skip : skip + rows]]
        columns += [change[skip - k : skip - k + rows] for k in range(1, lags + 1)]
        design = np.column_stack(columns)
        coef = np.linalg.lstsq(design, target, rcond=None)[0]
        return design, target - design @ coef, coef

    def aic(lags: int) -> float:
        design, rest, _ = regress(lags, max_lag)
        rows, width = design.shape
        return rows * (math.log(2 * math.pi * max(rest @ rest, 1e-300) / rows) + 1) + 2 * width

    lags = min(range(max_lag + 1), key=aic)
    design, rest, coef = regress(lags, lags)
    rows, width = design.shape
    variance = rest @ rest / (rows - width) * np.linalg.pinv(design.T @ design)[1, 1]
    statistic = float(coef[1] / math.sqrt(variance)) if variance > 0 else math.nan
    return statistic, adf_p_value(statistic), lags, rows


def adf_p_value(statistic: float) -> float:
    if math.isnan(statistic):
        return math.nan
    if statistic >= ADF_MAX:
        return 1.0
    if statistic <= ADF_MIN:
        return 0.0
    powers = ADF_SMALL_P if statistic <= ADF_SWITCH else ADF_LARGE_P
    z = sum(c * statistic**i for i, c in enumerate(powers))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def kpss_test(y: np.ndarray) -> tuple[float, float, int]:
    """Level-stationarity test with the data-driven lag rule; statistic, p-value, lags."""
    n = len(y)
    rest = y - y.mean()
    if n < 2 or np.ptp(y) == 0:
        return math.nan, math.nan, 0

    def autocov(k: int) -> float:
        return float(rest[k:] @ rest[: n - k]) / n

    pilot = [autocov(k) for k in range(int(n ** (2 / 9)) + 1)]
    s0 = pilot[0] + 2 * sum(pilot[1:])
    s1 = 2 * sum(k * c for k, c in enumerate(pilot))
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    long_run = autocov(0) + 2 * sum((1 - k / (lags + 1)) * autocov(k) for k in range(1, lags + 1))
    statistic = float(np.sum(np.cumsum(rest) ** 2)) / (n * n * long_run)
    return statistic, float(np.interp(statistic, list(KPSS_CRITICAL.values()), KPSS_P)), lags


def frame(spark, named):
    rows = [("s" + name, "y", i, float(v)) for name, values in named.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "series_id string, column string, i int, y double")
    return df.withColumn("ds", F.date_add(F.lit("2010-01-01").cast("date"), "i")).drop("i")


def same(a, b, tolerance=1e-6):
    return (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=tolerance, abs=tolerance)


def test_both_tests_equal_numpy(spark):
    rng = np.random.default_rng(7)
    named = {
        "noise": rng.normal(size=400), "walk": np.cumsum(rng.normal(size=500)) * 1e4 + 3e5, "short": rng.normal(size=9), "tiny": [1.0, 2.0, 4.0, 3.0, 9.0],
        "one": [5.0], "flat": [3.0] * 30, "week": 100 + 15 * np.sin(np.arange(300) * 2 * np.pi / 7) + rng.normal(size=300),
        "sparse": np.where(rng.random(250) < 0.9, 0.0, rng.integers(1, 9, 250)), "trend": np.arange(120) * 2.0 + rng.normal(size=120), "long": rng.normal(size=2400),
    }
    got = {(r["series_id"][1:], r["form"]): r for r in stationarity.run_tests(frame(spark, named)).collect()}
    for name, values in named.items():
        values = np.asarray(values, float)
        for form, y in (("level", values), ("diff1", np.diff(values))):
            if not len(y):
                assert (name, form) not in got
                continue
            row = got[name, form]
            statistic, p_value, lags, rows = adf_test(y)
            assert (row["adf_n_lags"], row["adf_n_obs"]) == (lags, rows), (name, form)
            assert same(row["adf_statistic"], statistic, 1e-5) and same(row["adf_p_value"], p_value, 1e-5), (name, form)
            statistic, p_value, lags = kpss_test(y)
            assert row["kpss_n_lags"] == lags and same(row["kpss_statistic"], statistic) and same(row["kpss_p_value"], p_value), (name, form)
            for name_, (c0, c1, c2, c3) in ADF_CRITICAL.items() if rows else ():
                assert row["adf_critical"][name_] == pytest.approx(c0 + c1 / rows + c2 / rows**2 + c3 / rows**3)
            assert row["n_observations"] == len(y) and (set(row["adf_critical"]) == {"1%", "5%", "10%"}) == (rows > 0)


def test_no_python_worker_runs(spark):
    plan = stationarity.diagnostics(frame(spark, {"a": range(20)}))._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "InArrow" not in plan and "EvalPython" not in plan


def test_solve_and_residual_path(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(60, 5)), rng.normal(size=60)
    x[:, 3] = x[:, 0] + x[:, 1]  # explained by those before it
    columns = [c.tolist() for c in x.T] + [y.tolist()]
    df = spark.createDataFrame([(columns,)], "c array<array<double>>").withColumn("g", linear.gram(F.col("c")))
    df = df.withColumn("l", linear.diagonal(F.col("g")))
    matrix = F.transform(F.slice("g", 1, 5), lambda row: F.slice(row, 1, 5))
    moments = F.transform(F.slice("g", 1, 5), lambda row: F.element_at(row, 6))
    row = df.select(
        linear.corner_path(F.col("g"), F.lit(5), F.col("l")).alias("path"), linear.solve(matrix, moments, 5, F.col("l")).alias("coef")
    ).first()
    for k in range(6):
        rest = y - x[:, :k] @ np.linalg.lstsq(x[:, :k], y, rcond=None)[0] if k else y
        assert row["path"][k] == pytest.approx(rest @ rest)
    assert x @ np.array(row["coef"]) == pytest.approx(x @ np.linalg.lstsq(x, y, rcond=None)[0])


def test_normal_cdf(spark):
    points = [-12.0, -8.0, -5.0, -1.959964, -0.3, 0.0, 1e-9, 0.5, 2.5758, 6.0, 9.0, math.nan]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in points], "z double").select(normal_cdf(F.col("z"))).collect()]
    for p, value in zip(points, got, strict=True):
        assert same(value, math.nan if math.isnan(p) else 0.5 * math.erfc(-p / math.sqrt(2)), 1e-13)
