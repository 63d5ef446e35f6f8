import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import scale


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows share one value, so ranges must cut through the tie-breaker."""
    rng = np.random.default_rng(3)
    values = np.where(rng.random(4000) < 0.5, 7, rng.integers(0, 50, 4000))
    return spark.createDataFrame([(i, int(v), "ab"[i % 2]) for i, v in enumerate(values)], "id long, v long, g string")


def test_running_totals_match_a_plain_scan(hot):
    got = scale.running_totals(
        hot, {"v": F.col("v"), "id": F.col("id")}, {"n": F.lit(1), "s": F.col("v")}, following={"next": "id"}
    ).collect()
    rows = sorted((r["v"], r["id"]) for r in got)
    by_id = {r["id"]: r for r in got}
    total = 0
    for i, (v, id_) in enumerate(rows):
        total += v
        r = by_id[id_]
        assert (r["n_running"], r["s_running"], r["n_all"]) == (i + 1, total, 4000)
        assert r["next"] == (rows[i + 1][1] if i + 1 < len(rows) else None)


def test_running_totals_per_group(hot):
    got = scale.running_totals(hot, {"v": -F.col("v"), "id": F.col("id")}, {"n": F.lit(1)}, group=["g"]).collect()
    for g in "ab":
        rows = sorted(((-r["v"], r["id"], r["n_running"], r["n_all"]) for r in got if r["g"] == g))
        assert [r[2] for r in rows] == list(range(1, len(rows) + 1))
        assert {r[3] for r in rows} == {len(rows)}


def test_ranges_split_the_hot_value(hot):
    key = F.struct("v", "id")
    sizes = [r["count"] for r in scale._with_range(hot, key, ["g"]).groupBy("_range").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 4000 / 3


def test_sample_is_bounded_per_task_and_needs_no_order(spark):
    """No top-k node, and 64 tasks together send about the wanted number of rows."""
    df = spark.range(0, 64_000, 1, 64)
    sample = scale.hash_sample(df, F.col("id"), 512)
    assert "TakeOrderedAndProject" not in sample._jdf.queryExecution().executedPlan().toString()
    assert 380 < sample.count() < 650


@pytest.mark.parametrize("n", [1, 2, 13, 500])
def test_quantiles_interpolate_linearly(spark, n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 20, n).astype(float)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double")
    points = [0.0, 0.01, 0.5, 0.95, 0.999, 1.0]
    got = {r["probability"]: r["value"] for r in scale.exact_quantiles(df, ["x"], points).collect()}
    assert got == pytest.approx({p: float(np.quantile(x, p)) for p in points})


def test_attach_by_key_joins_hot_and_cold_keys_once(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("row")
    )
    dim = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("row").alias("last")).filter("k <> 2500")
    out = scale.attach_by_key(rows, dim, "k", "n", hot_share=0.01)
    assert out.count() == 2999 and out.select("row").distinct().count() == 2999
    assert out.filter("k = 0 AND last = 1999").count() == 2000
