import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import (
    churn_model,
    density,
    drift,
    evaluation,
    forecasting,
    segmentation,
    series,
    stationarity,
)
from basketry.plans import jobs
from basketry.sources.schemas import RUNS


def test_metrics_leave_zero_actuals_out_of_mape(spark):
    df = spark.createDataFrame([(0.0, 10.0), (100.0, 90.0)], "a double, p double")
    row = df.agg(*evaluation.forecast_metrics(F.col("a"), F.col("p"))).first()
    assert (row["mae"], row["mape"], row["n_excluded_zero_actual"], row["n_total"]) == (10, 10, 1, 2)


def test_precision_covers_at_least_one_row(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (2, 0.5, 0), (3, 0.1, 0)], "id long, score double, label int")
    row = evaluation.precision_at_top_k(df, "id", 0.2).first()
    assert (row["k"], row["precision"]) == (1, 1.0)


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 1), (0.5, 0), (0.1, 0)], "score double, label int")
    assert evaluation.auc(evaluation.score_counts(df)).first()["auc_roc"] == pytest.approx(0.875)


def test_weights_prefer_the_smallest_on_ties_and_fall_back(spark):
    rows = [("s", d, 10.0, 10.0, 10.0) for d in ("2011-01-03", "2011-01-04")]
    df = spark.createDataFrame(rows, "series_id string, d string, actual double, additive_pred double, sequence_pred double")
    df = df.withColumn("ds", F.to_date("d"))
    assert evaluation.best_weight(evaluation.weight_sweep(df)).first()["global_weight"] == 0
    row = evaluation.day_type_weights(df).first()
    assert (row["weight_weekday"], row["weight_saturday"], row["weight_sunday"]) == (0, 0.5, 0.5)


@pytest.mark.parametrize(
    ("n_drifted", "retrain"), [(2, False), (4, True)]
)
def test_retrain_from_half_of_the_columns(spark, n_drifted, retrain):
    df = spark.createDataFrame([(i < n_drifted,) for i in range(7)], "drifted boolean")
    assert drift.drift_share(df).first()["retrain_recommended"] is retrain


def test_drift_distances_match_numpy(spark):
    rng = np.random.default_rng(1)
    ref, cur = rng.normal(0, 1, 300), rng.normal(0.4, 1, 200)
    rows = [("reference", float(v)) for v in ref] + [("current", float(v)) for v in cur]
    row = drift.drift_distances(spark.createDataFrame(rows, "snapshot string, x double"), ("x",)).first()
    grid = np.sort(np.concatenate([ref, cur]))
    gaps = np.abs(np.searchsorted(np.sort(ref), grid, "right") / 300 - np.searchsorted(np.sort(cur), grid, "right") / 200)
    assert row["ks_distance"] == pytest.approx(gaps.max())
    assert row["wasserstein_normed"] == pytest.approx(np.sum(gaps[:-1] * np.diff(grid)) / ref.std())
    x = math.sqrt(300 * 200 / 500) * gaps.max()
    p = 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 101))
    assert row["ks_p_asymptotic"] == pytest.approx(p)


def test_diagnostics_document(spark):
    rng = np.random.default_rng(5)
    walk = np.cumsum(rng.normal(size=300))
    rows = [("s", "quantity", i, float(v)) for i, v in enumerate(walk)]
    df = spark.createDataFrame(rows, "series_id string, column string, i int, y double")
    df = df.withColumn("ds", F.date_add(F.lit("2010-01-01").cast("date"), "i")).drop("i")
    doc = stationarity.diagnostics(df).first()
    assert doc["n_observations"] == 300
    assert (doc["level_verdict"], doc["diff1_verdict"]) == ("non_stationary", "stationary")
    assert doc["adf_level"]["critical_values"]["5%"] == pytest.approx(-2.87, abs=0.01)


def test_easter(spark):
    years = {2009: "2009-04-12", 2010: "2010-04-04", 2011: "2011-04-24", 1981: "1981-04-19", 2024: "2024-03-31"}
    df = spark.createDataFrame([(y,) for y in years], "y int").select("y", series.easter_sunday(F.col("y")).alias("d"))
    assert {r["y"]: str(r["d"]) for r in df.collect()} == years


def _daily(spark, values, name="s"):
    rows = [(name, i, float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "series_id string, i int, y double")
    return df.select("series_id", F.date_add(F.lit("2010-01-04").cast("date"), F.col("i")).alias("ds"), "y")


def test_split_is_disjoint_and_ordered(spark):
    split = series.train_test_split(_daily(spark, range(200)), 56, 56)
    spans = {r["split"]: (r["n"], r["a"], r["b"]) for r in split.groupBy("split").agg(
        F.count("*").alias("n"), F.min("y").alias("a"), F.max("y").alias("b")).collect()}
    assert spans == {"train": (88, 0, 87), "val": (56, 88, 143), "test": (56, 144, 199)}


def test_recursive_naive_uses_train_values_only(spark):
    split = series.train_test_split(_daily(spark, range(30)), 10)
    got = [r["naive"] for r in series.naive_seasonal(split, recursive=True).orderBy("ds").collect()]
    assert got == [13, 14, 15, 16, 17, 18, 19, 13, 14, 15]


def test_scaler_sees_train_rows_only(spark):
    split = series.train_test_split(_daily(spark, [2, 4] * 10 + [1000] * 5), 5)
    row = series.scale_series(split).first()
    assert (row["y_mean"], row["y_std"]) == pytest.approx((3, 1))


def test_additive_model_recovers_trend_and_week(spark):
    t = np.arange(500)
    split = series.train_test_split(_daily(spark, 100 + 0.2 * t + 15 * np.sin(2 * np.pi * t / 7)), 56)
    metrics, _ = forecasting.additive_sweep(split, series.naive_seasonal(split))
    best = metrics.orderBy("mape").first()
    assert metrics.count() == len(forecasting.ADDITIVE_SWEEP) and best["mape"] < 3


def test_what_if_totals(spark):
    forecast = spark.createDataFrame([("s", -5.0), ("s", 10.0), ("s", 20.0)], "series_id string, yhat double")
    row = forecasting.what_if(forecast, 10).first()
    assert (row["n_negative"], row["total_baseline"], row["total_adjusted"]) == (1, 30.0, pytest.approx(33.0))


def _brute_dbscan(x, eps, min_samples):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_samples
    labels, cluster = -np.ones(len(x), int), 0
    for i in range(len(x)):
        if core[i] and labels[i] == -1:
            labels[i], todo = cluster, [i]
            while todo:
                j = todo.pop()
                if core[j]:
                    fresh = np.flatnonzero(near[j] & (labels == -1))
                    labels[fresh] = cluster
                    todo.extend(fresh)
            cluster += 1
    return labels


@pytest.mark.parametrize("eps", [0.3, 1.5])
def test_dbscan_equals_brute_force(spark, eps):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 1, (150, 2)), rng.normal(4, 0.3, (100, 2)), rng.uniform(-5, 8, (60, 2)), np.zeros((80, 2))])
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    got = {r["id"]: r["cluster"] for r in density.dbscan(df, "id", ("a", "b"), eps, 8).collect()}
    assert [got[i] for i in range(len(x))] == list(_brute_dbscan(x, eps, 8))


@pytest.fixture(scope="module")
def customers(spark):
    rng = np.random.default_rng(4)
    rows = [(i, float(a), float(b), int(a + 0.3 * c > 0)) for i, (a, b, c) in enumerate(rng.normal(size=(600, 3)))]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, churned int")
    return churn_model.three_way_split(df, "customer_id", "churned").cache()


def test_split_is_exact_per_label(customers):
    counts = {(r["churned"], r["split"]): r["count"] for r in customers.groupBy("churned", "split").count().collect()}
    assert customers.count() == 600
    for label in (0, 1):
        n = sum(v for (c, _), v in counts.items() if c == label)
        test = math.ceil(0.2 * n)
        assert counts[label, "test"] == test and counts[label, "val"] == math.ceil(0.15 * (n - test))


@pytest.fixture(scope="module")
def model(customers):
    return churn_model.fit_trees(customers, ["a", "b"], "churned", churn_model.TreeConfig(3, 0.2, 15))


def test_scoring_orders_and_checks_columns(model, customers):
    scores = [r["churn_probability"] for r in churn_model.score_customers(model, customers).collect()]
    assert scores == sorted(scores, reverse=True)
    with pytest.raises(ValueError, match="missing"):
        churn_model.score_customers(model, customers.drop("b"))
    assert churn_model.evaluate(model, customers, "churned").first()["auc_roc"] > 0.9


def test_contributions_add_up_and_rank(spark, model, customers):
    rows = customers.filter("split = 'test'").limit(20).cache()
    one = customers.filter("customer_id = 7")
    values = churn_model.shapley_values(model, rows, one, permutations=3)
    sums = {r["customer_id"]: r["s"] for r in values.groupBy("customer_id").agg(F.sum("contribution").alias("s")).collect()}

    def margin(df):
        return {r["customer_id"]: 2 * r["rawPrediction"][1] for r in model.transform(df).collect()}

    base, own = margin(one)[7], margin(rows)
    assert sums == pytest.approx({i: v - base for i, v in own.items()}, abs=1e-6)
    assert churn_model.feature_importance(values).first()["feature"] == "a"


def test_saved_or_logged_model(spark, model, customers, tmp_path):
    none = spark.createDataFrame([], RUNS)
    with pytest.raises(ValueError, match="no saved model"):
        churn_model.load_model(spark, f"{tmp_path}/none", none, "churn_search")
    path = churn_model.save_model(model, f"{tmp_path}/model")
    assert churn_model.feature_names(churn_model.load_model(spark, path, none, "churn_search")) == ["a", "b"]
    logged = spark.createDataFrame([("r", None, "churn_prediction", "churn_search", None, None, {"model_path": path}, {})], RUNS)
    assert churn_model.load_model(spark, None, logged, "churn_search").stages


def test_choose_k(spark):
    sweep = spark.createDataFrame([(5, 0.9), (6, 0.3), (7, 0.4), (8, 0.4)], "k int, silhouette double")
    assert segmentation.choose_k(sweep) == 7
    with pytest.raises(ValueError, match="tried"):
        segmentation.choose_k(sweep, (10, 12))


def test_segmentation_job(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.integers(1, 400)), int(rng.integers(1, 30)), float(rng.lognormal(5, 1))) for i in range(300)]
    rfm = spark.createDataFrame(rows, "customer_id long, recency_days int, frequency long, monetary double")
    out = jobs.segmentation_job(rfm, range(5, 8), 1, [0.5], f"{tmp_path}/runs")
    assert out.chosen_k in (6, 7) and out.segments.count() == 300
    assert out.segments.select("segment_name").distinct().count() == out.chosen_k
    logged = spark.read.parquet(f"{tmp_path}/runs").collect()
    names = {r["run_name"]: r for r in logged}
    assert len(logged) == len({r["run_id"] for r in logged}) == 6 and all(r["start_time"] < r["end_time"] for r in logged)
    assert names["kmeans_6"]["parent_run_id"] == names["kmeans_sweep"]["run_id"]
    best = max(names[f"kmeans_{k}"]["metrics"]["silhouette"] for k in (5, 6, 7))
    assert names["kmeans_sweep"]["metrics"]["best_silhouette"] == best


def test_retraining_logs_fresh_metrics(spark, tmp_path):
    t = np.arange(300)
    split = series.train_test_split(_daily(spark, 100 + 15 * np.sin(2 * np.pi * t / 7)), 56, 56)
    report = jobs.retraining_job(
        spark, ["forecast"], None, split, f"{tmp_path}/runs", f"{tmp_path}/model", f"{tmp_path}/log", lag_iterations=3
    ).first()
    assert report["retrained_churn"] is None and report["retrained_forecast"]["mape"] < 12
    assert report["constraints_after_retraining"]["forecast"]["mape_meets_target"] is True
    names = {r["run_name"] for r in spark.read.parquet(f"{tmp_path}/runs").select("run_name").collect()}
    assert {"ensemble", "additive_config_0", "additive_config_sweep", "lag_config_3"} <= names
    assert spark.read.json(f"{tmp_path}/log").first()["dag"] == "model_retraining"


def test_kmeans_fits_rest_at_the_means_of_their_rows(spark):
    from basketry.operators import segmentation

    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(m, 0.3, (60, 3)) for m in (0, 3, 6)])
    rows = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], ["customer_id", *segmentation.SCALED]).cache()
    fits = segmentation.fit_starts(rows, [(k, s) for k in (2, 3) for s in range(4)])
    for (k, _), fit in fits.items():
        assert len(fit.centers) == k and fit.iterations <= segmentation.MAX_ITER
        nearest = ((points[:, None] - fit.centers[None]) ** 2).sum(2)
        assert fit.cost == pytest.approx(nearest.min(1).sum())
        for j in set(nearest.argmin(1)):
            assert fit.centers[j] == pytest.approx(points[nearest.argmin(1) == j].mean(0), abs=0.05)
        got = {r["customer_id"]: r["cluster"] for r in fit.assign(rows).collect()}
        assert [got[i] for i in range(len(points))] == nearest.argmin(1).tolist()
    assert min(f.cost for (k, _), f in fits.items() if k == 3) < 0.3 * min(f.cost for (k, _), f in fits.items() if k == 2)


def test_halving_keeps_the_best_by_validation_auc(spark):
    from basketry.operators import trials

    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 3))
    y = (x[:, 0] * x[:, 1] + 0.2 * rng.normal(size=900) > 0).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i]), ("train", "val", "test")[i % 3 if i % 6 else 0]) for i in range(900)]
    split = spark.createDataFrame(rows, "customer_id long, a double, b double, c double, churned int, split string")
    rungs = (trials.Rung(None, 2, 0.5), trials.Rung(3, 6, 1.0), trials.Rung(2, None, 1.0))
    table, model, fits = churn_model.search(split, ["a", "b", "c"], "churned", 6, max_iter=(10, 20), rungs=rungs)
    row, done = table.first(), [r.asDict() for r in fits.collect()]
    assert [sum(f["rung"] == k for f in done) for k in range(3)] == [6, 3, 2]
    for k in (0, 1):  # survivors are the best of the rung before
        here = sorted((f for f in done if f["rung"] == k), key=lambda f: (-f["val_auc"], f["config"]))
        assert {f["config"] for f in done if f["rung"] == k + 1} == {f["config"] for f in here[: rungs[k + 1].configs]}
    last = [f for f in done if f["rung"] == 2]
    assert row["val_auc"] == max(f["val_auc"] for f in last) > 0.85
    assert churn_model.validation_auc(model, split, "churned") == pytest.approx(row["val_auc"])
    assert all(f["rounds"] <= r for f in done for r in [(2, 6, 20)[f["rung"]]])
    share = trials.in_share("customer_id", 0.25, 1)
    assert split.filter(share & ~trials.in_share("customer_id", 0.5, 1)).count() == 0 < split.filter(share).count()


def test_feature_sets_are_compared_by_validation_rows(monkeypatch):
    tables = {"a": (0.9, 0.1), "b": (0.8, 0.99)}

    class Row(dict):
        def first(self):
            return self

        def select(self, *_):
            return self

        def unionByName(self, _):
            return self

    def search(split, features, label):
        val, test = tables[features[0]]
        return Row(val_auc=val, auc_roc=test), f"model {features[0]}", None

    monkeypatch.setattr(churn_model, "search", search)
    monkeypatch.setattr(churn_model.F, "lit", lambda v: type("C", (), {"alias": lambda self, n: v})())
    assert churn_model.compare_feature_sets(None, {"first": ["a"], "second": ["b"]}, "y")[1:] == ("first", "model a")


def test_a_rare_far_cluster_gets_a_center(spark):
    """20 rows among a million are met by the seeding passes over all rows."""
    far = "id % 50000 = 7"
    rows = spark.range(1_000_000).selectExpr(
        f"if({far}, 400.0, 0.0) + (id * 7919 % 1000) / 1000.0 AS recency_days_scaled",
        "(id * 104729 % 1000) / 1000.0 AS frequency_scaled", "(id * 1299709 % 1000) / 1000.0 AS monetary_scaled",
    )
    fit = segmentation.fit_starts(rows, [(4, 1)])[4, 1]
    assert sum(c[0] > 390 for c in fit.centers) == 1


@pytest.mark.parametrize("names", [("a", "b"), ("b", "a")])
def test_target_is_decided_by_all_series(spark, tmp_path, names):
    """One series on either side of the target: not met, whatever the series are called."""
    from basketry.operators import runs

    best = spark.createDataFrame([(names[0], 8.0), (names[1], 40.0)], "series_id string, best_ensemble_mape double")
    worst = best.agg(F.max("best_ensemble_mape").alias("best_ensemble_mape"), F.count("*").alias("n_series"))
    records = runs.run_records(worst, jobs.EXPERIMENTS["forecast"], F.lit(jobs.ENSEMBLE_RUN), ["n_series"], ["best_ensemble_mape"])
    verdict = jobs._constraints(records).first()["constraints"]["forecast"]
    assert verdict["mape"] == 40.0 and verdict["mape_meets_target"] is False


def test_fits_are_those_of_the_library_and_share_their_passes(spark):
    from pyspark.ml.clustering import KMeans

    rng = np.random.default_rng(8)
    points = rng.lognormal(0, 0.7, (4000, 3))
    rows = spark.createDataFrame([tuple(map(float, p)) for p in points], list(segmentation.SCALED)).coalesce(1).cache()
    rows.count()
    wanted = [(k, s) for k in (2, 5, 9) for s in range(4)]
    jobs_before = spark._jsc.sc().dagScheduler().nextJobId()
    fits = segmentation.fit_starts(rows, wanted)
    ran = spark._jsc.sc().dagScheduler().nextJobId() - jobs_before
    # Seven jobs of a start at most, one of an iteration of all fits, and a few around them.
    assert ran <= 8 * len(wanted) + max(f.iterations for f in fits.values()) + 6
    vectors = segmentation.as_vectors(rows).repartition(1).cache()
    for (k, seed), fit in fits.items():
        model = KMeans(k=k, seed=seed, maxIter=segmentation.MAX_ITER, tol=segmentation.TOLERANCE**0.5, initSteps=segmentation.SEED_PASSES).fit(vectors)
        assert fit.iterations == model.summary.numIter and fit.cost == pytest.approx(model.summary.trainingCost)
        assert fit.centers == pytest.approx(np.array(model.clusterCenters()), abs=1e-9)


def test_members_of_clusters_are_not_shuffled_to_their_centroids(spark):
    rows = [(i, i % 3, *np.random.default_rng(i).normal(i % 3, 0.1, 3).tolist()) for i in range(60)]
    labelled = spark.createDataFrame(rows, ["customer_id", "cluster", *segmentation.SCALED]).withColumn("k", F.lit(3))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = segmentation.davies_bouldin(labelled, segmentation.SCALED, by=("k",))
        text = index._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "SortAggregate" not in text
        assert 0 < index.first()["davies_bouldin"] < 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
