"""Churn classifier: exact stratified split, boosted trees, search, attribution and scoring."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.evaluation import auc, classification_metrics, score_counts
from basketry.operators.scale import running_totals
from basketry.operators.trials import RUNGS, Rung, TreeConfig, classifier, halving_search
from basketry.sources.readers import path_exists


# The manual sweep.
TREE_SWEEP = (
    TreeConfig(4, 0.1, 300),
    TreeConfig(3, 0.05, 500),
    TreeConfig(6, 0.05, 500),
    TreeConfig(8, 0.1, 300),
)


def stratified_split(
    df: DataFrame, id_col: str, label: str, fraction: float, seed: int = 42, flag: str = "is_test"
) -> DataFrame:
    """Exact split per label: the ``ceil(fraction * n)`` ids with the smallest hash are flagged.

    The hash order is cut into ranges, so a label is never sorted in one task.
    """
    hashed = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))
    placed = running_totals(
        df,
        {"hash": hashed, "id": F.col(id_col)},
        {"rank": F.lit(1).cast("long")},
        group=[label],
    )
    return placed.withColumn(
        flag, F.col("rank_running") <= F.ceil(F.col("rank_all") * fraction)
    ).select(*df.columns, flag)


def three_way_split(
    df: DataFrame, id_col: str, label: str, test: float = 0.2, val: float = 0.15, seed: int = 42
) -> DataFrame:
    """Adds ``split``: a test share of all rows, then a validation share of the rest, per label."""
    outer = stratified_split(df, id_col, label, test, seed)
    held = outer.filter("is_test").withColumn("split", F.lit("test")).drop("is_test")
    inner = stratified_split(outer.filter("NOT is_test").drop("is_test"), id_col, label, val, seed + 1, "_val")
    rest = inner.withColumn("split", F.when(F.col("_val"), "val").otherwise("train")).drop("_val")
    return held.unionByName(rest)


def fit_trees(
    split: DataFrame, features: list[str], label: str, config: TreeConfig, seed: int = 42
) -> PipelineModel:
    """Boosted trees on the train rows; the validation rows stop the iterations."""
    fitting = split.filter("split <> 'test'").withColumn("is_val", F.col("split") == "val")
    trees = classifier(config, label, seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), trees]).fit(fitting)


def feature_names(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def score_customers(model: PipelineModel, customers: DataFrame) -> DataFrame:
    """Churn probability per customer, highest first; missing feature columns are an error."""
    names = feature_names(model)
    missing = sorted(set(names) - set(customers.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    scored = model.transform(customers).withColumn(
        "churn_probability", vector_to_array("probability")[1]
    )
    return scored.select(*customers.columns, "churn_probability").orderBy(
        F.desc("churn_probability"), "customer_id"
    )


def _scored(model: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    return model.transform(rows).select(
        "customer_id", vector_to_array("probability")[1].alias("score"), F.col(label).alias("label")
    )


def evaluate(model: PipelineModel, split: DataFrame, label: str, part: str = "test") -> DataFrame:
    """AUC, precision in the top 20 %, precision and recall at 0.5 on one part of the split."""
    return classification_metrics(_scored(model, split.filter(F.col("split") == part), label), "customer_id")


def sweep(
    split: DataFrame, features: list[str], label: str, configs: tuple[TreeConfig, ...] = TREE_SWEEP, parallelism: int = 4
) -> tuple[DataFrame, list[PipelineModel]]:
    """Test metrics per configuration with its validation AUC, and the fitted models.

    Independent fits share the cluster; ``split`` should be cached or checkpointed.
    """

    def run(config: TreeConfig) -> tuple[PipelineModel, tuple]:
        model = fit_trees(split, features, label, config)
        metrics = evaluate(model, split, label).first()
        return model, (*asdict(config).values(), validation_auc(model, split, label), *metrics)

    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(run, configs))
    names = [*asdict(configs[0]), "val_auc", "auc_roc", "precision_at_top20pct"]
    names += ["precision_at_threshold", "recall_at_threshold"]
    rows = [(i, *row) for i, (_, row) in enumerate(done)]
    return split.sparkSession.createDataFrame(rows, ["config", *names]), [m for m, _ in done]


def validation_auc(model: PipelineModel, split: DataFrame, label: str) -> float:
    scored = _scored(model, split.filter("split = 'val'"), label)
    return auc(score_counts(scored)).first()["auc_roc"]


def draw_configs(n_trials: int, seed: int = 42, max_iter: tuple[int, int] = (100, 800)) -> tuple[TreeConfig, ...]:
    """Random draws from the search space (log-uniform learning rate)."""
    rng = random.Random(seed)
    return tuple(
        TreeConfig(
            max_depth=rng.randint(2, 10),
            learning_rate=0.01 * (0.3 / 0.01) ** rng.random(),
            n_estimators=rng.randint(*max_iter),
            subsample=rng.uniform(0.5, 1.0),
            colsample=rng.uniform(0.5, 1.0),
            min_child=rng.randint(1, 10),
            min_gain=rng.uniform(0.0, 0.05),
        )
        for _ in range(n_trials)
    )


def search(
    split: DataFrame,
    features: list[str],
    label: str,
    n_trials: int = 60,
    seed: int = 42,
    max_iter: tuple[int, int] = (100, 800),
    rungs: tuple[Rung, ...] = RUNGS,
) -> tuple[DataFrame, PipelineModel, DataFrame]:
    """Successive halving over random configurations: the winner by validation AUC with its test
    metrics as one row, its model, and one row per fit."""
    spark = split.sparkSession
    configs = draw_configs(n_trials, seed, max_iter)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    vectors = assembler.transform(split).select("customer_id", "split", label, "features")
    best, val_auc, trees, history = halving_search(vectors, label, configs, rungs, seed)
    model = PipelineModel([assembler, trees])
    row = (n_trials, *asdict(configs[best]).values(), trees.getNumTrees, val_auc, *evaluate(model, split, label).first())
    names = ["n_trials", *asdict(configs[best]), "rounds", "val_auc", "auc_roc", "precision_at_top20pct"]
    names += ["precision_at_threshold", "recall_at_threshold"]
    fits = spark.createDataFrame(history, "rung int, config int, rounds int, share double, val_auc double")
    drawn = spark.createDataFrame([(i, *asdict(c).values()) for i, c in enumerate(configs)], ["config", *asdict(configs[0])])
    return spark.createDataFrame([row], names), model, fits.join(F.broadcast(drawn), "config")


def compare_feature_sets(
    split: DataFrame, feature_sets: dict[str, list[str]], label: str, **search_args
) -> tuple[DataFrame, str, PipelineModel]:
    """The same search per feature set; the set with the higher validation AUC wins, the first on a tie."""
    with ThreadPoolExecutor(len(feature_sets)) as pool:
        done = dict(zip(feature_sets, pool.map(lambda f: search(split, f, label, **search_args), feature_sets.values()), strict=True))
    table = None
    for name, (row, _, _) in done.items():
        row = row.select(F.lit(name).alias("feature_set"), F.lit(len(feature_sets[name])).alias("n_features"), "*")
        table = row if table is None else table.unionByName(row)
    winner = max(done, key=lambda name: done[name][0].first()["val_auc"])
    return table, winner, done[winner][1]


# --- attribution ------------------------------------------------------------------------------


def shapley_values(
    model: PipelineModel,
    rows: DataFrame,
    background: DataFrame,
    id_col: str = "customer_id",
    permutations: int = 8,
    seed: int = 42,
) -> DataFrame:
    """Sampled Shapley contribution (log-odds) per row and feature: (id, feature, contribution).

    For every row and sampled feature order, features switch one by one from a background row to
    the row's own values. A prediction counts for the feature just switched on and against the
    one switched on next, so the sums need no ordering. Every (row, order) draws its background
    row by number from the whole background, so large backgrounds are used in full.
    """
    names = feature_names(model)
    d = len(names)
    values = F.array(*[F.col(n).cast("double") for n in names])
    numbered = running_totals(
        background.select(id_col, values.alias("_ref")), {"id": F.col(id_col)}, {"n": F.lit(1).cast("long")}
    ).select((F.col("n_running") - 1).alias("_at"), "_ref")
    size = background.agg(F.count("*")).scalar()
    index = F.sequence(F.lit(0), F.lit(d - 1))
    hashed = F.transform(index, lambda j: F.struct(F.xxhash64(F.col("_id"), F.col("_p"), F.lit(seed), j).alias("h"), j.alias("j")))
    orders = (
        rows.select(F.col(id_col).alias("_id"), values.alias("_row"))
        .withColumn("_p", F.explode(F.sequence(F.lit(1), F.lit(permutations))))
        .withColumn("_order", F.transform(F.array_sort(hashed), lambda s: s["j"]))
        .withColumn("_at", F.pmod(F.xxhash64("_id", "_p", F.lit(seed)), size))
        .join(numbered, "_at")
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    )
    mixed = F.transform(
        index,
        lambda j: F.when(F.array_position("_order", j) <= F.col("_step"), F.get("_row", j)).otherwise(
            F.get("_ref", j)
        ),
    )
    margins = (
        model.stages[-1]
        .transform(orders.withColumn("features", array_to_vector(mixed)).drop("_row", "_at", "_ref"))
        .withColumn("_margin", vector_to_array("rawPrediction")[1] * 2)
    )
    parts = F.filter(
        F.array(
            F.struct(F.get("_order", F.col("_step") - 1).alias("j"), F.col("_margin").alias("v")),
            F.struct(F.get("_order", F.col("_step")).alias("j"), (-F.col("_margin")).alias("v")),
        ),
        lambda p: p["j"].isNotNull(),
    )
    return (
        margins.select("_id", F.explode(parts).alias("p"))
        .groupBy("_id", "p.j")
        .agg((F.sum("p.v") / permutations).alias("contribution"))
        .select(
            F.col("_id").alias(id_col),
            F.get(F.array(*[F.lit(n) for n in names]), F.col("j")).alias("feature"),
            "contribution",
        )
    )


def feature_importance(contributions: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return (
        contributions.groupBy("feature")
        .agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
        .orderBy(F.desc("mean_abs_contribution"), "feature")
    )


# --- saved models -----------------------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str | None, runs: DataFrame, run_name: str) -> PipelineModel:
    """The model saved at ``path``, else the one logged by the newest run of that name."""
    if path and path_exists(spark, path):
        return PipelineModel.load(path)
    logged = (
        runs.filter((F.col("run_name") == run_name) & F.try_element_at("params", F.lit("model_path")).isNotNull())
        .agg(F.max_by(F.col("params")["model_path"], F.struct("start_time", "run_id")).alias("path"))
        .first()["path"]
    )
    if logged is None:
        raise ValueError(f"no saved model and no run named {run_name!r} with a logged model")
    return PipelineModel.load(logged)
