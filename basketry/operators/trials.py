"""Hyper-parameter search by successive halving over MLlib boosted trees.

All configurations are fitted for a few rounds on a share of the train rows; the best of them by
validation AUC go on to a rung with more rounds and more rows, and the last rung is fitted in full. A
configuration that is left behind is not fitted again. Every rung scores the whole validation part under
all of its models in one pass and ranks them with one aggregate; nothing but one row per configuration
reaches the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.evaluation import auc, score_counts
from basketry.operators.scale import HASH_SPACE

PARALLEL = 8  # fits side by side
TASK_ROWS = 50_000  # rows of one task in a fit, about


@dataclass(frozen=True)
class TreeConfig:
    max_depth: int = 4
    learning_rate: float = 0.1
    n_estimators: int = 300
    subsample: float = 0.8
    colsample: float = 0.8
    min_child: int = 1
    min_gain: float = 0.0


@dataclass(frozen=True)
class Rung:
    """One round of the search: at most so many configurations, boosting rounds (None: all) and a share of the train rows."""

    configs: int | None
    rounds: int | None
    share: float


RUNGS = (Rung(None, 2, 1 / 3), Rung(15, 6, 1.0), Rung(5, 18, 1.0), Rung(2, None, 1.0))


def classifier(config: TreeConfig, label: str, seed: int) -> GBTClassifier:
    """Boosted trees whose iterations end when the rows flagged ``is_val`` stop improving."""
    return GBTClassifier(
        featuresCol="features", labelCol=label, validationIndicatorCol="is_val", maxDepth=config.max_depth,
        stepSize=config.learning_rate, maxIter=config.n_estimators, subsamplingRate=config.subsample,
        featureSubsetStrategy=str(config.colsample), minInstancesPerNode=config.min_child,
        minInfoGain=config.min_gain, seed=seed,
    )


def in_share(id_col: str, share: float, seed: int):
    """Rows of a share that holds the rows of every smaller one."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(HASH_SPACE)) < F.lit(float(HASH_SPACE) * share)


def validation_aucs(models: dict[int, GBTClassificationModel], rows: DataFrame, label: str) -> dict[int, float]:
    """AUC of every model on the same rows; 0 where they hold one class only."""
    scored = rows
    for number, model in models.items():
        bare = model.copy({model.rawPredictionCol: "", model.predictionCol: "", model.probabilityCol: f"_p{number}"})
        scored = bare.transform(scored)
    each = [F.struct(F.lit(number).alias("trial"), vector_to_array(f"_p{number}")[1].alias("score")) for number in models]
    long = scored.select(F.col(label).alias("label"), F.explode(F.array(*each)).alias("s")).select("label", "s.*")
    found = auc(score_counts(long, by=["trial"]), by=["trial"]).collect()
    return dict.fromkeys(models, 0.0) | {r["trial"]: r["auc_roc"] for r in found if r["auc_roc"] is not None}


def halving_search(
    vectors: DataFrame, label: str, configs: tuple[TreeConfig, ...], rungs: tuple[Rung, ...] = RUNGS,
    seed: int = 42, id_col: str = "customer_id", parallelism: int = PARALLEL,
) -> tuple[int, float, GBTClassificationModel, list[tuple[int, int, int, float, float]]]:
    """Winner, its validation AUC and model, and (rung, config, rounds, share, val_auc) of every fit.

    ``vectors`` has id, features, label and ``split``. Ties go to the first configuration.
    """
    fitting = vectors.filter("split <> 'test'").withColumn("is_val", F.col("split") == "val")
    tasks = max(1, -(-fitting.count() // TASK_ROWS))
    fitting = fitting.repartition(tasks, id_col).cache()
    held_back = fitting.filter("is_val").select(label, "features")
    left, history, models, scores = list(range(len(configs))), [], {}, {}
    for number, rung in enumerate(rungs):
        left = left[: rung.configs]
        rows = fitting if rung.share >= 1 else fitting.filter(F.col("is_val") | in_share(id_col, rung.share, seed)).cache()

        def fit(i: int, rung: Rung = rung, rows: DataFrame = rows) -> GBTClassificationModel:
            rounds = min(rung.rounds or configs[i].n_estimators, configs[i].n_estimators)
            return classifier(replace(configs[i], n_estimators=rounds), label, seed).fit(rows)

        with ThreadPoolExecutor(parallelism) as pool:
            models = dict(zip(left, pool.map(fit, left), strict=True))
        scores = validation_aucs(models, held_back, label)
        history += [(number, i, models[i].getNumTrees, rung.share, scores[i]) for i in sorted(left)]
        left = sorted(left, key=lambda i: (-scores[i], i))
        if rows is not fitting:
            rows.unpersist()
    fitting.unpersist()
    return left[0], scores[left[0]], models[left[0]], history
