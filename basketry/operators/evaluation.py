"""Forecast metrics, ensemble weights, ranking and classification metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.expressions import day_of_week, day_type, ratio
from basketry.operators.scale import running_totals

WEIGHT_STEPS = 20
TOP_FRACTION = 0.2


def forecast_metrics(actual: Column, predicted: Column) -> list[Column]:
    """MAE, RMSE, MAPE over non-zero actuals, and the counts, as one aggregation."""
    error = actual - predicted
    return [
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(error, actual))) * 100).alias("mape"),
        F.count_if(actual == 0).alias("n_excluded_zero_actual"),
        F.count("*").alias("n_total"),
    ]


def evaluate_forecasts(
    predictions: DataFrame, models: list[str], by: tuple[str, ...] = ("series_id",)
) -> DataFrame:
    """Metrics per model column, one row per (by, model)."""
    long = predictions.unpivot([*by, "ds", "actual"], models, "model", "predicted")
    return long.groupBy(*by, "model").agg(*forecast_metrics(F.col("actual"), F.col("predicted")))


def ape_by_weekday(
    predictions: DataFrame, models: list[str], by: tuple[str, ...] = ("series_id",)
) -> DataFrame:
    """Mean absolute percentage error per day of week and model, zero actuals left out."""
    long = predictions.filter(F.col("actual") != 0).unpivot(
        [*by, "ds", "actual"], models, "model", "predicted"
    )
    error = F.abs(F.col("actual") - F.col("predicted")) / F.col("actual") * 100
    return long.groupBy(*by, "model", day_of_week(F.col("ds")).alias("dow")).agg(F.avg(error).alias("ape"))


# --- ensemble -------------------------------------------------------------------------------


def blend(weight: Column, sequence: Column, additive: Column) -> Column:
    return weight * sequence + (1 - weight) * additive


def _weighted(validation: DataFrame, steps: int) -> DataFrame:
    """Every validation row under every weight of the grid."""
    grid = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: i / F.lit(float(steps)))
    return validation.withColumn("weight", F.explode(grid)).withColumn(
        "blended", blend(F.col("weight"), F.col("sequence_pred"), F.col("additive_pred"))
    )


def weight_sweep(validation: DataFrame, steps: int = WEIGHT_STEPS) -> DataFrame:
    """Validation MAPE per series and weight; weight 1 is the sequence model alone."""
    error = F.abs(F.try_divide(F.col("actual") - F.col("blended"), F.col("actual")))
    return (
        _weighted(validation, steps).groupBy("series_id", "weight").agg((F.avg(error) * 100).alias("mape"))
    )


def best_weight(sweep: DataFrame) -> DataFrame:
    """Weight with the lowest MAPE per series, the smallest one on a tie."""
    return sweep.groupBy("series_id").agg(
        F.min_by("weight", F.struct("mape", "weight")).alias("global_weight")
    )


def day_type_weights(validation: DataFrame, steps: int = WEIGHT_STEPS) -> DataFrame:
    """Best weight per series for weekdays, Saturdays (by MAE) and Sundays; 0.5 without data."""
    error = F.abs(F.col("actual") - F.col("blended"))
    kind = day_type(F.col("ds"))
    scores = (
        _weighted(validation, steps)
        .groupBy("series_id", kind.alias("day_type"), "weight")
        .agg(F.avg(error).alias("mae"), F.avg(F.try_divide(error, F.abs("actual"))).alias("mape"))
    )
    score = F.when(F.col("day_type") == "saturday", F.col("mae")).otherwise(F.col("mape"))
    best = scores.groupBy("series_id").agg(
        *[
            F.min_by(
                F.when(F.col("day_type") == name, F.col("weight")),
                F.when(F.col("day_type") == name, F.struct(score.alias("score"), "weight")),
            ).alias(name)
            for name in ("weekday", "saturday", "sunday")
        ]
    )
    return best.select(
        "series_id",
        *[F.coalesce(name, F.lit(0.5)).alias(f"weight_{name}") for name in ("weekday", "saturday", "sunday")],
    )


def apply_weights(predictions: DataFrame, global_weights: DataFrame, day_weights: DataFrame) -> DataFrame:
    """Both ensembles for every row; weights join by series."""
    kind = day_type(F.col("ds"))
    by_day = (
        F.when(kind == "saturday", F.col("weight_saturday"))
        .when(kind == "sunday", F.col("weight_sunday"))
        .otherwise(F.col("weight_weekday"))
    )
    sequence, additive = F.col("sequence_pred"), F.col("additive_pred")
    return (
        predictions.join(global_weights, "series_id")
        .join(day_weights, "series_id")
        .withColumns(
            {
                "ensemble_global": blend(F.col("global_weight"), sequence, additive),
                "ensemble_day_type": blend(by_day, sequence, additive),
            }
        )
        .select(*predictions.columns, "ensemble_global", "ensemble_day_type")
    )


# --- ranking and classification -------------------------------------------------------------


def ranked(scored: DataFrame, id_col: str, score: str, label: str) -> DataFrame:
    """Adds ``rank_running`` (1 = highest score), ``hits_running`` and ``rank_all``."""
    return running_totals(
        scored.select(id_col, score, label),
        {"score": -F.col(score), "id": F.col(id_col)},
        {"rank": F.lit(1).cast("long"), "hits": F.col(label).cast("long")},
    )


def precision_curve(
    scored: DataFrame, id_col: str, fractions: list[float], score: str = "score", label: str = "label"
) -> DataFrame:
    """Precision among the top fractions; a fraction covers max(1, ceil(n * f)) rows."""
    grid = F.array(*[F.lit(float(f)) for f in fractions])
    rows = ranked(scored, id_col, score, label)
    size = F.col("rank_all")
    ends_here = F.filter(
        grid, lambda f: F.greatest(F.lit(1), F.ceil(size * f)).cast("long") == F.col("rank_running")
    )
    return rows.withColumn("k_frac", F.explode(ends_here)).select(
        "k_frac",
        F.col("rank_running").alias("k"),
        ratio(F.col("hits_running"), F.col("rank_running")).alias("precision"),
    )


def precision_at_top_k(
    scored: DataFrame, id_col: str, k_frac: float = TOP_FRACTION, score: str = "score", label: str = "label"
) -> DataFrame:
    return precision_curve(scored, id_col, [k_frac], score, label)


def score_counts(scored: DataFrame, score: str = "score", label: str = "label", by: list[str] | None = None) -> DataFrame:
    """Positives and negatives per distinct score (and ``by``) with running counts from the highest score."""
    by = by or []
    counts = scored.groupBy(*by, F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(1 - F.col(label).cast("long")).alias("neg"),
    )
    return running_totals(
        counts, {"score": -F.col("threshold")}, {"pos": F.col("pos"), "neg": F.col("neg")}, group=by
    )


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """False and true positive rate per distinct score threshold."""
    return score_counts(scored, score, label).select(
        "threshold",
        ratio(F.col("neg_running"), F.col("neg_all")).alias("fpr"),
        ratio(F.col("pos_running"), F.col("pos_all")).alias("tpr"),
    )


def auc(counted: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Area under the ROC curve from ``score_counts`` (per ``by``): ranked pairs, ties count half."""
    wins = F.col("neg") * (F.col("pos_running") * 2 - F.col("pos"))
    return counted.groupBy(*(by or [])).agg(
        F.try_divide(
            F.sum(wins.cast("decimal(38,0)")).cast("double"),
            F.max("pos_all").cast("double") * F.max("neg_all") * 2,
        ).alias("auc_roc")
    )


def classification_metrics(
    scored: DataFrame, id_col: str, score: str = "score", label: str = "label", threshold: float = 0.5
) -> DataFrame:
    """AUC, precision in the top 20 %, precision and recall at the threshold, as one row."""
    flagged, churned = F.col(score) >= threshold, F.col(label) == 1
    at_threshold = scored.agg(
        F.coalesce(F.try_divide(F.count_if(flagged & churned), F.count_if(flagged)), F.lit(0.0)).alias(
            "precision_at_threshold"
        ),
        F.coalesce(F.try_divide(F.count_if(flagged & churned), F.count_if(churned)), F.lit(0.0)).alias(
            "recall_at_threshold"
        ),
    )
    top = precision_at_top_k(scored, id_col, TOP_FRACTION, score, label)
    return at_threshold.select(
        auc(score_counts(scored, score, label)).scalar().alias("auc_roc"),
        top.select("precision").scalar().alias("precision_at_top20pct"),
        "precision_at_threshold",
        "recall_at_threshold",
    )
