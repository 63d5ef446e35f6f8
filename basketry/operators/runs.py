"""Run records: appended parameters and metrics, latest and best runs, target checks."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.sources.schemas import RUNS
from basketry.sources.sinks import write_batch

# Metric targets.
AUC_TARGET = 0.88
PRECISION_TARGET = 0.75
MAPE_TARGET = 12.0


def append_runs(runs: DataFrame, path: str, batch: str | None = None) -> str:
    """Append run records to the runs table; a call repeated with the same ``batch`` leaves one copy."""
    return write_batch(runs.select(*RUNS.fieldNames()), path, batch or uuid.uuid4().hex)


def run_records(
    results: DataFrame,
    experiment: str,
    run_name: Column,
    params: list[str],
    metrics: list[str],
    started: datetime | None = None,
    parent_run_id: str | None = None,
) -> DataFrame:
    """Turn rows of results into run records, one per row, each with an id of its own.

    ``started`` is when the work began (UTC); the records end now.
    """

    def entries(names: list[str], to: str) -> Column:
        pairs = F.array(*[F.struct(F.lit(n).alias("k"), F.col(n).cast(to).alias("v")) for n in names])
        return F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))

    now = datetime.now(UTC).replace(tzinfo=None)
    call = uuid.uuid4().hex  # tells this call from every other one
    named = F.concat_ws("|", F.lit(call), F.lit(experiment), run_name, *[F.col(p).cast("string") for p in params])
    return results.select(
        F.sha2(named, 256)
        .substr(1, 32)
        .alias("run_id"),
        F.lit(parent_run_id).cast("string").alias("parent_run_id"),
        F.lit(experiment).alias("experiment"),
        run_name.alias("run_name"),
        F.lit(started or now).cast("timestamp_ntz").alias("start_time"),
        F.lit(now).cast("timestamp_ntz").alias("end_time"),
        entries(params, "string").alias("params"),
        entries(metrics, "double").alias("metrics"),
    )


def nested_records(
    results: DataFrame,
    experiment: str,
    name: str,
    run_name: Column,
    params: list[str],
    metrics: list[str],
    best: str,
    smallest: bool,
    started: datetime | None = None,
) -> DataFrame:
    """Records of a sweep: one per configuration, below one with the best value of metric ``best``."""
    value = (F.min if smallest else F.max)(best).alias(f"best_{best}")
    summary = results.agg(value, F.count("*").alias("n_configs"))
    parent = run_records(summary, experiment, F.lit(name), ["n_configs"], [f"best_{best}"], started)
    parent_id = uuid.uuid4().hex
    children = run_records(results, experiment, run_name, params, metrics, started, parent_id)
    return parent.withColumn("run_id", F.lit(parent_id)).unionByName(children)


def latest_runs(runs: DataFrame, metrics: list[str]) -> DataFrame:
    """Chosen metrics of the newest run per experiment and run name."""
    newest = runs.groupBy("experiment", "run_name").agg(
        F.max_by(F.struct("run_id", "metrics"), F.struct("start_time", "run_id")).alias("r"),
        F.max("start_time").alias("start_time"),
    )
    return newest.select(
        "experiment",
        "run_name",
        "r.run_id",
        "start_time",
        *[F.try_element_at("r.metrics", F.lit(m)).alias(m) for m in metrics],
    )


def best_run(runs: DataFrame, metric: str, smallest: bool = True) -> DataFrame:
    """Run with the best value of a metric per experiment; run_id breaks ties."""
    value = F.try_element_at("metrics", F.lit(metric))
    found = runs.withColumn("value", value).filter(F.col("value").isNotNull())
    order = F.struct("value" if smallest else (-F.col("value")).alias("v"), "run_id")
    return found.groupBy("experiment").agg(
        F.min_by(F.struct("run_id", "run_name", "value"), order).alias("b")
    ).select("experiment", "b.run_id", "b.run_name", "b.value")


def constraints(latest: DataFrame, checks: list[tuple[str, str, str, str, str, float]]) -> DataFrame:
    """Latest metrics against targets; NULL metrics give a NULL verdict.

    A check is (model, experiment, run_name, metric, ">=" or "<=", target).
    """
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(model).alias("model"), F.lit(metric).alias("metric"), F.col(metric).alias("value"),
                    F.lit(float(target)).alias("target"),
                    (F.col(metric) >= target if op == ">=" else F.col(metric) <= target).alias("meets_target"),
                    ((F.col("experiment") == experiment) & (F.col("run_name") == run)).alias("_mine"),
                )
                for model, experiment, run, metric, op, target in checks
            ]
        )
    )
    return latest.select(rows.alias("c")).filter("c._mine").select(
        "c.model", "c.metric", "c.value", "c.target", "c.meets_target"
    )


def model_evolution(runs: DataFrame, stages: list[tuple[str, str, str, str]]) -> DataFrame:
    """Last value of each stage's metric; a stage is (stage, experiment, run_name, metric)."""
    out = None
    for stage, experiment, run_name, metric in stages:
        value = F.try_element_at("metrics", F.lit(metric))
        rows = runs.filter((F.col("experiment") == experiment) & (F.col("run_name") == run_name)).select(
            F.lit(stage).alias("stage"), F.lit(metric).alias("metric"), "start_time", "run_id", value.alias("value")
        )
        out = rows if out is None else out.unionByName(rows)
    return (
        out.filter(F.col("value").isNotNull())
        .groupBy("stage", "metric")
        .agg(F.max_by("value", F.struct("start_time", "run_id")).alias("value"))
    )
