"""Whole-table orderings that never meet in one task.

A window without ``partitionBy`` sends the whole table to one task. The helpers here split the
order into value ranges instead: ranges are cut from a hash sample of the ordering key,
each range is summed on its own, and the few range totals give every range its offset. The
ordering key must be unique, so a hot value is cut through its tie-breaker as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 16
HASH_SPACE = 2**31


def _range_count(df: DataFrame) -> int:
    """As many ranges as the session has shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hash_sample(df: DataFrame, key: Column, wanted: int, carried: list[str] | None = None) -> DataFrame:
    """About ``wanted`` rows of (k, carried...), chosen by a threshold on the hash of ``key``.

    Every task filters its own rows, so only the sample itself travels. The count reads the same
    columns as the sample does, so that both share one exchange of ``df`` with later sums.
    """
    carried = carried or []
    rows = df.select(key.alias("k"), *carried)
    size = rows.agg(
        F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64("k", *carried)).alias("read")).alias("s")
    ).scalar()
    share = F.lit(float(wanted)) / F.greatest(size["n"], F.lit(1))
    return rows.filter(F.pmod(F.xxhash64("k"), F.lit(HASH_SPACE)) < F.lit(float(HASH_SPACE)) * share)


def _with_range(df: DataFrame, key: Column, carried: list[str]) -> DataFrame:
    """Add ``_range``, the index of the value range of a row's key; a pure function of the data.

    The cut points are looked up by bisection, one projection per step. The sample carries the
    summed columns along, so that it reads the same exchange as the sums do.
    """
    ranges = _range_count(df)
    sample = hash_sample(df, key, ranges * SAMPLE_PER_RANGE, carried)
    ordered = F.array_sort(F.collect_list(F.struct("k", *carried)))
    every = F.transform(
        F.filter(ordered, lambda _, i: F.pmod(i, F.lit(SAMPLE_PER_RANGE)) == 0), lambda row: row["k"]
    )
    placed = df.withColumns({"_cuts": sample.agg(every.alias("c")).scalar(), "_range": F.lit(0)})
    # The sample size varies around its mean; twice the mean is out of reach.
    for step in [2**i for i in reversed(range((2 * ranges + SAMPLE_PER_RANGE).bit_length()))]:
        beyond = F.get("_cuts", F.col("_range") + (step - 1)) <= key
        placed = placed.withColumn(
            "_range", F.when(beyond, F.col("_range") + step).otherwise(F.col("_range"))
        )
    return placed.drop("_cuts")


def running_totals(
    df: DataFrame,
    order: dict[str, Column],
    sums: dict[str, Column],
    group: list[str] | None = None,
    following: dict[str, str] | None = None,
) -> DataFrame:
    """Append running and overall sums along a unique order, per ``group`` or over all rows.

    ``order`` names the ordering expressions (ascending, unique together with ``group``),
    ``sums`` the values to add up. Adds ``<name>_running`` (inclusive) and ``<name>_all`` for
    every sum, and for every ``following`` entry (new column -> column of ``df``) the value of
    the next row in the order.
    """
    group, following = group or [], following or {}
    keyed = df.withColumns({f"_o_{n}": c for n, c in order.items()} | {f"_s_{n}": c for n, c in sums.items()})
    order_cols = [f"_o_{n}" for n in order]
    key = F.struct(*group, *order_cols)
    ranged = _with_range(keyed, key, [f"_s_{n}" for n in sums])

    first = F.struct(*order_cols)
    totals = ranged.groupBy(*group, "_range").agg(
        *[F.sum(f"_s_{n}").alias(f"_t_{n}") for n in sums],
        *[F.min_by(source, first).alias(f"_f_{new}") for new, source in following.items()],
    )
    # One row per range and group: about the number of shuffle partitions plus that of groups.
    ahead = W.partitionBy(*group).orderBy("_range")
    before = ahead.rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        "_range",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums],
        *[F.sum(f"_t_{n}").over(W.partitionBy(*group)).alias(f"{n}_all") for n in sums],
        *[F.lead(f"_f_{new}").over(ahead).alias(f"_n_{new}") for new in following],
    )
    if not group:
        offsets = F.broadcast(offsets)
    inside = W.partitionBy(*group, "_range").orderBy(*order_cols)
    so_far = inside.rowsBetween(W.unboundedPreceding, 0)
    return (
        ranged.join(offsets, [*group, "_range"], "left")
        .withColumns(
            {f"{n}_running": F.col(f"_b_{n}") + F.sum(f"_s_{n}").over(so_far) for n in sums}
            | {
                new: F.coalesce(F.lead(source).over(inside), F.col(f"_n_{new}"))
                for new, source in following.items()
            }
        )
        .select(
            *df.columns,
            *[f"{n}_running" for n in sums],
            *[f"{n}_all" for n in sums],
            *following,
        )
    )


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Linear-interpolated quantiles of several numeric columns: (column, probability, value).

    Values are counted first, so copies of a hot value travel as one row, and the positions are
    looked up in the running counts of the distinct values.
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value"
    )
    counts = (
        long.filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = running_totals(
        counts, {"value": F.col("value")}, {"n": F.col("n")}, group=["column"], following={"next": "value"}
    )
    position = F.col("probability") * (F.col("n_all") - 1)
    low = F.floor(position)
    # A value covers the 0-based positions [n_running - n, n_running).
    covers = (low >= F.col("n_running") - F.col("n")) & (low < F.col("n_running"))
    upper = F.when(low + 1 < F.col("n_running"), F.col("value")).otherwise(
        F.coalesce("next", "value")
    )
    return (
        placed.withColumn("probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .filter(covers)
        .select(
            "column",
            "probability",
            (F.col("value") + (upper - F.col("value")) * (position - low)).alias("value"),
        )
    )


def attach_by_key(
    rows: DataFrame, dim: DataFrame, key: str, weight: str, hot_share: float = 0.001
) -> DataFrame:
    """Inner join of ``rows`` with one ``dim`` row per key, safe for hot keys.

    ``weight`` is the number of rows a key has. At most ``1 / hot_share`` keys can hold more than
    ``hot_share`` of all rows, so those keys are broadcast and their rows stay where they are;
    the remaining keys are joined by shuffle.
    """
    limit = dim.agg(F.sum(weight) * hot_share).scalar()
    is_hot = F.col(weight) > limit
    hot = F.broadcast(dim.filter(is_hot).drop(weight))
    cold = dim.filter(~is_hot).drop(weight)
    return rows.join(hot, key).unionByName(
        rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    )
