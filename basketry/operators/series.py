"""Per-series features: splits, scaling, lag windows, differences, decomposition, holidays."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.functions.expressions import day_of_week, ratio
from basketry.session import cut

PERIOD = 7
ROBUST_ROUNDS = 4  # re-weighting rounds of the robust decomposition


def by_series():
    return W.partitionBy("series_id")


def in_order():
    return by_series().orderBy("ds")


def train_test_split(series: DataFrame, test_days: int = 56, val_days: int = 0) -> DataFrame:
    """Tag the tail of every series as test, the days before it as val, the rest as train."""
    from_end = F.row_number().over(by_series().orderBy(F.desc("ds")))
    split = (
        F.when(from_end <= test_days, "test").when(from_end <= test_days + val_days, "val").otherwise("train")
    )
    return series.withColumn("split", split)


def first_difference(series: DataFrame) -> DataFrame:
    """y minus the previous y; the first row of a series drops out."""
    change = F.col("y") - F.lag("y").over(in_order())
    return series.withColumn("y", change).filter(F.col("y").isNotNull())


def uk_holidays(dates: DataFrame, country: str = "UK") -> DataFrame:
    """Holiday dimension (country, date, name) for the years of ``dates.ds``.

    Fixed days, first or last Mondays and the Easter days, by calendar rule.
    """
    years = dates.agg(F.year(F.min("ds")).alias("a"), F.year(F.max("ds")).alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("y")
    )
    y = F.col("y")

    def monday(month: int, last: bool = False) -> Column:
        if last:
            end = F.last_day(F.make_date(y, F.lit(month), F.lit(1)))
            return F.date_sub(end, F.weekday(end))
        return F.next_day(F.date_sub(F.make_date(y, F.lit(month), F.lit(1)), 1), "Mon")

    easter = easter_sunday(y)
    named = {
        "New Year's Day": F.make_date(y, F.lit(1), F.lit(1)),
        "Good Friday": F.date_sub(easter, 2),
        "Easter Monday": F.date_add(easter, 1),
        "May Day": monday(5),
        "Spring Bank Holiday": monday(5, last=True),
        "Late Summer Bank Holiday": monday(8, last=True),
        "Christmas Day": F.make_date(y, F.lit(12), F.lit(25)),
        "Boxing Day": F.make_date(y, F.lit(12), F.lit(26)),
    }
    days = F.array(*[F.struct(d.alias("date"), F.lit(n).alias("name")) for n, d in named.items()])
    return years.select(F.explode(days).alias("h")).select(F.lit(country).alias("country"), "h.date", "h.name")


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by Gauss's rule for 1900-2099."""
    a, b, c = F.pmod(year, F.lit(19)), F.pmod(year, F.lit(4)), F.pmod(year, F.lit(7))
    d = F.pmod(a * 19 + 24, F.lit(30))
    e = F.pmod(b * 2 + c * 4 + d * 6 + 5, F.lit(7))
    days = d + e
    # Gauss's two exceptions move the date one week earlier.
    late = ((d == 29) & (e == 6)) | ((d == 28) & (e == 6) & (a > 10))
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), (days - F.when(late, 7).otherwise(0)).cast("int"))


def series_features(series: DataFrame, holidays: DataFrame) -> DataFrame:
    """Cyclic day of week, Saturday flag and holiday flag.

    ``holidays`` is a calendar dimension: at most a few days per year, so it is broadcast.
    """
    dow = day_of_week(F.col("ds"))
    angle = dow * (2 * math.pi / 7)
    marked = F.broadcast(
        holidays.select(F.col("date").alias("ds"), F.lit(1.0).alias("is_uk_holiday")).distinct()
    )
    return (
        series.join(marked, "ds", "left")
        .withColumns(
            {
                "dow_sin": F.sin(angle),
                "dow_cos": F.cos(angle),
                "is_saturday": (dow == 5).cast("double"),
                "is_uk_holiday": F.coalesce("is_uk_holiday", F.lit(0.0)),
            }
        )
        .select(*series.columns, "dow_sin", "dow_cos", "is_saturday", "is_uk_holiday")
    )


def scale_series(split: DataFrame) -> DataFrame:
    """Standardize y by mean and population deviation of each series' train rows (0 -> 1).

    Adds ``y_mean``, ``y_std`` and ``y_scaled``; the window shares the series' partitioning.
    """
    train_y = F.when(F.col("split") == "train", F.col("y"))
    std = F.stddev_pop(train_y).over(by_series())
    return split.withColumns(
        {"y_mean": F.avg(train_y).over(by_series()), "y_std": F.when(std == 0, 1.0).otherwise(std)}
    ).withColumn("y_scaled", (F.col("y") - F.col("y_mean")) / F.col("y_std"))


def unscale(scaled: Column, floor_at_zero: bool = True) -> Column:
    """Back to demand units, clipped at 0 because demand cannot be negative."""
    value = scaled * F.col("y_std") + F.col("y_mean")
    return F.greatest(value, F.lit(0.0)) if floor_at_zero else value


def lag_windows(
    scaled: DataFrame, lookback: int, features: tuple[str, ...] = ("y_scaled",)
) -> DataFrame:
    """Previous ``lookback`` rows of the features as ``window``; rows without full context drop."""
    frame = in_order().rowsBetween(-lookback, -1)
    window = F.collect_list(F.array(*[F.col(c) for c in features])).over(frame)
    return scaled.withColumn("window", window).filter(F.size("window") == lookback)


def naive_seasonal(split: DataFrame, season_length: int = PERIOD, recursive: bool = False) -> DataFrame:
    """Seasonal-naive forecast of the test rows: the value ``season_length`` rows earlier.

    ``recursive`` only uses train values: each test row looks back a whole number of seasons.
    """
    if not recursive:
        naive = F.lag("y", season_length).over(in_order())
        return split.withColumn("naive", naive).filter(F.col("split") == "test")
    is_test = F.col("split") == "test"
    back = F.row_number().over(by_series().orderBy(F.desc("ds")))
    season = split.filter(~is_test).withColumn("_back", back).filter(F.col("_back") <= season_length)
    season = season.select("series_id", "_back", F.col("y").alias("naive"))
    wanted = season_length - F.pmod(F.row_number().over(in_order()) - 1, F.lit(season_length))
    tested = split.filter(is_test).withColumn("_back", wanted)
    return tested.join(season, ["series_id", "_back"], "left").select(*split.columns, "naive")


def decompose(series: DataFrame, period: int = PERIOD) -> DataFrame:
    """Additive decomposition: centred moving mean, centred seasonal means, remainder.

    The season of a row is its position in the week, as the series has one row per day. Trend and
    remainder are NULL where the centred window is not full.
    """
    half = period // 2
    frame = in_order().rowsBetween(-half, half)
    trend = F.when(F.count(F.lit(1)).over(frame) == period, F.avg("y").over(frame))
    season = F.pmod(F.datediff("ds", F.lit("1970-01-05").cast("date")), F.lit(period))
    detrended = series.withColumns({"observed": F.col("y"), "trend": trend, "_season": season}).withColumn(
        "_detrended", F.col("y") - F.col("trend")
    )
    means = detrended.groupBy("series_id", "_season").agg(F.avg("_detrended").alias("_mean"))
    centred = means.withColumn("seasonal", F.col("_mean") - F.avg("_mean").over(by_series())).drop("_mean")
    return (
        detrended.join(centred, ["series_id", "_season"])
        .withColumn("resid", F.col("_detrended") - F.col("seasonal"))
        .select("series_id", "ds", "observed", "trend", "seasonal", "resid")
    )


def decompose_robust(series: DataFrame, period: int = PERIOD, rounds: int = ROBUST_ROUNDS) -> DataFrame:
    """Additive decomposition in which outlying days lose their weight, with the weights it ends at.

    After a pass with seasonal medians, each round weighs a day by the bisquare of its remainder over six times the median
    absolute remainder of its series, and takes trend and seasonal means as weighted means; the trend
    is then taken of the seasonally adjusted values, so that a day left out does not tilt its week.
    """
    half = period // 2
    frame = in_order().rowsBetween(-half, half)
    season = F.pmod(F.datediff("ds", F.lit("1970-01-05").cast("date")), F.lit(period))
    state = series.select("series_id", "ds", F.col("y").alias("observed"), season.alias("_season"), F.lit(0.0).alias("seasonal"), F.lit(1.0).alias("weight"))
    for number in range(rounds + 1):
        full = F.count(F.lit(1)).over(frame) == period
        adjusted = F.col("observed") - F.col("seasonal")
        trend = F.when(full, ratio(F.sum(F.col("weight") * adjusted).over(frame), F.sum("weight").over(frame)))
        detrended = state.withColumn("trend", trend).withColumn("_left", F.col("observed") - F.col("trend"))
        weight = F.when(F.col("_left").isNotNull(), F.col("weight")).otherwise(0.0)
        weighted = ratio(F.sum(weight * F.coalesce("_left", F.lit(0.0))), F.sum(weight))
        means = detrended.groupBy("series_id", "_season").agg((weighted if number else F.median("_left")).alias("_mean"))
        centred = means.withColumn("seasonal", F.coalesce(F.col("_mean") - F.avg("_mean").over(by_series()), F.lit(0.0))).drop("_mean")
        placed = detrended.drop("seasonal").join(centred, ["series_id", "_season"])
        state = placed.withColumn("resid", F.col("_left") - F.col("seasonal")).drop("_left")
        if number < rounds:
            middle = state.groupBy("series_id").agg(F.median(F.abs("resid")).alias("_mad"))
            share = F.coalesce(ratio(F.abs("resid"), 6 * F.col("_mad")), F.lit(0.0))
            judged = F.when(share < 1, F.pow(1 - share * share, 2)).otherwise(0.0)
            # Among days without weight there is no trend to judge by.
            bisquare = F.when(F.col("resid").isNull(), F.col("weight")).otherwise(judged)
            state = cut(state.join(middle, "series_id").withColumn("weight", bisquare).drop("_mad", "trend", "resid"))
    return state.select("series_id", "ds", "observed", "trend", "seasonal", "resid", "weight")


def seasonal_by_weekday(decomposed: DataFrame) -> DataFrame:
    return decomposed.groupBy("series_id", day_of_week(F.col("ds")).alias("dow")).agg(
        F.avg("seasonal").alias("mean_seasonal")
    )


def stationarity_verdict(adf_stationary: Column, kpss_stationary: Column) -> Column:
    """Combined reading of two tests with opposite null hypotheses."""
    return (
        F.when(adf_stationary & kpss_stationary, "stationary")
        .when(~adf_stationary & ~kpss_stationary, "non_stationary")
        .when(adf_stationary, "conflicting_trend_stationary")
        .otherwise("conflicting_difference_stationary")
    )
