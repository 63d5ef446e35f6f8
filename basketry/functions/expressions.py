"""Column expressions shared by the operators."""

from __future__ import annotations

import math
from datetime import datetime
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(moment: str | datetime | Column) -> Column:
    """A TIMESTAMP_NTZ literal from text or datetime; columns pass through."""
    if isinstance(moment, Column):
        return moment
    return F.lit(str(moment)).cast("timestamp_ntz")


def days_later(moment: Column, days: int) -> Column:
    return moment + F.make_dt_interval(days=F.lit(days))


def elapsed_days(earlier: Column, later: Column) -> Column:
    """Whole days between two timestamps, floored like a time difference (not date boundaries)."""
    return F.timestamp_diff("DAY", earlier, later).cast("int")


def day_of_week(date: Column) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(date)


def day_type(date: Column) -> Column:
    return (
        F.when(F.weekday(date) == 5, "saturday").when(F.weekday(date) == 6, "sunday").otherwise("weekday")
    )


def ratio(top: Column, bottom: Column) -> Column:
    """Double division; NULL when the divisor is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def normal_quantile(probability: float) -> float:
    return NormalDist().inv_cdf(probability)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function: the odd power series times the density, all terms of one sign.

    Beyond eight deviations it is 0 or 1 to the last digit; NULL and NaN stay what they are.
    """
    near = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    first = F.struct(near.alias("term"), near.alias("sum"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] * near * near / (2 * i + 1)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(150)), first, add, lambda acc: acc["sum"])
    return F.when(F.isnan(z), z).otherwise(0.5 + series * F.exp(-near * near / 2) / math.sqrt(2 * math.pi))


def quantile_bin(rank: Column, n: Column, bins: int) -> Column:
    """1-based equal-frequency bin of a unique rank, edges by linear interpolation of ranks.

    Bin k ends at position ``1 + (n - 1) * k / bins``; integers keep the edges exact.
    """
    steps = F.nullif(n - 1, F.lit(0).cast("long"))
    above = (rank - 1) * bins + n - 2
    whole = (above - F.pmod(above, steps)) / steps
    return F.greatest(F.coalesce(whole.cast("int"), F.lit(1)), F.lit(1))


def rule_segment(r: Column, f: Column, m: Column) -> Column:
    """Rule-based customer label; the first matching rule wins."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "champions")
        .when((r >= 4) & (f <= 2), "new_customers")
        .when((r <= 2) & (f >= 4) & (m >= 4), "at_risk_high_value")
        .when((r <= 2) & (f <= 2), "lost")
        .otherwise("regular")
    )


# Fixed values: (recent, frequent, high value) -> base segment name.
OCTANTS = {
    (True, True, True): "champions",
    (True, True, False): "loyal_low_spend",
    (True, False, True): "promising_big_spenders",
    (True, False, False): "new_or_occasional",
    (False, True, True): "at_risk_high_value",
    (False, True, False): "at_risk_low_spend",
    (False, False, True): "hibernating_high_value",
    (False, False, False): "lost",
}


def octant_label(recent: Column, frequent: Column, high_value: Column) -> Column:
    table = F.create_map(
        *[
            F.lit(part)
            for (r, f, v), name in OCTANTS.items()
            for part in (f"{int(r)}{int(f)}{int(v)}", name)
        ]
    )
    return table[F.concat(*[c.cast("int").cast("string") for c in (recent, frequent, high_value)])]


def money_text(amount: Column, symbol: str = "£") -> Column:
    return F.concat(F.lit(symbol), F.format_number(amount, 0))


def percent_text(share: Column, digits: int = 1) -> Column:
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))


def product_label(stock_code: Column, description: Column) -> Column:
    """``code — description``; ``stock_code_of`` takes the code back out."""
    return F.concat_ws(" — ", stock_code, description)


def stock_code_of(label: Column) -> Column:
    return F.split(label, " — ").getItem(0)
