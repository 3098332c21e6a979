"""Monthly means, climatologies and monthly quantile thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caelum.functions.calendar import in_month_set, month_start
from caelum.operators.quantiles import group_quantiles

# Probabilities of the threshold products.
THRESHOLDS = {
    "quintile": (0.2, 0.4, 0.6, 0.8),
    "tercile": (0.33, 0.66),
    "extreme": (0.1, 0.9),
}


def monthly_mean(df: DataFrame, keys: list[str], date: str = "valid_date") -> DataFrame:
    """Mean per keys and month, labelled with the month's first day; missing days are skipped."""
    return df.groupBy(*keys, month_start(F.col(date)).alias("month_start")).agg(
        F.avg("value").alias("value")
    )


def monthly_series(df: DataFrame, keys: list[str], months: int = 8) -> DataFrame:
    """Monthly means of all issues, kept to the months a forecast covers.

    ``keys`` includes issue_date. Whole months are dropped, so filtering days first is the same.
    """
    inside = in_month_set(F.col("valid_date"), F.col("issue_date"), months)
    return monthly_mean(df.where(inside), keys)


def reference_climatology(df: DataFrame, keys: list[str], date: str = "valid_date") -> DataFrame:
    """Mean of all values of a calendar month."""
    return df.groupBy(*keys, F.month(date).alias("month")).agg(F.avg("value").alias("value"))


def forecast_climatology(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean per member, issue month and calendar month."""
    return df.groupBy(
        *keys, "ens", F.month("issue_date").alias("issue_month"), F.month("valid_date").alias("month")
    ).agg(F.avg("value").alias("value"))


def _wanted() -> dict[str, tuple[float, str]]:
    return {f"q{round(p * 100)}": (p, "linear") for probs in THRESHOLDS.values() for p in probs}


def counted_thresholds(summary: DataFrame, keys: list[str], bounded: bool = True) -> DataFrame:
    """Threshold quantiles of values that are counted already: keys (the month among them), value, copies."""
    wanted = _wanted()
    if not bounded:
        return group_quantiles(summary, keys, "value", wanted)
    probs = F.array(*[F.lit(p) for p, _ in wanted.values()])
    found = summary.groupBy(*keys).agg(F.percentile("value", probs, F.col("copies")).alias("_q"))
    return found.select(*keys, *[F.get("_q", F.lit(k)).alias(name) for k, name in enumerate(wanted)])


def monthly_thresholds(
    df: DataFrame, keys: list[str], date: str = "month_start", bounded: bool = True
) -> DataFrame:
    """Threshold quantiles per calendar month over everything pooled: years, and members if any.

    ``df`` holds monthly means. Columns are named q20, q40, ... q90. ``bounded`` as in
    ``group_quantiles``: cell and month bound a group unless the caller says otherwise.
    """
    wanted = _wanted()
    by_month = df.withColumn("month", F.month(date))
    return group_quantiles(by_month, [*keys, "month"], "value", wanted, bounded)
