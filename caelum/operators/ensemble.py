"""Statistics over the members of a forecast and its distance to the climatology."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caelum.operators.quantiles import group_quantiles


def ensemble_statistics(
    df: DataFrame, keys: list[str], bounded: bool = True
) -> DataFrame:
    """Mean, median, population standard deviation, midpoint IQR and spread.

    A group holds the members of one forecast, at most the ensemble size; say ``bounded=False`` of
    groups that pool more than that.
    """
    # the midpoint median equals the linear one, so one sorted list serves all three
    wanted = {k: (p, "midpoint") for k, p in (("median", 0.5), ("q25", 0.25), ("q75", 0.75))}
    df = group_quantiles(df, keys, "value", wanted, bounded, also=simple_statistics())
    return df.select(
        *keys, "mean", "median", "std", (F.col("q75") - F.col("q25")).alias("iqr"), "spread"
    )


def simple_statistics() -> dict[str, Column]:
    return {
        "mean": F.avg("value"),
        "std": F.stddev_pop("value"),
        "spread": F.max("value") - F.min("value"),
    }


def anomaly(value: Column, climatology: Column) -> Column:
    return value - climatology


def relative_anomaly(value: Column, climatology: Column) -> Column:
    """Percent above or below the climatology; NULL where that is zero."""
    return (F.try_divide(value, climatology) - 1) * 100
