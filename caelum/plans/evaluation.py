"""The monthly evaluation product of a forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caelum.functions.codec import half_even
from caelum.operators.categories import (
    best_category,
    class_counts,
    count_columns,
    encode_category,
    probability,
)
from caelum.operators.ensemble import anomaly, relative_anomaly, simple_statistics
from caelum.operators.quantiles import from_sorted

PRODUCTS = ("tercile", "quintile", "extreme")


def member_counts(
    monthly: DataFrame,
    thresholds: DataFrame,
    cell: list[str],
    issue: list[str],
    also: list[Column] | None = None,
) -> DataFrame:
    """Members per category of each forecast month; thresholds are matched by calendar month.

    ``also`` holds further aggregates over the same members.
    """
    rows = monthly.withColumn("month", F.month("month_start")).join(
        thresholds, [*cell, "month"], "left"
    )
    aggs = [agg for product in PRODUCTS for agg in class_counts(F.col("value"), product)]
    # month and q90 follow from the other keys; naming month keeps the join's partitioning
    return rows.groupBy(*cell, "month", *issue, "month_start").agg(
        *aggs, F.first("q90").alias("q90"), *(also or [])
    )


def evaluate(
    monthly: DataFrame,
    climatology: DataFrame,
    thresholds: DataFrame,
    cell: list[str],
    issue: list[str],
    members: int | Column,
    precip: bool = False,
    sentinel: str = "equal",
) -> DataFrame:
    """All measures per cell, issue and month from monthly means of the members.

    The members are read and shuffled once; a group is one forecast month, so its list holds at
    most the ensemble. Everything after works on one row per cell, issue and month.
    """
    forecast = [*cell, *issue, "month_start"]
    clim = climatology.select(*cell, "month", F.col("value").alias("clim"))
    normals = thresholds.join(clim, [*cell, "month"], "full")
    also = [agg.alias(name) for name, agg in simple_statistics().items()]
    also += [
        F.first("clim").alias("clim"),
        F.sort_array(F.collect_list("value")).alias("sorted"),
        F.min_by(F.struct("value"), "ens")["value"].isNotNull().alias("first_member"),
    ]
    df = member_counts(monthly, normals, cell, issue, also)
    names = [name for product in PRODUCTS for name in count_columns(product)]
    # the mask is the first member of the first month of the forecast
    first = Window.partitionBy(*cell, *issue).orderBy("month_start")
    df = df.select(
        *forecast,
        *names,
        *simple_statistics(),
        "clim",
        "q90",
        from_sorted("sorted", 0.5, "midpoint").alias("median"),
        (from_sorted("sorted", 0.75, "midpoint") - from_sorted("sorted", 0.25, "midpoint")).alias("iqr"),
        F.first("first_member").over(first).alias("present"),
    )
    df = df.withColumns({n: probability(F.col(n), members, F.col("present")) for n in names})
    wet = F.col("q90") if precip else None
    codes = {
        product: half_even(
            encode_category(
                best_category([F.col(n) for n in count_columns(product)]), product, sentinel, wet
            ),
            2,
        )
        for product in PRODUCTS
    }
    return df.select(
        *forecast,
        half_even(F.col("mean"), 1).alias("ensemble_mean"),
        half_even(F.col("median"), 1).alias("ensemble_median"),
        half_even(F.col("spread"), 1).alias("ensemble_spread"),
        half_even(F.col("std"), 1).alias("ensemble_std"),
        half_even(F.col("iqr"), 1).alias("ensemble_iqr"),
        half_even(anomaly(F.col("mean"), F.col("clim")), 1).alias("ensemble_anomaly"),
        half_even(relative_anomaly(F.col("mean"), F.col("clim")), 1).alias(
            "ensemble_mean_relative"
        ),
        codes["tercile"].alias("tercile_probab"),
        codes["quintile"].alias("quintile_probab"),
        codes["extreme"].alias("extreme_probab"),
        half_even(F.col("tercile_3"), 1).alias("above_normal_probab"),
        half_even(F.col("tercile_1"), 1).alias("below_normal_probab"),
        half_even(F.col("extreme_2"), 1).alias("extreme_high_probab"),
        half_even(F.col("extreme_1"), 1).alias("extreme_low_probab"),
    )
