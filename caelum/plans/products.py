"""Products of a corrected forecast, and the stores they are read from and written to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.config import VARIABLES, CorrectionParams, Domain
from caelum.functions.calendar import evaluation_months, month_start, valid_date
from caelum.operators.categories import nominal_members
from caelum.operators.monthly import counted_thresholds, monthly_mean, monthly_thresholds
from caelum.plans.bias_correction import bias_correct
from caelum.plans.evaluation import evaluate
from caelum.sources.scan import scan_store, tile
from caelum.sources.sink import (
    packed_by_variable,
    partition_columns,
    period_column,
    unpacked_by_variable,
    write_partitions,
)

CELL = ["variable", "lat", "lon"]
ISSUE = ["variable", "period", "issue_year", "issue_month"]


def write_issue(df: DataFrame, path: str, domain: Domain, order: list[str] | None = None) -> None:
    """Add one or more issues (variable, issue_date, ...) to a forecast store, packed.

    Partitions are labelled by period: ``calib`` for the domain's calibration years. ``order`` is the layout inside an
    issue: cell first for series, date first for maps.
    """
    order = order or ["lat", "lon", "valid_date", "ens"]
    parts = partition_columns(F.col("issue_date"))
    stored = df.withColumns({**parts, "period": period_column(parts["issue_year"], domain.syr, domain.eyr)})
    stored = stored.withColumn("value", packed_by_variable(F.col("variable"), F.col("value")))
    write_partitions(stored, path, ISSUE, [c for c in order if c in df.columns])


def read_issues(spark: SparkSession, path: str, variables: list[str] | None = None, period: str | None = None, years: str | None = None, months: str | None = None) -> DataFrame:
    """What ``write_issue`` stored, unpacked; conditions prune partitions."""
    df = scan_store(spark, path, variables, years, months, "issue_year", "issue_month")
    if period is not None:
        df = df.where(F.col("period") == period)
    return df.withColumn("value", unpacked_by_variable(F.col("variable"), F.col("value")))


def write_reference(df: DataFrame, path: str, tiled: bool = False) -> None:
    """Add years of a reference (variable, valid_date, lat, lon, value) to its store.

    ``tiled`` partitions by tile too, so that a list of cells reads its own tiles only.
    """
    stored = df.withColumn("year", F.year("valid_date"))
    if tiled:
        stored = stored.withColumn("tile", tile(F.col("lat"), F.col("lon")))
    write_partitions(stored, path, ["variable", *(["tile"] if tiled else []), "year"], ["lat", "lon", "valid_date"])


def hindcast(spark, path: str, variable: str, issue_month: int, domain: Domain) -> DataFrame:
    """All calibration years of an issue month; partitions outside are not read."""
    return read_issues(spark, path, [variable], "calib", f"{domain.syr},0,{domain.eyr}", str(issue_month))


def reference(spark, path: str, variable: str, domain: Domain) -> DataFrame:
    return scan_store(spark, path, [variable], f"{domain.syr},0,{domain.eyr}")


def correct_variable(
    forecast: DataFrame,
    history: DataFrame,
    past: DataFrame,
    domain: Domain,
    variable: str,
    params: CorrectionParams | None = None,
    crossval: bool = False,
    bounded: bool = True,
) -> DataFrame:
    """Corrected forecast of one variable in the schema of the raw one.

    ``forecast`` and ``past`` (the hindcast) have variable, issue_date, lead, ens, lat, lon and
    value; ``history`` has variable, valid_date, lat, lon and value. A cell of a grid bounds its rows by
    years, members and days; say ``bounded=False`` of inputs without such a bound.
    """

    def issued(df: DataFrame) -> DataFrame:
        return df.withColumns(partition_columns(F.col("issue_date"))).select(
            *CELL, "issue_year", "issue_month", "lead", "ens", "value"
        )

    corrected = bias_correct(
        issued(forecast),
        history.select(*CELL, "valid_date", "value"),
        issued(past),
        CELL,
        ["issue_year", "ens"],
        domain.syr,
        params or domain.params,
        VARIABLES[variable].precip,
        crossval,
        bounded,
    )
    issue = F.make_date(F.col("issue_year"), F.col("issue_month"), F.lit(1))
    return corrected.select(
        "variable",
        issue.alias("issue_date"),
        "lead",
        valid_date(issue, F.col("lead")).alias("valid_date"),
        "ens",
        "lat",
        "lon",
        F.col("corrected").alias("value"),
    )


def monthly_forecast(df: DataFrame) -> DataFrame:
    return monthly_mean(df, [*CELL, "issue_date", "ens"])


def normals(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(climatology, thresholds) of a daily reference, both from one table of monthly sums and counts."""
    months = history.groupBy(*CELL, month_start(F.col("valid_date")).alias("month_start")).agg(
        F.sum("value").alias("total"), F.count("value").alias("days")
    )
    by_month = months.groupBy(*CELL, F.month("month_start").alias("month"))
    climatology = by_month.agg(F.try_divide(F.sum("total"), F.sum("days")).alias("value"))
    means = months.select(*CELL, "month_start", F.try_divide("total", "days").alias("value"))
    return climatology, monthly_thresholds(means, CELL)


def add_to_summary(months: DataFrame, path: str, keys: list[str], added: str = "year") -> None:
    """Put years (or issues) of monthly means into a stored summary: each distinct value of a key and calendar month with its copies.

    ``months`` has keys, month_start, ``added`` and value. A summary is partitioned by ``added``: a year that comes again
    replaces itself, no other partition is read or written. Summaries are exact and add up, see ``summary_thresholds``.
    """
    counted = months.groupBy(*keys, F.month("month_start").alias("month"), added, "value").agg(F.count("*").alias("copies"))
    write_partitions(counted, path, [added], [*keys, "month"])


def summary_thresholds(spark: SparkSession, path: str, keys: list[str], bounded: bool = True) -> DataFrame:
    """Thresholds of all that a summary holds, without the values it was made from; as ``monthly_thresholds`` would give them."""
    summary = spark.read.parquet(path).groupBy(*keys, "month", "value").agg(F.sum("copies").alias("copies"))
    return counted_thresholds(summary, [*keys, "month"], bounded)


def forecast_thresholds(months: DataFrame) -> DataFrame:
    """Thresholds of monthly forecasts, kept apart by issue month."""
    by_issue = months.withColumn("issue_month", F.month("issue_date"))
    return monthly_thresholds(by_issue, [*CELL, "issue_month"])


def evaluate_variable(
    months: DataFrame,
    climatology: DataFrame,
    thresholds: DataFrame,
    variable: str,
    by_lead: bool = False,
) -> DataFrame:
    """Evaluation of monthly forecasts: calendar months 1 to 7, or the first seven lead months."""
    months = months.withColumn("month_start", month_start(F.col("month_start")))
    issue = F.col("issue_date") if by_lead else None
    return evaluate(
        months.where(evaluation_months(F.col("month_start"), issue)),
        climatology,
        thresholds,
        CELL,
        ["issue_date"],
        nominal_members(F.col("issue_date")),
        VARIABLES[variable].precip,
    )


