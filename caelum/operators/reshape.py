"""Member interleaving, hindcast layout, de-accumulation, variable columns and renaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caelum.config import DAILY_NAMES, RAW_MEMBERS, RENAMES
from caelum.functions.calendar import hindcast_date


def rename_columns(df: DataFrame) -> DataFrame:
    """Archive names of coordinates and wide variable columns to working names."""
    df = df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})
    return df.withColumnsRenamed({k: v for k, v in DAILY_NAMES.items() if k in df.columns})


def rename_variables(variable: Column) -> Column:
    """The same for the variable column of a long table."""
    names = {old: DAILY_NAMES.get(new, new) for old, new in RENAMES.items()}
    names.update(DAILY_NAMES)
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[variable], variable)


def drop_auxiliary(df: DataFrame, names=("time_bnds", "lat_bnds", "lon_bnds", "bnds")) -> DataFrame:
    return df.drop(*names)


def deinterleave(df: DataFrame, members: int = RAW_MEMBERS, pos: str = "pos") -> DataFrame:
    """Flat axis with members interleaved: position -> (ens, lead)."""
    at = F.col(pos)
    return df.withColumn("ens", F.pmod(at, F.lit(members)).cast("int")).withColumn(
        "lead", F.floor(at / members).cast("int")
    )


def deaccumulate(df: DataFrame, series: list[str], order: str = "lead", value: str = "value") -> DataFrame:
    """Running totals to steps: the first value stays, later ones subtract their predecessor.

    ``series`` must identify one forecast series (cell, issue, member), whose length is the
    number of lead days.
    """
    return df.withColumn(value, step_of_total(series, order, value))


def step_of_total(series: list[str], order: str = "lead", value: str = "value") -> Column:
    """Step of a running total; NULL where the step before is absent, since its total is not known."""
    w = Window.partitionBy(*series).orderBy(order)
    before = F.lag(value).over(w)
    follows = F.lag(order).over(w) == F.col(order) - 1
    return F.when(F.row_number().over(w) == 1, F.col(value)).when(follows, F.col(value) - before)


def flatten_hindcast(df: DataFrame) -> DataFrame:
    """(year, month, step) to a valid date."""
    return df.withColumn("valid_date", hindcast_date(F.col("year"), F.col("month"), F.col("step")))


def variables_to_columns(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Long to wide with one shuffle; a variable without a row is NULL."""
    aggs = [
        F.max(F.when(F.col("variable") == name, F.col("value"))).alias(name) for name in names
    ]
    return df.where(F.col("variable").isin(names)).groupBy(*keys).agg(*aggs)


def columns_to_variables(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return df.unpivot(keys, names, "variable", "value")


def join_variables(frames: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Outer join of one table per variable on the coordinates, by one grouping of their union.

    ``keys`` identify a row of each table.
    """
    parts = [df.select(*keys, F.lit(name).alias("variable"), "value") for name, df in frames.items()]
    return variables_to_columns(reduce(DataFrame.unionByName, parts), keys, list(frames))


def select_variables(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Rows of exactly the named variables."""
    return df.where(F.col("variable").isin(list(wanted)))
