"""From raw global fields to regional forecasts on the target grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caelum.config import RAW_MEMBERS, Domain
from caelum.functions.calendar import valid_date
from caelum.functions.codec import coordinate, missing_to_null
from caelum.functions.fields import (
    convert_units,
    in_box,
    lower_from_range,
    range_above,
    range_below,
    upper_from_range,
    wrap_longitude,
)
from caelum.operators.regrid import Axes, Coordinates, regrid_bilinear, target_grid
from caelum.operators.reshape import (
    columns_to_variables,
    deinterleave,
    rename_variables,
    step_of_total,
    variables_to_columns,
)

ACCUMULATED = ("tp", "ssrd")
SERIES = ["variable", "issue_date", "ens", "lat", "lon"]


def cut_out(df: DataFrame, domain: Domain, halo: float = 1.0) -> DataFrame:
    """Wrap longitudes and keep the domain's box with a margin for interpolation."""
    placed = df.withColumn("lat", coordinate(F.col("lat"))).withColumn(
        "lon", coordinate(wrap_longitude(F.col("lon")))
    )
    return placed.where(in_box(F.col("lat"), F.col("lon"), domain.bbox, halo))


def raw_to_daily(raw: DataFrame, members: int = RAW_MEMBERS) -> DataFrame:
    """Interleaved raw axis (variable, issue_date, pos, lat, lon, value) to daily values, in one pass.

    Rows without a variable stay as they are.
    """
    df = deinterleave(raw, members).drop("pos")
    df = df.withColumn("variable", rename_variables(F.col("variable")))
    df = df.withColumn("value", convert_units(F.col("variable"), missing_to_null(F.col("value"))))
    total = F.coalesce(F.col("variable").isin(*ACCUMULATED), F.lit(False))
    step = step_of_total(SERIES)
    daily = df.withColumn("value", F.when(total, step).otherwise(F.col("value")))
    return daily.withColumn("valid_date", valid_date(F.col("issue_date"), F.col("lead")))


def add_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """Long table of t2m, t2max, t2min plus t2plus and t2minus."""
    wide = variables_to_columns(df, keys, ["t2m", "t2max", "t2min"])
    wide = wide.withColumn("t2plus", range_above(F.col("t2max"), F.col("t2m"))).withColumn(
        "t2minus", range_below(F.col("t2m"), F.col("t2min"))
    )
    return columns_to_variables(wide, keys, ["t2m", "t2max", "t2min", "t2plus", "t2minus"])


def remove_ranges(df: DataFrame, keys: list[str]) -> DataFrame:
    """Long table of t2m, t2plus, t2minus back to t2m, t2max, t2min."""
    wide = variables_to_columns(df, keys, ["t2m", "t2plus", "t2minus"])
    wide = wide.withColumn("t2max", upper_from_range(F.col("t2m"), F.col("t2plus"))).withColumn(
        "t2min", lower_from_range(F.col("t2m"), F.col("t2minus"))
    )
    return columns_to_variables(wide, keys, ["t2m", "t2max", "t2min"])


def to_target_grid(
    df: DataFrame, domain: Domain, axes: Axes | Coordinates, extra: list[str], snap: bool = False
) -> DataFrame:
    """Bilinear interpolation of a cut-out, or of global fields, to the domain's grid."""
    source = df.select(axes.lat_index().alias("lat_idx"), axes.lon_index().alias("lon_idx"), *extra, "value")
    source = source.where("lat_idx is not null and lon_idx is not null")  # not on the axes
    grid = target_grid(df.sparkSession, domain.bbox, domain.res, snap)
    return regrid_bilinear(source, grid, axes, extra)
