"""Unit, longitude and temperature-range arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 24 * 60 * 60


def wrap_longitude(lon: Column) -> Column:
    """0..360 degrees to -180..180."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def in_box(lat: Column, lon: Column, bbox, halo: float = 1.0) -> Column:
    """Inside (lon_min, lon_max, lat_min, lat_max) widened by ``halo`` degrees."""
    west, east, south, north = bbox
    return lat.between(south - halo, north + halo) & lon.between(west - halo, east + halo)


def precip_mm(metres: Column) -> Column:
    return metres * 1000.0


def mean_flux(joules: Column) -> Column:
    return joules / float(SECONDS_PER_DAY)


def convert_units(variable: Column, value: Column) -> Column:
    """Archive units of a long table to working units."""
    return (
        F.when(variable == "tp", precip_mm(value))
        .when(variable == "ssrd", mean_flux(value))
        .otherwise(value)
    )


def range_above(t2max: Column, t2m: Column) -> Column:
    return t2max - t2m


def range_below(t2m: Column, t2min: Column) -> Column:
    return t2m - t2min


def upper_from_range(t2m: Column, t2plus: Column) -> Column:
    return t2m + t2plus


def lower_from_range(t2m: Column, t2minus: Column) -> Column:
    return t2m - t2minus
