"""Missing values, packing, rounding and casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caelum.config import Variable


def missing_to_null(value: Column, fill: float | None = None) -> Column:
    """NaN, and the fill value where one is given, become NULL."""
    value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return value if fill is None else F.nullif(value, F.lit(float(fill)))


def pack(value: Column, var: Variable) -> Column:
    """Scaled integer, rounded half to even; NULL becomes the fill value."""
    scaled = F.rint((value - F.lit(var.offset)) / F.lit(var.scale))
    return F.coalesce(scaled, F.lit(float(var.fill))).cast(var.dtype)


def unpack(packed: Column, var: Variable) -> Column:
    stored = F.nullif(packed, F.lit(var.fill).cast(var.dtype)).cast("double")
    return stored * F.lit(var.scale) + F.lit(var.offset)


def half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to the even neighbour.

    Sums of doubles depend on the order tasks finish in; snapping to 1e-6 first makes a
    tie stay a tie whichever order that was.
    """
    scale = F.lit(float(10**digits))
    return F.rint(F.round(value, 6) * scale) / scale


def clamp(value: Column, lo: Column, hi: Column) -> Column:
    """Limit to [lo, hi]; a missing value stays missing."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, lo), hi))


def coordinate(value: Column, decimals: int = 4) -> Column:
    """Coordinate as a double that compares equal across files, fit for a join key."""
    return F.round(value.cast("double"), decimals)
