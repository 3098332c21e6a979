"""Regular target grids and bilinear interpolation onto them, from regular or irregular axes, round the globe or not."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caelum.functions.sorted_arrays import last_at_most


def axis_length(lo: float, hi: float, res: float, snap: bool = False) -> int:
    """Points of an axis. The quotient is truncated, so 5.3 / 0.1 gives 53 points, not 54;
    ``snap`` rounds it instead."""
    steps = (hi - lo) / res
    return (round(steps) if snap else int(steps)) + 1


def target_grid(spark: SparkSession, bbox, res: float, snap: bool = False) -> DataFrame:
    """(lat_idx, lon_idx, lat, lon) of a (lon_min, lon_max, lat_min, lat_max) box."""
    west, east, south, north = bbox
    n_lat, n_lon = axis_length(south, north, res, snap), axis_length(west, east, res, snap)
    cell = F.col("id")
    lat_idx = F.floor(cell / n_lon).cast("int")
    lon_idx = (cell % n_lon).cast("int")
    return spark.range(n_lat * n_lon).select(
        lat_idx.alias("lat_idx"),
        lon_idx.alias("lon_idx"),
        (F.lit(float(south)) + lat_idx * F.lit(float(res))).alias("lat"),
        (F.lit(float(west)) + lon_idx * F.lit(float(res))).alias("lon"),
    )


CIRCLE = 360.0


@dataclass(frozen=True)
class Axes:
    """A regular source grid: first coordinate and step of each axis.

    ``ring`` is the number of columns of a grid that goes round the globe: the last column's eastern neighbour is then the
    first, and longitudes may be given from any meridian on.
    """

    lat0: float
    dlat: float
    lon0: float
    dlon: float
    ring: int | None = None

    def __post_init__(self):
        if self.ring and abs(abs(self.dlon) * self.ring - CIRCLE) > 1e-6 * CIRCLE:
            raise ValueError(f"{self.ring} columns of {self.dlon} degrees do not go round the globe")

    def _east(self) -> Column:
        """Degrees from the first column, in the direction of the columns."""
        turned = (F.col("lon") - self.lon0) / self.dlon
        return F.pmod(turned, F.lit(float(self.ring))) if self.ring else turned

    def lat_box(self) -> tuple[Column, Column]:
        """Box index of ``lat`` and the offset inside the box, 0 <= offset < 1."""
        at = (F.col("lat") - self.lat0) / self.dlat
        return F.floor(at).cast("int"), at - F.floor(at)

    def lon_box(self) -> tuple[Column, Column]:
        at = self._east()
        return F.floor(at).cast("int"), at - F.floor(at)

    def lat_index(self) -> Column:
        """The row of a source cell at ``lat``."""
        return F.round((F.col("lat") - self.lat0) / self.dlat).cast("int")

    def lon_index(self) -> Column:
        at = F.round(self._east()).cast("int")
        return F.pmod(at, F.lit(self.ring)) if self.ring else at


@dataclass(frozen=True)
class Coordinates:
    """A source grid by its own coordinates, evenly spaced or not, rising or falling, in the order of its indices.

    ``ring`` says that the columns go round the globe, as for ``Axes``.
    """

    lats: tuple[float, ...]
    lons: tuple[float, ...]
    ring: bool | int = False

    def __post_init__(self):
        for axis in (self.lats, self.lons):
            steps = [b - a for a, b in zip(axis, axis[1:])]
            if not axis or not (all(s > 0 for s in steps) or all(s < 0 for s in steps)):
                raise ValueError("coordinates must rise, or fall, from each to the next")
        if self.ring:
            if abs(self.lons[-1] - self.lons[0]) >= CIRCLE:
                raise ValueError("columns of a ring must lie within one turn")
            object.__setattr__(self, "ring", len(self.lons))

    def _axis(self, name: str, values: tuple[float, ...]) -> tuple[str, str, list[float]]:
        """(coordinate, array) in SQL, both rising, and the array's numbers. A ring's begins again at its end."""
        sign = -1.0 if len(values) > 1 and values[1] < values[0] else 1.0
        numbers = [sign * v for v in values]
        x = f"({sign}D * {name})"
        if self.ring and name == "lon":
            x = f"({numbers[0]!r}D + pmod({x} - {numbers[0]!r}D, {CIRCLE}D))"
            numbers = [*numbers, numbers[0] + CIRCLE]
        return x, f"array({', '.join(f'{v!r}D' for v in numbers)})", numbers

    def _box(self, name: str, values: tuple[float, ...]) -> tuple[Column, Column]:
        x, array, _ = self._axis(name, values)
        at = last_at_most(array, x)
        near, far = f"get({array}, {at})", f"get({array}, {at} + 1)"
        # outside the axis any offset will do that asks for a corner beyond it
        inside = f"if({x} = {near}, 0D, coalesce(({x} - {near}) / ({far} - {near}), 0.5D))"
        return F.expr(at).cast("int"), F.expr(inside)

    def _index(self, name: str, values: tuple[float, ...], most_off: float = 1e-4) -> Column:
        """The place of a coordinate on its axis; NULL for one that is not on it."""
        x, array, numbers = self._axis(name, values)
        at = f"{last_at_most(array, f'({x} + {most_off}D)')}"
        found = F.when(F.expr(f"{x} - get({array}, {at}) <= {most_off}D"), F.expr(at).cast("int"))
        return F.pmod(found, F.lit(len(numbers) - 1)) if self.ring and name == "lon" else found

    def lat_box(self) -> tuple[Column, Column]:
        return self._box("lat", self.lats)

    def lon_box(self) -> tuple[Column, Column]:
        return self._box("lon", self.lons)

    def lat_index(self) -> Column:
        return self._index("lat", self.lats)

    def lon_index(self) -> Column:
        return self._index("lon", self.lons)


def coordinates_of(df: DataFrame, ring: bool = False, falling_lats: bool = False) -> Coordinates:
    """The axes that a source's own ``lat`` and ``lon`` make: as many numbers as the grid has rows and columns."""
    lats, lons = (sorted(r[0] for r in df.select(c).where(F.col(c).isNotNull()).distinct().collect()) for c in ("lat", "lon"))
    return Coordinates(tuple(reversed(lats) if falling_lats else lats), tuple(lons), ring)


def regrid_bilinear(
    source: DataFrame, target: DataFrame, axes: Axes | Coordinates, extra: list[str]
) -> DataFrame:
    """Interpolate ``source`` (lat_idx, lon_idx, extra, value) to ``target`` (…, lat, lon).

    Every field of ``extra`` gets every target cell; a cell is NULL if a corner it needs is missing, so
    also wherever it lies outside the source; a grid that goes round the globe has no outside to the east and west. A field's values are hashed by ``extra`` once, each a single time. The cells that
    targets need but the field lacks are added without a value, so that neighbours are next rows of two windows
    over the same hash. Target cells of a box then only read that box: nothing at target resolution is shuffled.
    """
    row, dy = axes.lat_box()
    col, dx = axes.lon_box()
    placed = target.select(
        F.col("lat_idx"),
        F.col("lon_idx"),
        "lat",
        "lon",
        row.alias("box_lat"),
        col.alias("box_lon"),
        dy.alias("dy"),
        dx.alias("dx"),
    )

    def span(box: str) -> Column:
        """The boxes of an axis that hold targets, and the one beyond for its far corners."""
        least, most = (placed.select(f(box)).scalar() for f in (F.min, F.max))
        return F.explode(F.sequence(least, most + 1))

    needed = (
        source.select(*extra)
        .distinct()
        .withColumn("lat_idx", span("box_lat"))
        .withColumn("lon_idx", span("box_lon"))
    )
    values = source.select(*extra, "lat_idx", "lon_idx", "value")
    if axes.ring:  # the first column stands behind the last one too
        at = F.col("lon_idx")
        values = values.withColumn("lon_idx", F.explode(F.when(at == 0, F.array(at, F.lit(axes.ring))).otherwise(F.array(at))))
    cells = (
        values
        .unionByName(needed, allowMissingColumns=True)
        .repartition(*extra)
        .groupBy(*extra, "lat_idx", "lon_idx")
        .agg(F.max("value").alias("v0"))
    )
    east = Window.partitionBy(*extra, "lat_idx").orderBy("lon_idx").rangeBetween(1, 1)
    north = Window.partitionBy(*extra, "lon_idx").orderBy("lat_idx").rangeBetween(1, 1)
    boxes = (
        cells.withColumn("v1", F.max("v0").over(east))
        .withColumn("v2", F.max("v0").over(north))
        .withColumn("v3", F.max("v1").over(north))
        .withColumnsRenamed({"lat_idx": "box_lat", "lon_idx": "box_lon"})
    )
    weights = [
        (1 - F.col("dy")) * (1 - F.col("dx")),
        (1 - F.col("dy")) * F.col("dx"),
        F.col("dy") * (1 - F.col("dx")),
        F.col("dy") * F.col("dx"),
    ]
    parts = [F.when(w > 0, w * F.col(f"v{c}")).otherwise(0.0) for c, w in enumerate(weights)]
    return boxes.join(placed, ["box_lat", "box_lon"]).select(
        "lat_idx",
        "lon_idx",
        "lat",
        "lon",
        *extra,
        (parts[0] + parts[1] + parts[2] + parts[3]).alias("value"),
    )
