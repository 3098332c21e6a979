"""Reading forecast and reference tables, and describing what they cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.functions.calendar import in_period
from caelum.functions.codec import missing_to_null

#: What sources write for a missing value, besides NaN.
FILL = -9999.0


def _without_fill(df: DataFrame, fill: float | None, value: str = "value") -> DataFrame:
    """NaN and ``fill`` as NULL in a floating ``value``; packed integers are left to ``read_packed``."""
    if dict(df.dtypes).get(value) not in ("double", "float"):
        return df
    return df.withColumn(value, missing_to_null(F.col(value), fill))


def scan_files(spark: SparkSession, pattern: str, names: dict[str, list[str]] | None = None) -> DataFrame:
    """Files that may name their columns differently, in one read.

    ``names`` maps a column to the names that files give it; of a row the first that is not NULL counts. Files' schemas are
    merged by name, so each row has the columns of its own file and NULL in all others. A name that no file has is passed over;
    a column of which no file has any name is not there.
    """
    if names is None:
        return spark.read.parquet(pattern)
    df = spark.read.option("mergeSchema", "true").parquet(pattern)
    present = set(df.columns)
    found = {to: own for to, given in names.items() if (own := [n for n in dict.fromkeys([to, *given]) if n in present])}
    used = {n for own in found.values() for n in own}
    rest = [c for c in df.columns if c not in used]
    return df.select(*rest, *[F.coalesce(*own).alias(to) for to, own in found.items()], "_metadata")


def scan_members(
    spark: SparkSession,
    pattern: str,
    member: str = r"_(\d+)\.parquet",
    fill: float | None = FILL,
    names: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Files of one member each, in one read; the member number comes from the file path. ``names`` as in ``scan_files``."""
    path = F.col("_metadata.file_path")
    df = scan_files(spark, pattern, names).withColumn("ens", F.regexp_extract(path, member, 1).cast("int"))
    return _without_fill(df.drop("_metadata") if names is not None else df, fill)


def tile(lat: Column, lon: Column, degrees: int = 10) -> Column:
    """The square of ``degrees`` that a cell lies in, as a partition value; a whole globe has (180 / degrees) * (360 / degrees) + a rim."""
    corner = lambda x: F.floor(x / degrees).cast("int").cast("string")
    return F.concat_ws("_", corner(lat), corner(lon))


def scan_store(
    spark: SparkSession,
    path: str,
    variables: list[str] | None = None,
    years: str | None = None,
    months: str | None = None,
    year: str = "year",
    month: str = "month",
    fill: float | None = FILL,
    cells: DataFrame | None = None,
    degrees: int = 10,
) -> DataFrame:
    """Partitioned table; variable, year and month conditions prune partitions.

    ``years`` and ``months`` are period texts such as "1981,0,2016". NaN and ``fill`` in ``value``
    become NULL. ``cells`` (lat, lon) keeps those cells only, by a semi-join; in a store with a partition column ``tile`` (of
    ``degrees``, see ``tile``) only their tiles are read. Tiles, not cells, are looked up first: no list of them is longer
    than the globe has tiles, however many cells are asked for.
    """
    df = spark.read.parquet(path)
    if variables is not None:
        df = df.where(F.col("variable").isin(variables))
    if years is not None:
        df = df.where(in_period(F.col(year), years))
    if months is not None:
        df = df.where(in_period(F.col(month), months))
    if cells is not None:
        wanted = cells.select(F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")).distinct()
        if "tile" in df.columns:
            tiles = wanted.select(tile(F.col("lat"), F.col("lon"), degrees).alias("tile")).distinct().collect()
            df = df.where(F.col("tile").isin([r["tile"] for r in tiles]))
        df = df.join(wanted, ["lat", "lon"], "left_semi")
    return _without_fill(df, fill)


def axis(df: DataFrame, name: str) -> DataFrame:
    """Distinct values of a coordinate, sorted."""
    return df.select(name).distinct().orderBy(name)


def coverage(df: DataFrame, lat: str = "lat", lon: str = "lon", date: str = "valid_date") -> DataFrame:
    return df.agg(
        F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
        F.min(lat).alias("lat_min"),
        F.max(lat).alias("lat_max"),
        F.min(date).alias("start"),
        F.max(date).alias("stop"),
    )
