"""Writing tables: packed values, idempotent appends, series and map layouts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.config import VARIABLES
from caelum.functions.codec import missing_to_null, pack, unpack


def period_column(year: Column, syr: int, eyr: int) -> Column:
    """``period_label`` of rows by their year: calibration years together, any other by itself."""
    text = year.cast("string")
    return F.when(year.between(syr, eyr), "calib").otherwise(F.concat_ws("_", text, text))


def period_label(first: int, last: int, syr: int, eyr: int) -> str:
    """Partition value telling calibration output from any other period."""
    return "calib" if (first, last) == (syr, eyr) else f"{first}_{last}"


def write_partitions(
    df: DataFrame,
    path: str,
    by: list[str],
    sort: list[str] | None = None,
    replace_all: bool = False,
    tiles: int = 8,
) -> None:
    """Replace the partitions present in ``df`` and keep the others.

    A rerun of the same issue therefore writes it again instead of twice. ``sort`` gives the
    order inside a file. Rows are brought together by partition and one of ``tiles`` parts of the first sort column's values, and
    adaptive execution then makes tasks of its advisory size: small parts share one, a large one is divided among as many as
    its bytes need, each writing a file in order. Hash, not range, since a range partitioning would evaluate a computed ``df`` twice. ``replace_all`` drops the
    partitions not in ``df`` as well.
    """
    if sort:
        dealt = df.withColumn("_tile", F.pmod(F.xxhash64(sort[0]), F.lit(tiles))).hint("rebalance", *by, "_tile")
        df = dealt.drop("_tile").sortWithinPartitions(*by, *sort)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def write_packed(
    df: DataFrame, path: str, variable: str, by: list[str], sort: list[str] | None = None
) -> None:
    """Store ``value`` as the variable's scaled integer; NaN counts as missing."""
    packed = df.withColumn("value", pack(missing_to_null(F.col("value")), VARIABLES[variable]))
    write_partitions(packed, path, by, sort)


def read_packed(df: DataFrame, variable: str) -> DataFrame:
    return df.withColumn("value", unpack(F.col("value"), VARIABLES[variable]))


def packed_by_variable(variable: Column, value: Column) -> Column:
    """``value`` as the scaled integer of the row's own variable; of an unknown one as NULL."""
    value = missing_to_null(value)
    return F.coalesce(*[F.when(variable == name, pack(value, v).cast("int")) for name, v in VARIABLES.items()])


def unpacked_by_variable(variable: Column, packed: Column) -> Column:
    return F.coalesce(*[F.when(variable == name, unpack(packed.cast("int"), v)) for name, v in VARIABLES.items()])


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def relay(spark: SparkSession, path: str, write: Callable[[DataFrame, str], None]) -> None:
    """Write a store anew under its own path, in another order or partitioning.

    ``write(df, to)`` writes what the store holds to ``to``. That is a folder beside the store, which takes its place when it is
    complete; the old one is deleted last. A run that is broken off leaves the store whole under its path, or is put right
    by ``recover``, which the next ``relay`` calls first.
    """
    recover(spark, path)
    base = path.rstrip("/")
    write(spark.read.parquet(path), f"{base}__new")
    place, files = _files(spark, base)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(f"{base}__{x}") for x in ("new", "old"))
    files.rename(place, old)
    files.rename(new, place)
    files.delete(old, True)


def recover(spark: SparkSession, path: str) -> None:
    """Bring a store back to one of its two states after a broken ``relay``: the new one if it was complete, else the old one."""
    base = path.rstrip("/")
    place, files = _files(spark, base)
    new, old, done = (spark._jvm.org.apache.hadoop.fs.Path(f"{base}__{x}") for x in ("new", "old", "new/_SUCCESS"))
    if not files.exists(place) and files.exists(old):
        files.rename(new if files.exists(done) else old, place)
    for left in (new, old):
        if files.exists(left):
            files.delete(left, True)


def write_buckets(df: DataFrame, table: str, cell: list[str], buckets: int, order: list[str], path: str | None = None) -> None:
    """A store as a table hashed by cell into ``buckets`` and sorted: later joins and groupings by cell move nothing.

    Tables that are to be read together have the same ``cell`` and ``buckets``.
    """
    writer = df.repartition(buckets, *cell).write.mode("overwrite").bucketBy(buckets, *cell).sortBy(*cell, *order)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def series_layout(df: DataFrame, cell: list[str], order: list[str]) -> DataFrame:
    """Each cell's whole series contiguous in one file, for work along time."""
    return df.repartition(*cell).sortWithinPartitions(*cell, *order)


def map_layout(df: DataFrame, date: str, cell: list[str]) -> DataFrame:
    """Each date's whole field contiguous in one file, for work across cells."""
    return df.repartition(date).sortWithinPartitions(date, *cell)


def partition_columns(issue_date: Column) -> dict[str, Column]:
    return {"issue_year": F.year(issue_date), "issue_month": F.month(issue_date)}
