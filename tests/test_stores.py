"""Stores: what is read and written, and what a broken run leaves."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from caelum.operators.windows import without_own_year
from caelum.plans import products
from caelum.session import scratch_path
from caelum.sources import scan, sink


def days(spark, years=(2000, 2001)):
    rows = [("tp", dt.date(y, m, 1), float(lat), float(lon), lat + lon / 10 + m) for y in years for m in (1, 7) for lat in range(-30, 31, 6) for lon in range(-40, 41, 8)]
    return spark.createDataFrame(rows, "variable string, valid_date date, lat double, lon double, value double")


def test_cell_list_reads_its_tiles(spark):
    path = scratch_path(spark, "tiles")
    df = days(spark)
    products.write_reference(df, path, tiled=True)
    cells = spark.createDataFrame([(-30.0, -40.0), (0.0, 8.0), (0.0, 8.0), (1.0, 1.0), (None, 0.0)], "lat double, lon double")
    got = scan.scan_store(spark, path, ["tp"], "2000", cells=cells)
    want = df.where("year(valid_date) = 2000 and ((lat = -30 and lon = -40) or (lat = 0 and lon = 8))")
    names = ["valid_date", "lat", "lon", "value"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, want.select(names).collect()))
    # with a tile wanted, files of no other are read
    one = scan.scan_store(spark, path, cells=cells.limit(1)).select("lat", "lon", F.input_file_name().alias("file"))
    assert [r["lat"] for r in one.select("lat").distinct().collect()] == [-30.0]
    scanned = one._jdf.queryExecution().optimizedPlan().toString()
    assert "-3_-4" in scanned and "0_0" not in scanned
    assert scan.scan_store(spark, path, cells=cells.limit(0)).count() == 0
    flat = scratch_path(spark, "flat")
    products.write_reference(df, flat)
    assert scan.scan_store(spark, flat, cells=cells).count() == 8


def test_relay_and_recover(spark):
    path = scratch_path(spark, "relay")
    df = days(spark)
    df.write.parquet(path)
    size = lambda: spark.read.parquet(path).count()

    def breaks(old, to):
        old.limit(3).write.parquet(to)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sink.relay(spark, path, breaks)
    assert size() == df.count()
    sink.relay(spark, path, lambda old, to: sink.map_layout(old, "valid_date", ["lat", "lon"]).write.parquet(to))
    assert sorted(spark.read.parquet(path).collect()) == sorted(df.collect())
    # lost between the two renames: the new store is complete, so it takes the place
    place, files = sink._files(spark, path)
    names = {x: spark._jvm.org.apache.hadoop.fs.Path(f"{path}__{x}") for x in ("new", "old")}
    files.rename(place, names["old"])
    df.where("month(valid_date) = 1").write.parquet(f"{path}__new")
    sink.recover(spark, path)
    assert size() * 2 == df.count() and not files.exists(names["old"])
    # the same with an incomplete new store: the old one comes back
    files.rename(place, names["old"])
    df.write.parquet(f"{path}__new")
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}__new/_SUCCESS"), False)
    sink.recover(spark, path)
    assert size() * 2 == df.count() and not files.exists(names["new"])


def test_files_of_mixed_names(spark):
    path = scratch_path(spark, "mixed")
    spark.createDataFrame([(1, 2.0, 0.5)], "longitude int, lat double, var228 double").write.parquet(f"{path}/m_1.parquet")
    spark.createDataFrame([(3, 4.0, float("nan"))], "lon int, lat double, value double").write.parquet(f"{path}/m_2.parquet")
    got = scan.scan_members(spark, f"{path}/*", r"m_(\d+)\.parquet", names={"lon": ["longitude"], "value": ["var228"], "time": ["t"]})
    assert sorted(got.select("ens", "lon", "lat", "value").collect()) == [(1, 1, 2.0, 0.5), (2, 3, 4.0, None)]
    assert set(got.columns) == {"ens", "lon", "lat", "value"}


def test_summary_equals_a_full_run(spark):
    path = scratch_path(spark, "summary")
    rows = [(c, dt.date(y, m, 1), y, None if (c + y) % 11 == 0 else float((c * 7 + y * 13 + m) % 9)) for c in range(5) for y in range(1990, 2004) for m in (1, 2)]
    months = spark.createDataFrame(rows, "cell int, month_start date, year int, value double")
    for lo, hi in ((1990, 2000), (2001, 2003), (1995, 1996)):
        products.add_to_summary(months.where(F.col("year").between(lo, hi)), path, ["cell"])
    full = products.monthly_thresholds(months, ["cell"])
    names = sorted(full.columns)
    want = sorted(map(tuple, full.select(names).collect()))
    for bounded in (True, False):
        got = sorted(map(tuple, products.summary_thresholds(spark, path, ["cell"], bounded).select(names).collect()))
        assert [pytest.approx(x) for x in want] == got
    plan = products.summary_thresholds(spark, path, ["cell"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_partitions_are_divided_by_size(spark):
    """One partition is written by as many tasks as its bytes ask for."""
    path = scratch_path(spark, "sizes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        df = spark.range(0, 3_000_000, 1, 40).select((F.col("id") % 100_000 == 0).cast("int").alias("part"), F.xxhash64("id").alias("cell"), F.rand(1).alias("value"))
        sink.write_partitions(df, path, ["part"], ["cell"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {r["part"]: r["n"] for r in spark.read.parquet(path).groupBy("part").agg(F.countDistinct("_metadata.file_path").alias("n")).collect()}
    assert files[0] > 8
    assert spark.read.parquet(path).count() == 3_000_000


def test_scratch_needs_a_shared_folder(spark):
    class Elsewhere:
        """A session on a cluster without the setting."""

        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master, applicationId = "yarn", "app"

    with pytest.raises(ValueError):
        scratch_path(Elsewhere, "x")


def test_samples_without_a_year(spark):
    counted = spark.createDataFrame([(1, y, v, n) for y in (1, 2, 3) for v, n in ((5.0, y), (None, 1), (10.0 + y, 2))] + [(2, 1, 7.0, 4)], "g int, year int, value double, copies long")
    years = spark.createDataFrame([(1, 2), (1, 9), (2, 1)], "g int, issue_year int")
    got = {(r["g"], r["issue_year"], r["value"]): r["copies"] for r in without_own_year(counted, years, ["g"], "issue_year").collect()}
    assert got == {(1, 2, 5.0): 4, (1, 2, None): 2, (1, 2, 11.0): 2, (1, 2, 13.0): 2, (1, 9, 5.0): 6, (1, 9, None): 3, (1, 9, 11.0): 2, (1, 9, 12.0): 2, (1, 9, 13.0): 2}


def test_bucketed_tables_are_joined_where_they_lie(spark):
    df = days(spark).withColumn("cell", F.hash("lat", "lon"))
    for name in ("one", "two"):
        sink.write_buckets(df, f"bucketed_{name}", ["cell"], 3, ["valid_date"], scratch_path(spark, f"bucketed-{name}"))
    one, two = spark.table("bucketed_one"), spark.table("bucketed_two")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = one.join(two.groupBy("cell").agg(F.max("value").alias("top")), "cell").groupBy("cell").agg(F.count("*").alias("n"), F.max("top").alias("top"))
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.agg(F.sum("n")).first()[0] == df.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("one", "two"):
            spark.sql(f"drop table bucketed_{name}")
