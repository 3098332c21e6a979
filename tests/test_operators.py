import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from caelum.config import DOMAINS, Domain
from caelum.operators import categories as cat
from caelum.operators import quantiles, regrid, reshape, windows
from caelum.operators.ensemble import ensemble_statistics
from caelum.plans import preparation as prep
from caelum.sources import scan, sink


def test_deinterleave_and_deaccumulate(spark):
    raw = spark.createDataFrame([(p,) for p in range(8)], "pos bigint")
    got = [(r["ens"], r["lead"]) for r in reshape.deinterleave(raw, 2).orderBy("pos").collect()]
    assert got == [(p % 2, p // 2) for p in range(8)]
    total = spark.createDataFrame([(1, 0, 1.0), (1, 1, 3.0), (1, 2, 3.0), (1, 3, 6.0), (2, 0, 5.0), (2, 1, None), (2, 2, 7.0)], "s int, lead int, value double")
    steps = reshape.deaccumulate(total, ["s"]).orderBy("s", "lead").collect()
    assert [r["value"] for r in steps] == [1, 2, 0, 3, 5, None, None]


def test_axis_length():
    box = DOMAINS["ceara"].bbox
    assert regrid.axis_length(box[2], box[3], 0.1) == 53
    assert regrid.axis_length(box[2], box[3], 0.1, snap=True) == 54
    west = DOMAINS["west_africa"].bbox
    assert (regrid.axis_length(west[2], west[3], 0.1), regrid.axis_length(west[0], west[1], 0.1)) == (217, 298)


def test_regrid_plane(spark):
    """A plane is reproduced exactly; a missing corner only affects the targets that need it."""
    src = [(i, j, t, 2.0 * i + 3.0 * 2 * j + t) for i in range(4) for j in range(4) for t in (0, 100) if (i, j, t) != (3, 3, 100)]
    source = spark.createDataFrame(src, "lat_idx int, lon_idx int, t int, value double")
    target = regrid.target_grid(spark, (0, 6, 0, 3), 0.5)
    rows = regrid.regrid_bilinear(source, target, regrid.Axes(0, 1, 0, 2), ["t"]).collect()
    assert len(rows) == 2 * 7 * 13
    for r in rows:
        if r["t"] == 100 and r["lat"] > 2 and r["lon"] > 4:
            assert r["value"] is None
        else:
            assert r["value"] == pytest.approx(2 * r["lat"] + 3 * r["lon"] + r["t"])


def test_regrid_beyond_the_source(spark):
    """Every field gets every target, NULL where its corners are missing."""
    source = spark.createDataFrame([(i, j, t, float(i + 10 * j)) for i in range(3) for j in range(3) for t in (0, 1)] + [(0, 0, 2, 5.0)], "lat_idx int, lon_idx int, t int, value double")
    target = regrid.target_grid(spark, (-3, 7, -3, 7), 1.0)
    rows = {(r["t"], r["lat"], r["lon"]): r["value"] for r in regrid.regrid_bilinear(source, target, regrid.Axes(0, 1, 0, 1), ["t"]).collect()}
    assert len(rows) == 3 * 121
    for (t, lat, lon), v in rows.items():
        inside = 0 <= lat <= 2 and 0 <= lon <= 2
        want = (5.0 if (lat, lon) == (0, 0) else None) if t == 2 else lat + 10 * lon if inside else None
        assert v == want, (t, lat, lon, v)
    assert regrid.regrid_bilinear(source.limit(0), target, regrid.Axes(0, 1, 0, 1), ["t"]).count() == 0


def plain_bilinear(values, lats, lons, ring, lat, lon):
    """By looking at every box: values[i][j] at lats[i], lons[j]."""
    columns = [*range(len(lons)), 0] if ring else [*range(len(lons))]
    around = [*lons, lons[0] + (360 if lons[-1] >= lons[0] else -360)] if ring else list(lons)
    for turn in (-720, -360, 0, 360, 720) if ring else (0,):
        for j in range(len(around) - 1):
            for i in range(len(lats) - 1):
                fy, fx = (lat - lats[i]) / (lats[i + 1] - lats[i]), (lon + turn - around[j]) / (around[j + 1] - around[j])
                if 0 <= fy <= 1 and 0 <= fx <= 1:
                    corners = [(fy if a else 1 - fy) * (fx if b else 1 - fx) for a in (0, 1) for b in (0, 1)]
                    own = [values[i + a][columns[j + b]] for a in (0, 1) for b in (0, 1)]
                    return None if any(w > 0 and v is None for w, v in zip(corners, own)) else sum(w * v for w, v in zip(corners, own) if w > 0)
    return None


@pytest.mark.parametrize("falling", [False, True])
@pytest.mark.parametrize("ring", [False, True])
def test_regrid_irregular_axes(spark, ring, falling):
    lats = (-77.3, -40.1, -3.0, 10.5, 62.0, 80.25)
    lats = lats[::-1] if falling else lats
    lons = (-170.0, -90.5, -3.25, 60.0, 121.0)
    rng = random.Random(8)
    values = [[rng.random() * 100 for _ in lons] for _ in lats]
    values[2][1] = None
    src = [(lats[i], lons[j] + 360 * rng.choice([0, 1]) * ring, "a", values[i][j]) for i in range(len(lats)) for j in range(len(lons))]
    src += [(lats[0] + 1.0, lons[0], "a", 1e9)]  # not on the axes
    target = [(lat, lon) for lat in (*lats, -90.0, -50.0, 0.0, 11.0, 79.0, 90.0) for lon in (*lons, -180.0, 180.0, 359.0, 150.0, 0.0, -100.0, 121.5)]
    grid = spark.createDataFrame([(k, 0, float(a), float(b)) for k, (a, b) in enumerate(target)], "lat_idx int, lon_idx int, lat double, lon double")
    axes = regrid.Coordinates(lats, lons, ring)
    frame = spark.createDataFrame(src, "lat double, lon double, t string, value double")
    source = frame.select(axes.lat_index().alias("lat_idx"), axes.lon_index().alias("lon_idx"), "t", "value").where("lat_idx is not null")
    rows = regrid.regrid_bilinear(source, grid, axes, ["t"]).collect()
    assert len(rows) == len(target)
    for r in rows:
        want = plain_bilinear(values, lats, lons, ring, r["lat"], r["lon"])
        assert r["value"] == (None if want is None else pytest.approx(want)), (r["lat"], r["lon"])


def test_regrid_round_the_globe(spark):
    """No target between the outermost latitudes is missing; a turn on the field is the same."""
    src = [(i, j, "f", float(i * 10 + (j - 4) ** 2)) for i in range(3) for j in range(9)]
    source = spark.createDataFrame(src, "lat_idx int, lon_idx int, t string, value double")
    axes = regrid.Axes(-10, 10, -180, 40, ring=9)
    near = regrid.regrid_bilinear(source, regrid.target_grid(spark, (-180, 175, -10, 10), 5.0), axes, ["t"]).collect()
    far = regrid.regrid_bilinear(source, regrid.target_grid(spark, (180, 535, -10, 10), 5.0), axes, ["t"]).collect()
    assert len(near) == 72 * 5 and all(r["value"] is not None for r in near)
    key = lambda rows: {(r["lat"], r["lon"] % 360): round(r["value"], 9) for r in rows}
    assert key(near) == key(far)
    plane = spark.createDataFrame([(-10.0 + 7.5 * i * i, 2.0 * j * j, "p", 3.0 * (-10 + 7.5 * i * i) - 2.0 * j * j) for i in range(4) for j in range(5)], "lat double, lon double, t string, value double")
    own = regrid.coordinates_of(plane, falling_lats=True)
    placed = plane.select(own.lat_index().alias("lat_idx"), own.lon_index().alias("lon_idx"), "t", "value")
    for r in regrid.regrid_bilinear(placed, regrid.target_grid(spark, (0, 32, -10, 57), 1.0), own, ["t"]).collect():
        assert r["value"] == pytest.approx(3 * r["lat"] - r["lon"])
    for wrong in (lambda: regrid.Axes(0, 1, 0, 40, ring=8), lambda: regrid.Coordinates((1.0, 3.0, 2.0), (0.0,)), lambda: regrid.Coordinates((0.0,), (0.0, 360.0), True)):
        with pytest.raises(ValueError):
            wrong()


def test_slices_follow_the_values(spark):
    """One far outlier moves no cut: no slice holds twice the mean."""
    df = spark.range(1_000_000).select(F.lit(1).alias("g"), (280 + F.col("id") / 1e5).alias("x")).union(spark.range(1).select(F.lit(1), F.lit(-9999.0)))
    sizes = [r[1] for r in quantiles.sliced(df, ["g"], "x", 10_000).groupBy("slice").count().collect()]
    mean = sum(sizes) / len(sizes)
    assert sum(sizes) == 1_000_001 and len(sizes) > 80 and max(sizes) < 2 * mean


def test_calendar_ring(spark):
    """Day 5 with 15 days around it reaches into the old year, at its own length."""
    days = [dt.date(y, 1, 1) + dt.timedelta(days=k) for y in (1995, 1996) for k in range(366) if (dt.date(y, 1, 1) + dt.timedelta(days=k)).year == y]
    obs = spark.createDataFrame([(1, d, float(d.year * 1000 + d.timetuple().tm_yday)) for d in days], "cell int, valid_date date, value double")
    targets = spark.createDataFrame([(1, 0, 5), (1, 1, 366)], "cell int, lead int, day int")
    pools = {r["lead"]: set(r["obs"]) for r in windows.calendar_pool(obs, targets, ["cell"], ["lead"]).collect()}
    normal, leap = [*range(355, 366), *range(1, 21)], [*range(356, 367), *range(1, 21)]
    assert pools[0] == {1995000.0 + d for d in normal} | {1996000.0 + d for d in leap}
    ring = lambda n: {(366 + s - 1) % n + 1 for s in range(-15, 16)}
    assert pools[1] == {1995000.0 + d for d in ring(365)} | {1996000.0 + d for d in ring(366)}
    fixed = windows.calendar_pool(obs, targets.where("lead = 0"), ["cell"], ["lead"], ring=365, shift=1).first()["obs"]
    assert {v % 1000 for v in fixed} == {(5 + s + 365) % 365 + 1 for s in range(-15, 16)}


def test_lead_window(spark):
    mdl = spark.createDataFrame([(1, k, float(k)) for k in range(0, 60) if k != 3], "cell int, lead int, value double")
    targets = spark.createDataFrame([(1, 3)], "cell int, lead int")
    row = windows.hindcast_pool(mdl, targets, ["cell"]).first()
    assert row["mdl"] == [float(k) for k in range(0, 19) if k != 3] and row["mdl_missing"] == 0


def test_sliced_quantiles(spark):
    """Value slices give numpy's quantiles, ties and missing values included."""
    rnd = random.Random(2)
    data = {1: [rnd.gauss(0, 1) for _ in range(501)], 2: [float(rnd.randint(0, 5)) for _ in range(400)], 3: [7.0], 4: [10.0 ** rnd.uniform(-3, 6) for _ in range(333)]}
    rows = [(g, v) for g, vs in data.items() for v in vs] + [(1, None), (5, None)]
    df = spark.createDataFrame(rows, "g int, value double")
    wanted = {"a": (0.33, "linear"), "b": (0.5, "linear"), "c": (0.25, "midpoint"), "d": (0.9, "midpoint")}
    for hot in (None, 0, 350):
        got = {r["g"]: r for r in quantiles.group_quantiles(df, ["g"], "value", wanted, hot is None, slice_rows=20).collect()}
        assert len(got) == 5 and got[5]["a"] is None
        for g, vs in data.items():
            for name, (p, method) in wanted.items():
                assert got[g][name] == pytest.approx(np.quantile(vs, p, method=method), rel=1e-12), (hot, g, name)


def test_positions(spark):
    rnd = random.Random(4)
    values = [round(rnd.expovariate(0.01), 1) for _ in range(900)] + [0.0] * 500
    df = spark.createDataFrame([(1, v) for v in values], "g int, value double")
    rows = quantiles.positions(df, ["g"], slice_rows=30).orderBy("x").collect()
    ordered = sorted(values)
    for r, after in zip(rows, [*rows[1:], None]):
        assert set(ordered[r["start"] : r["stop"]]) == {r["x"]}
        assert r["next_x"] == (after["x"] if after else None)
    assert rows[-1]["stop"] == 1400 == rows[0]["m"]


def category_row(spark, counts, product):
    cols = cat.count_columns(product)
    return spark.createDataFrame([tuple(float(c) for c in counts)], ", ".join(f"{c} double" for c in cols)), [F.col(c) for c in cols]


@pytest.mark.parametrize(
    "counts,product,want",
    [
        ((40, 40, 20), "tercile", 1.4),
        ((0, 0, 100), "tercile", 3.9999),
        ((25, 25, 25, 25, 0), "quintile", -0.5),
        ((35, 33, 32), "tercile", -0.5),
        ((10, 20), "extreme", 2.2),
    ],
)
def test_encoded_category(spark, counts, product, want):
    df, cols = category_row(spark, counts, product)
    assert df.select(cat.encode_category(cat.best_category(cols), product)).first()[0] == pytest.approx(want)


def test_low_skill_and_dry(spark):
    df, cols = category_row(spark, (34, 33, 33), "tercile")
    best = cat.best_category(cols)
    assert df.select(cat.encode_category(best, "tercile")).first()[0] == pytest.approx(1.34)
    assert df.select(cat.encode_category(best, "tercile", "below")).first()[0] == -0.5
    assert df.select(cat.encode_category(best, "tercile", wet_limit=F.lit(0.5))).first()[0] == -0.5
    assert df.select(cat.encode_category(best, "tercile", wet_limit=F.lit(None).cast("double"))).first()[0] == pytest.approx(1.34)


def test_tercile_upper_class(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v double").select("v", F.lit(2.0).alias("q33"), F.lit(3.0).alias("q66"))
    assert [r[0] for r in df.select(cat.member_class(F.col("v"), "tercile")).collect()] == [1, 2, 3, None]


def test_ensemble_statistics(spark):
    rnd = random.Random(8)
    data = {g: [rnd.gauss(0, 5) for _ in range(n)] for g, n in ((1, 25), (2, 51), (3, 2))}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g int, value double")
    for hot in (None, 30):
        for r in ensemble_statistics(df, ["g"], hot).collect():
            v = np.array(data[r["g"]])
            iqr = np.quantile(v, 0.75, method="midpoint") - np.quantile(v, 0.25, method="midpoint")
            assert r["iqr"] == pytest.approx(iqr) and r["median"] == pytest.approx(np.median(v))
            assert r["std"] == pytest.approx(v.std()) and r["spread"] == pytest.approx(np.ptp(v))


def test_preparation_chain(spark):
    """Raw accumulated rain to the target grid: the field is a plane, so every step is known."""
    members, leads = 3, 4
    rows = []
    for lat in range(0, 5):
        for lon in (356, 358, 0, 2, 4):
            x = (lon + 180) % 360 - 180
            for pos in range(members * leads):
                lead = pos // members
                # metres, growing by the same plane every day
                rows.append(("var228", dt.date(2000, 3, 1), pos, float(lat), float(lon), (lead + 1) * (lat + x / 10 + 10) / 1000))
    raw = spark.createDataFrame(rows, "variable string, issue_date date, pos bigint, lat double, lon double, value double")
    domain = Domain("d", (-2.0, 2.0, 1.0, 3.0), ("tp",), res=0.5)
    daily = prep.raw_to_daily(raw, members)
    fine = prep.to_target_grid(prep.cut_out(daily, domain, 2.0), domain, regrid.Axes(-1, 1, -4, 2), ["variable", "issue_date", "valid_date", "lead", "ens"])
    got = fine.collect()
    assert len(got) == members * leads * 5 * 9
    assert all(r["value"] == pytest.approx(r["lat"] + r["lon"] / 10 + 10) for r in got)
    assert {(r["lead"], r["valid_date"]) for r in got} == {(k, dt.date(2000, 3, 1 + k)) for k in range(leads)}


def test_ranges_round_trip(spark):
    rows = [(1, "t2m", 10.0), (1, "t2max", 15.0), (1, "t2min", 4.0), (2, "t2m", 8.0)]
    df = spark.createDataFrame(rows, "k int, variable string, value double")
    there = prep.add_ranges(df, ["k"])
    values = {(r["k"], r["variable"]): r["value"] for r in there.collect()}
    assert values[1, "t2plus"] == 5 and values[1, "t2minus"] == 6 and values[2, "t2plus"] is None
    back = {(r["k"], r["variable"]): r["value"] for r in prep.remove_ranges(there, ["k"]).collect()}
    assert back[1, "t2max"] == 15 and back[1, "t2min"] == 4


def test_renames(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "longitude double, latitude double, var55 double")
    assert reshape.rename_columns(df).columns == ["lon", "lat", "t2m"]
    assert reshape.drop_auxiliary(df.withColumn("time_bnds", F.lit(1))).columns == df.columns


def test_rewrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(y, k, float(k)) for y in (2000, 2001) for k in range(5)], "year int, k int, value double")
    sink.write_partitions(df, path, ["year"], ["k"])
    sink.write_partitions(df.where("year = 2001").withColumn("value", F.col("value") + 1), path, ["year"], ["k"])
    got = {(r["year"], r["k"]): r["value"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 10 and got[2000, 3] == 3 and got[2001, 3] == 4
    pruned = scan.scan_store(spark, path, years="2001")
    assert pruned.count() == 5
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    sink.write_partitions(df.where("year = 2000"), path, ["year"], replace_all=True)
    assert [r["year"] for r in spark.read.parquet(path).select("year").distinct().collect()] == [2000]


def test_member_files(spark, tmp_path):
    for member in (0, 1, 11):
        spark.range(3).coalesce(1).write.parquet(str(tmp_path / f"run_{member:02d}.parquet"))
    df = scan.scan_members(spark, str(tmp_path / "run_*.parquet"), r"run_(\d+)\.parquet")
    assert sorted((r["ens"], r["id"]) for r in df.collect()) == [(m, k) for m in (0, 1, 11) for k in range(3)]


def test_labels():
    assert sink.period_label(1981, 2016, 1981, 2016) == "calib"
    assert sink.period_label(2017, 2020, 1981, 2016) == "2017_2020"


def test_cross_validation_years(spark):
    """A predicted year keeps the other years' values, missing ones counted apart."""
    df = spark.createDataFrame([([(y, float(-y)) for y in range(2000, 2004)] + [(2001, None), (2002, None)], 2001)], "pool array<struct<year:int,value:double>>, y int")
    row = df.select(windows.other_years("pool", "y").alias("v"), windows.other_years_missing("pool", "y").alias("n")).first()
    assert row["v"] == [-2003.0, -2002.0, -2000.0] and row["n"] == 1

