"""Every operator as a query over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caelum.config import LEADS, RAW_MEMBERS, VARIABLES, CorrectionParams, Domain
from caelum.functions import calendar as cal
from caelum.functions import codec, fields
from caelum.functions import sorted_arrays as sa
from caelum.operators import categories as cat
from caelum.operators import ensemble, mapping, monthly, quantiles, regrid, reshape, windows
from caelum.plans import bias_correction as bc
from caelum.plans import preparation as prep
from caelum.plans import products
from caelum.plans.evaluation import evaluate, member_counts
from caelum.session import scratch_path
from caelum.sources import scan, sink
from catalogue import views as V

NQ = 100
PRICE = CorrectionParams(nquants=NQ, dry_thresh=0.1)
RAIN = CorrectionParams(nquants=NQ, dry_thresh=0.1)
MEMBERS = 7
FIRST_YEAR = 1995
STEP = ["issue_year", "issue_month", "lead", "ens"]
WINDOW = ["issue_month", "lead"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def out(col: Column | str) -> Column:
    """Four decimals. The tiny shift keeps exact halves from depending on summation order."""
    return F.round((F.col(col) if isinstance(col, str) else col) + 5e-9, 4)


def _price_views(spark, d):
    lines = V.shipped(spark, d)
    return V.pred(spark, d, lines), V.obs(spark, d, lines), V.mdl(spark, d, lines)


def _rain_views(spark, d):
    rain = V.rain(spark, d)
    pick = lambda role: rain.where(F.col("role") == role)
    draw = F.pmod(
        F.col("cell") * 7919 + F.col("lead") * 10473 + F.col("event_id") * 1299, F.lit(10007)
    ) / F.lit(10007.0)
    pred = pick("pred").select("cell", "event_id", "lead", "value", draw.alias("draw"))
    return (
        pred,
        pick("obs").select("cell", "value"),
        pick("mdl").select("cell", "value"),
    )


# ------------------------------------------------------------------ quantile mapping


@query
def qmap_knots(spark, d):
    knots = mapping.sample_arrays(V.mdl(spark, d), ["cell"], "mdl").select(
        "cell", F.posexplode(F.expr(sa.knots("mdl", str(NQ)))).alias("i", "q")
    )
    return knots.select(
        "cell", (F.col("i") + 1).cast("int").alias("i"), out((F.col("i") + 1) / (NQ + 1)).alias("p"), out("q").alias("q")
    )


@query
def rank_space(spark, d):
    pred, obs, mdl = _price_views(spark, d)
    mapped = bc.map_groups(pred, obs, mdl, ["cell"], STEP, PRICE, bounded=True)
    return mapped.select("cell", *STEP, out("clamped").alias("clamped"), out("rank").alias("rank"))


@query
def qmap(spark, d):
    pred, obs, mdl = _price_views(spark, d)
    mapped = bc.map_groups(pred, obs, mdl, ["cell"], STEP, PRICE, bounded=True)
    return mapped.select("cell", *STEP, out("value").alias("value"), out("mapped").alias("mapped"))


@query
def qmap_events(spark, d):
    """Groups that grow with the table, in value slices."""
    pred, obs, mdl = _rain_views(spark, d)
    mapped = bc.map_groups(pred, obs, mdl, ["cell"], ["event_id"], RAIN)
    return mapped.select("cell", "event_id", out("rank").alias("rank"), out("mapped").alias("mapped"))


@query
def positions_events(spark, d):
    """Sorted positions of every distinct value of a cell, in value slices."""
    pos = quantiles.positions(V.rain(spark, d), ["cell"], "value")
    return pos.select("cell", out("x").alias("x"), "start", "stop", out("next_x").alias("next_x"), "m")


@query
def bc_guards(spark, d):
    """Users whose samples are missing, or too uniform, next to ordinary ones."""
    ev = V.table(spark, d, "events")
    coarse = F.floor(F.col("value") / (1 + F.col("user_id") % 12)).cast("double")
    value = F.when(F.col("user_id") % 10 != 0, coarse)
    rows = ev.select("user_id", "event_id", "event_type", value.alias("value"))
    obs = rows.where(F.col("event_type").isin("view", "click"))
    mdl = rows.where(F.col("event_type").isin("purchase", "signup"))
    pred = rows.where(F.col("event_type") == "error")
    res = bc.correct_groups(pred, obs, mdl, ["user_id"], ["event_id"], PRICE)
    return res.select("user_id", "event_id", "usable", "varied", out("corrected").alias("corrected"))


def _tail(rule: str):
    def run(spark, d):
        pred, obs, mdl = _price_views(spark, d)
        params = CorrectionParams(nquants=NQ, low_extrapol=rule, up_extrapol=rule)
        # hindcast values reach beyond the reference, so both ends are used
        res = bc.correct_groups(pred, obs, mdl, ["cell"], STEP, params, bounded=True)
        return res.select("cell", *STEP, out("corrected").alias("corrected"))

    return run


TAIL_QUERIES = {
    "tail_constant": "constant",
    "tail_delta_add": "delta_additive",
    "tail_delta_scale": "delta_scaling",
    "tail_normal": "distribution",
}
for _name, _rule in TAIL_QUERIES.items():
    QUERIES[_name] = _tail(_rule)


def _rain_corrected(spark, d, params):
    pred, obs, mdl = _rain_views(spark, d)
    res = bc.correct_groups(pred, obs, mdl, ["cell"], ["event_id"], params, precip=True)
    return res.select("cell", "event_id", "dry_obs", "dry_mdl", out("corrected").alias("corrected"))


@query
def tail_gumbel(spark, d):
    params = CorrectionParams(nquants=NQ, dry_thresh=0.1, up_extrapol="distribution", low_extrapol="distribution")
    return _rain_corrected(spark, d, params).select("cell", "event_id", "corrected")


@query
def tail_gumbel_cells(spark, d):
    """The same tail for groups that their key bounds, in one row each."""
    pred, obs, mdl = _price_views(spark, d)
    params = CorrectionParams(nquants=NQ, dry_thresh=0.1, up_extrapol="distribution", low_extrapol="distribution")
    res = bc.correct_groups(pred, obs, mdl, ["cell"], STEP, params, precip=True, bounded=True)
    return res.select("cell", *STEP, out("corrected").alias("corrected"))


@query
def dry_share(spark, d):
    """Dry-day probability of reference and hindcast as the mapping finds them."""
    pred, obs, mdl = _rain_views(spark, d)
    mapped = bc.map_groups(pred, obs, mdl, ["cell"], ["event_id"], RAIN)
    return mapped.groupBy("cell").agg(out(F.max("dry_obs")).alias("dry_obs"), out(F.max("dry_mdl")).alias("dry_mdl"))


@query
def dry_zero(spark, d):
    params = CorrectionParams(nquants=NQ, dry_thresh=0.1, intermittency=False)
    return _rain_corrected(spark, d, params).select("cell", "event_id", "corrected")


@query
def intermittency_dry(spark, d):
    res = _rain_corrected(spark, d, RAIN)
    return res.where("dry_obs >= dry_mdl").select("cell", "event_id", "corrected")


@query
def intermittency_wet(spark, d):
    res = _rain_corrected(spark, d, RAIN)
    return res.where("dry_obs < dry_mdl").select("cell", "event_id", "corrected")


# ------------------------------------------------------------------ calendar windows


def _targets(pred: DataFrame) -> DataFrame:
    """Lead days of the forecast, with their day of year in the first hindcast year."""
    day = windows.target_day(FIRST_YEAR, F.col("issue_month"), F.col("lead"))
    return pred.select("cell", *WINDOW).distinct().withColumn("day", day)


def _pool_summary(df: DataFrame, name: str) -> DataFrame:
    return df.select(
        "cell",
        *WINDOW,
        F.size(name).cast("bigint").alias("n"),
        out(F.expr(sa.total(name))).alias("total"),
        out(F.get(name, F.lit(0))).alias("lowest"),
    )


@query
def obs_window(spark, d):
    targets = _targets(V.pred(spark, d))
    return _pool_summary(windows.calendar_pool(V.obs(spark, d), targets, ["cell"], WINDOW), "obs")


@query
def mdl_window(spark, d):
    targets = _targets(V.pred(spark, d))
    return _pool_summary(windows.hindcast_pool(V.mdl(spark, d), targets, ["cell", "issue_month"]), "mdl")


def _dated(mdl: DataFrame) -> DataFrame:
    date = cal.hindcast_date(F.col("issue_year"), F.col("issue_month"), F.col("lead"))
    return mdl.withColumn("valid_date", date)


@query
def mdl_ring_window(spark, d):
    """Hindcast days by the calendar rule, around the forecast's own days."""
    day = windows.target_day(2000, F.col("issue_month"), F.col("lead"))
    targets = V.pred(spark, d).select("cell", *WINDOW).distinct().withColumn("day", day)
    pooled = windows.calendar_pool(_dated(V.mdl(spark, d)), targets, ["cell"], WINDOW, name="mdl")
    return _pool_summary(pooled, "mdl")


@query
def fixed_ring_window(spark, d):
    targets = _targets(V.pred(spark, d))
    pooled = windows.calendar_pool(V.obs(spark, d), targets, ["cell"], WINDOW, ring=365, shift=1)
    return _pool_summary(pooled, "obs")


def _bias_corrected(spark, d, bounded=True):
    pred, obs, mdl = _price_views(spark, d)
    return bc.bias_correct(pred, obs, mdl, ["cell"], ["issue_year", "ens"], FIRST_YEAR, PRICE, bounded=bounded)


def _ranked_and_corrected(df: DataFrame) -> DataFrame:
    return df.select("cell", *STEP, out("rank").alias("rank"), out("corrected").alias("corrected"))


@query
def bcsd_full(spark, d):
    return _ranked_and_corrected(_bias_corrected(spark, d))


@query
def bcsd_full_rows(spark, d):
    """The same for cells of any size."""
    return _ranked_and_corrected(_bias_corrected(spark, d, bounded=False))


@query
def bcsd_crossval(spark, d):
    """Every hindcast year corrected with that year left out of both samples."""
    lines = V.shipped(spark, d)
    mdl = V.mdl(spark, d, lines)
    res = bc.bias_correct(
        mdl, V.obs(spark, d, lines), mdl, ["cell"], ["issue_year", "ens"], FIRST_YEAR, PRICE, crossval=True, bounded=True
    )
    return res.select("cell", *STEP, out("corrected").alias("corrected"))


@query
def bcsd_crossval_rows(spark, d):
    """The same for cells of any size: samples without a year are differences of counts."""
    lines = V.shipped(spark, d)
    mdl = V.mdl(spark, d, lines)
    res = bc.bias_correct(mdl, V.obs(spark, d, lines), mdl, ["cell"], ["issue_year", "ens"], FIRST_YEAR, PRICE, crossval=True)
    return res.select("cell", *STEP, out("corrected").alias("corrected"))


# ------------------------------------------------------------------ monthly products


def _issued(df: DataFrame) -> DataFrame:
    issue = F.make_date(F.col("issue_year"), F.col("issue_month"), F.lit(1))
    return df.withColumn("issue_date", issue).withColumn(
        "valid_date", cal.valid_date(issue, F.col("lead"))
    )


def _monthly_members(spark, d, source=V.mdl):
    return monthly.monthly_mean(_issued(source(spark, d)), ["cell", "issue_date", "ens"])


def _monthly_ref(spark, d):
    return monthly.monthly_mean(V.obs(spark, d), ["cell"])


@query
def monthly_mean_ens(spark, d):
    return _monthly_members(spark, d).withColumn("value", out("value"))


@query
def monthly_mean_ref(spark, d):
    return _monthly_ref(spark, d).withColumn("value", out("value"))


@query
def monthly_mean_corrected(spark, d):
    res = _bias_corrected(spark, d).select("cell", *STEP, F.col("corrected").alias("value"))
    return monthly.monthly_mean(_issued(res), ["cell", "issue_date", "ens"]).withColumn("value", out("value"))


@query
def monthly_series(spark, d):
    # issues of October go on into the next year
    series = monthly.monthly_series(_issued(V.mdl(spark, d)), ["cell", "issue_date", "ens"], 5)
    return series.withColumn("value", out("value"))


@query
def clim_ref(spark, d):
    return monthly.reference_climatology(V.obs(spark, d), ["cell"]).withColumn("value", out("value"))


@query
def clim_fcst(spark, d):
    return monthly.forecast_climatology(_issued(V.mdl(spark, d)), ["cell"]).withColumn("value", out("value"))


def _rounded_thresholds(df: DataFrame) -> DataFrame:
    keys = [c for c in ("cell", "issue_month", "month") if c in df.columns]
    return df.select(*keys, *[out(c).alias(c) for c in df.columns if c.startswith("q")])


@query
def thresholds_ref(spark, d):
    return _rounded_thresholds(monthly.monthly_thresholds(_monthly_ref(spark, d), ["cell"]))


@query
def thresholds_fcst(spark, d):
    """Kept apart by issue month."""
    months = _monthly_members(spark, d).withColumn("issue_month", F.month("issue_date"))
    return _rounded_thresholds(monthly.monthly_thresholds(months, ["cell", "issue_month"]))


@query
def thresholds_corrected(spark, d):
    res = _bias_corrected(spark, d).select("cell", *STEP, F.col("corrected").alias("value"))
    months = monthly.monthly_mean(_issued(res), ["cell", "issue_date", "ens"])
    return _rounded_thresholds(monthly.monthly_thresholds(months, ["cell"]))


@query
def thresholds_events(spark, d):
    """Thresholds over groups that grow with the table."""
    rows = V.rain(spark, d).select("cell", "value", F.make_date(F.lit(2024), F.col("cell") % 3 + 1, F.lit(1)).alias("month_start"))
    return _rounded_thresholds(monthly.monthly_thresholds(rows, ["cell"], bounded=False))


# ------------------------------------------------------------------ ensemble and categories


@query
def ens_stats(spark, d):
    stats = ensemble.ensemble_statistics(_monthly_members(spark, d, V.pred), ["cell", "month_start"])
    return stats.select("cell", "month_start", *[out(c).alias(c) for c in ("mean", "median", "std", "iqr", "spread")])


@query
def ens_stats_daily(spark, d):
    stats = ensemble.ensemble_statistics(V.pred(spark, d), ["cell", *STEP[:3]])
    return stats.select("cell", *STEP[:3], *[out(c).alias(c) for c in ("mean", "median", "std", "iqr", "spread")])


def _with_clim(spark, d):
    months = _monthly_members(spark, d, V.pred)
    means = months.groupBy("cell", "month_start").agg(F.avg("value").alias("mean"), F.percentile("value", 0.5).alias("median"))
    clim = monthly.reference_climatology(V.obs(spark, d), ["cell"]).withColumnRenamed("value", "clim")
    return means.withColumn("month", F.month("month_start")).join(clim, ["cell", "month"])


@query
def anomaly(spark, d):
    df = _with_clim(spark, d)
    return df.select("cell", "month_start", out(ensemble.anomaly(F.col("mean"), F.col("clim"))).alias("anomaly"))


@query
def anomaly_rel(spark, d):
    df = _with_clim(spark, d)
    rel = lambda c: out(ensemble.relative_anomaly(F.col(c), F.col("clim")))
    return df.select("cell", "month_start", rel("mean").alias("mean_rel"), rel("median").alias("median_rel"))


def _counts(spark, d, unit: Column | None = None):
    """Monthly members and thresholds, and the members per category."""
    months, ref = _monthly_members(spark, d, V.pred), _monthly_ref(spark, d)
    if unit is not None:
        months = months.withColumn("value", F.col("value") / unit)
        ref = ref.withColumn("value", F.col("value") / unit)
    limits = monthly.monthly_thresholds(ref, ["cell"])
    return months, member_counts(months, limits, ["cell"], ["issue_date"])


def _category_counts(product: str):
    def run(spark, d):
        _, counts = _counts(spark, d)
        long = cat.categories_long(counts, ["cell", "month_start"], product)
        return long.withColumn("members", F.col("members").cast("bigint"))

    return run


for _product in ("extreme", "quintile", "tercile"):
    QUERIES[f"cat_{_product}"] = _category_counts(_product)


def _best(counts: DataFrame, product: str, present: Column | None = None) -> Column:
    return cat.best_category(
        [cat.probability(F.col(c), F.lit(MEMBERS), present) for c in cat.count_columns(product)]
    )


@query
def cat_best(spark, d):
    _, counts = _counts(spark, d)
    columns = []
    for p in ("tercile", "quintile", "extreme"):
        best = _best(counts, p)
        columns += [out(best["prob"]).alias(f"{p}_prob"), best["category"].alias(f"{p}_category")]
    return counts.select("cell", "month_start", *columns)


@query
def cat_encoded(spark, d):
    _, counts = _counts(spark, d)
    codes = [
        out(cat.encode_category(_best(counts, p), p, sentinel)).alias(f"{p}_{sentinel}")
        for p in ("tercile", "quintile", "extreme")
        for sentinel in ("equal", "below")
    ]
    return counts.select("cell", "month_start", *codes)


def _dry_unit() -> Column:
    return 20000.0 * (1 + F.col("cell") % 5)


@query
def cat_sentinel(spark, d):
    """Twenty members, of which exactly a quarter or seven can make up the largest category."""
    lines = V.shipped_orders(spark, d)
    value = F.max("l_extendedprice").alias("value")
    months = lines.groupBy("cell", "month_start", (F.col("l_orderkey") % 20).alias("ens")).agg(value).withColumn("issue_date", F.col("month_start"))
    counts = member_counts(months, monthly.monthly_thresholds(_monthly_ref(spark, d), ["cell"]), ["cell"], ["issue_date"])
    code = lambda p, s: cat.encode_category(cat.best_category([cat.probability(F.col(c), F.lit(20)) for c in cat.count_columns(p)]), p, s)
    names = [(p, s) for p in ("tercile", "quintile") for s in ("equal", "below")]
    return counts.select("cell", "month_start", *[out(code(p, s)).alias(f"{p}_{s}") for p, s in names])


@query
def cat_nominal(spark, d):
    """Probabilities by the ensemble size of the issue's year: 25 members until 2016, 51 from 2017 on."""
    _, counts = _counts(spark, d)
    issue = F.add_months("issue_date", F.when(F.col("cell") % 2 == 1, 17 * 12).otherwise(0))
    share = cat.probability(F.col("tercile_3"), cat.nominal_members(issue))
    return counts.select("cell", "month_start", issue.alias("issue_date"), out(share).alias("above"))


@query
def cat_masked(spark, d):
    """Dry cells undecided, cells without a first member masked."""
    months, counts = _counts(spark, d, _dry_unit())
    # the first member of every fourth cell is taken as missing
    gone = (F.col("cell") % 4 == 0) & F.month("month_start").isin(1, 4) & (F.col("ens") == 1)
    holed = months.withColumn("value", F.when(~gone, F.col("value")))
    mask = cat.first_present(holed, ["cell", "issue_date"])
    df = counts.join(mask, ["cell", "issue_date"])
    codes = [
        out(cat.encode_category(_best(df, p, F.col("present")), p, wet_limit=F.col("q90"))).alias(p)
        for p in ("tercile", "quintile", "extreme")
    ]
    return df.select("cell", "month_start", "present", *codes)


@query
def valid_cell_mask(spark, d):
    months = _monthly_members(spark, d).withColumn("value", F.when(F.col("cell") % 3 != 0, F.col("value")))
    return cat.first_present(months, ["cell", "issue_date"])


@query
def eval_product(spark, d):
    months = _monthly_members(spark, d, V.pred)
    limits = monthly.monthly_thresholds(_monthly_ref(spark, d), ["cell"])
    clim = monthly.reference_climatology(V.obs(spark, d), ["cell"])
    return evaluate(months, clim, limits, ["cell"], ["issue_date"], MEMBERS)


@query
def eval_precip(spark, d):
    """Measures of precipitation: dry cells are undecided."""
    scaled = lambda df: df.withColumn("value", F.col("value") / _dry_unit())
    months, ref = scaled(_monthly_members(spark, d, V.pred)), scaled(_monthly_ref(spark, d))
    clim = monthly.reference_climatology(scaled(V.obs(spark, d)), ["cell"])
    return evaluate(months, clim, monthly.monthly_thresholds(ref, ["cell"]), ["cell"], ["issue_date"], MEMBERS, precip=True)


@query
def normals_store(spark, d):
    """Climatology and thresholds of a reference store, from one table of monthly sums."""
    placed = _placed_obs(spark, d).withColumn("variable", F.lit("tp"))
    clim, limits = products.normals(placed)
    both = clim.withColumnRenamed("value", "clim").join(limits, ["variable", "lat", "lon", "month"])
    return both.select("lat", "lon", "month", out("clim").alias("clim"), *[out(c).alias(c) for c in ("q20", "q33", "q90")])


# ------------------------------------------------------------------ raw fields


def _raw(spark, d):
    """Events as the raw axis: blocks of 215 days x 51 members."""
    block = LEADS * RAW_MEMBERS
    return V.table(spark, d, "events").select(
        F.floor(F.col("event_id") / block).cast("int").alias("issue"),
        (F.col("event_id") % block).alias("pos"),
        "value",
    )


@query
def deinterleave(spark, d):
    return reshape.deinterleave(_raw(spark, d)).withColumn("value", out("value"))


@query
def deaccumulate(spark, d):
    steps = reshape.deaccumulate(reshape.deinterleave(_raw(spark, d)), ["issue", "ens"])
    return steps.select("issue", "ens", "lead", out("value").alias("value"))


@query
def raw_to_daily(spark, d):
    """Interleaving, units, de-accumulation and dates of a raw table with several variables.

    Some values are missing in each way sources have, some rows have no variable, and some leads are absent.
    """
    block = LEADS * RAW_MEMBERS
    e = F.col("event_id")
    value = F.when(e % 101 == 0, F.lit(float("nan"))).when(e % 103 == 0, F.lit(None)).otherwise(F.col("value"))
    raw = V.table(spark, d, "events").where(e % 89 != 0).select(
        F.when(e % 97 == 0, F.lit(None)).when(e % 2 == 0, "var228").otherwise("var55").alias("variable"),
        F.add_months(F.lit("2000-01-01").cast("date"), F.floor(e / (2 * block)).cast("int")).alias("issue_date"),
        (F.floor(e / 2) % block).alias("pos"),
        F.lit(1.5).alias("lat"),
        (2.5 + e % 2).alias("lon"),
        value.alias("value"),
    )
    daily = prep.raw_to_daily(raw)
    return daily.select("variable", "issue_date", "ens", "lead", "lon", "valid_date", out("value").alias("value"))


@query
def prepare(spark, d):
    """Raw axis of a global field to daily values on the target grid."""
    at, e = F.col("event_id") % 25, F.floor(F.col("event_id") / 25)
    block = LEADS * RAW_MEMBERS
    raw = V.table(spark, d, "events").select(
        F.lit("var228").alias("variable"),
        F.add_months(F.lit("2000-01-01").cast("date"), F.floor(e / block).cast("int")).alias("issue_date"),
        (e % block).alias("pos"),
        (10.0 + F.floor(at / 5)).alias("lat"),
        (352.0 + 4 * (at % 5)).alias("lon"),
        "value",
    )
    box = Domain("box", (-5.0, 9.0, 11.0, 15.0), ("tp",), res=1.0)
    daily = prep.raw_to_daily(prep.cut_out(raw, box, halo=3.0))
    res = prep.to_target_grid(daily, box, regrid.Axes(10.0, 1.0, -8.0, 4.0), ["issue_date", "ens", "lead"])
    return res.select("lat", "lon", "issue_date", "ens", "lead", out("value").alias("value"))


@query
def drop_auxiliary(spark, d):
    lines = _lines(spark, d).select("l_orderkey", "l_linenumber", F.col("l_tax").alias("time_bnds"), F.col("l_discount").alias("bnds"), "l_quantity")
    return reshape.drop_auxiliary(lines)


@query
def lon_wrap(spark, d):
    return V.grid(spark, d).select("lat_idx", "lon_idx", fields.wrap_longitude(F.col("lon")).alias("lon"))


@query
def bbox_halo(spark, d):
    box = Domain("box", (-3.0, 3.0, 11.0, 12.0), ("tp",))
    cut = prep.cut_out(V.grid(spark, d), box)
    return cut.select("lat_idx", "lon_idx", "lat", "lon", out("value").alias("value"))


def _lines(spark, d):
    return V.table(spark, d, "lineitem")


KINDS = ("tp", "t2m", "ssrd")


def _kind() -> Column:
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("l_linenumber") % 3 + 1).cast("int"))


@query
def units(spark, d):
    value = fields.convert_units(_kind(), F.col("l_extendedprice"))
    return _lines(spark, d).select("l_orderkey", "l_linenumber", _kind().alias("variable"), out(value).alias("value"))


@query
def rename_variables(spark, d):
    names = ["var228", "var55", "var52", "var51", "var169", "mean2t24", "rh"]
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("l_linenumber"))
    return _lines(spark, d).groupBy(reshape.rename_variables(name).alias("variable")).agg(F.count("*").alias("n"))


def _temperatures(spark, d):
    t = 250.0 + F.col("l_quantity")
    return _lines(spark, d).select(
        "l_orderkey", "l_linenumber", t.alias("t2m"), (t + 100 * F.col("l_discount")).alias("t2max"), (t - 100 * F.col("l_tax")).alias("t2min")
    )


@query
def ranges(spark, d):
    plus = fields.range_above(F.col("t2max"), F.col("t2m"))
    minus = fields.range_below(F.col("t2m"), F.col("t2min"))
    return _temperatures(spark, d).select("l_orderkey", "l_linenumber", out(plus).alias("t2plus"), out(minus).alias("t2minus"))


@query
def ranges_inverse(spark, d):
    df = _temperatures(spark, d).select("l_orderkey", "l_linenumber", "t2m", (F.col("t2max") - F.col("t2m")).alias("p"), (F.col("t2m") - F.col("t2min")).alias("m"))
    upper = fields.upper_from_range(F.col("t2m"), F.col("p"))
    lower = fields.lower_from_range(F.col("t2m"), F.col("m"))
    return df.select("l_orderkey", "l_linenumber", out(upper).alias("t2max"), out(lower).alias("t2min"))


def _packable() -> Column:
    """Temperatures of which a tenth is missing."""
    return F.when(F.col("l_discount") < 0.095, 250.0 + F.col("l_quantity") + F.col("l_extendedprice") / 7777)


@query
def pack(spark, d):
    packed = codec.pack(_packable(), VARIABLES["t2m"])
    return _lines(spark, d).select("l_orderkey", "l_linenumber", packed.cast("int").alias("packed"))


@query
def unpack(spark, d):
    value = codec.unpack(codec.pack(_packable(), VARIABLES["t2m"]), VARIABLES["t2m"])
    return _lines(spark, d).select("l_orderkey", "l_linenumber", out(value).alias("value"))


@query
def missing(spark, d):
    """Fill values and NaN to NULL, seen through counts and means per line number."""
    raw = F.when(F.col("l_discount") < 0.02, F.lit(float("nan"))).when(F.col("l_tax") < 0.02, -9999.0).otherwise(F.col("l_quantity"))
    clean = _lines(spark, d).select("l_linenumber", codec.missing_to_null(raw, -9999).alias("v"))
    return clean.groupBy("l_linenumber").agg(F.count("v").alias("n"), out(F.avg("v")).alias("mean"), out(F.max("v")).alias("top"))


@query
def half_even(spark, d):
    x = F.col("l_quantity") / 4
    return _lines(spark, d).select(
        "l_orderkey", "l_linenumber", codec.half_even(x, 1).alias("one"), codec.half_even(x / 10, 2).alias("two")
    )


@query
def clamp(spark, d):
    v = codec.clamp(F.when(F.col("l_discount") > 0.01, F.col("l_quantity")), F.lit(10.0), F.lit(40.0))
    return _lines(spark, d).select("l_orderkey", "l_linenumber", v.alias("value"))


# ------------------------------------------------------------------ periods and dates


def _orders(spark, d):
    return V.table(spark, d, "orders").withColumn("date", F.col("o_orderdate").cast("date"))


@query
def period_filter(spark, d):
    keep = cal.in_period(F.year("date"), "1996,0,1998") & cal.in_period(F.month("date"), "2,5,11")
    return _orders(spark, d).where(keep).select("o_orderkey", "date")


@query
def eval_period(spark, d):
    df = _orders(spark, d)
    flags = [
        F.count_if(cal.within_evaluation(F.col("date"), text, 1996, 1997)).alias(name)
        for name, text in (("month", "1997,3"), ("years", "1995,1996"), ("calibration", None))
    ]
    return df.groupBy(F.year("date").alias("year")).agg(*flags)


@query
def month_set(spark, d):
    """Valid dates within the eight months of an issue; the issue month varies by customer."""
    issue = F.make_date(F.year("date"), (F.col("o_custkey") % 12 + 1).cast("int"), F.lit(1))
    df = _orders(spark, d).withColumn("issue", issue)
    kept = df.where(cal.in_month_set(F.col("date"), F.col("issue")))
    lead = cal.lead_month(F.col("date"), F.col("issue"))
    return kept.select("o_orderkey", F.month("issue").alias("issue_month"), lead.alias("lead_month"))


@query
def eval_months(spark, d):
    issue = F.make_date(F.year("date"), (F.col("o_custkey") % 12 + 1).cast("int"), F.lit(1))
    df = _orders(spark, d).withColumn("issue", issue)
    return df.groupBy(F.month("issue").alias("issue_month")).agg(
        F.count_if(cal.evaluation_months(F.col("date"))).alias("calendar"),
        F.count_if(cal.evaluation_months(F.col("date"), F.col("issue"))).alias("lead"),
    )


@query
def valid_date(spark, d):
    lead = F.col("o_custkey") % LEADS
    return _orders(spark, d).select("o_orderkey", lead.cast("int").alias("lead"), cal.valid_date(F.col("date"), lead).alias("valid_date"))


@query
def day_number(spark, d):
    n = cal.day_number(F.col("date"))
    return _orders(spark, d).select("o_orderkey", n.alias("n"), cal.from_day_number(n).alias("back"))


@query
def calendar_parts(spark, d):
    return _orders(spark, d).select(
        "o_orderkey",
        F.year("date").alias("y"),
        F.month("date").alias("m"),
        F.dayofyear("date").alias("doy"),
        cal.year_length(F.col("date")).alias("year_days"),
        cal.month_start(F.col("date")).alias("month_start"),
    )


@query
def flatten_5d(spark, d):
    df = _orders(spark, d).select(
        "o_orderkey", F.year("date").alias("year"), F.month("date").alias("month"), (F.col("o_custkey") % LEADS).alias("step")
    )
    return reshape.flatten_hindcast(df).select("o_orderkey", "valid_date")


# ------------------------------------------------------------------ variables and grids

WIDE = ["t2m", "t2max", "t2min"]


def _long_lines(spark, d):
    """One value per order and variable; an order has only some of the three."""
    name = F.element_at(F.array(*[F.lit(k) for k in WIDE]), (F.col("l_linenumber") % 3 + 1).cast("int"))
    return _lines(spark, d).groupBy("l_orderkey", name.alias("variable")).agg(F.max("l_quantity").alias("value"))


@query
def pivot_vars(spark, d):
    return reshape.variables_to_columns(_long_lines(spark, d), ["l_orderkey"], WIDE)


@query
def unpivot_vars(spark, d):
    wide = reshape.variables_to_columns(_long_lines(spark, d), ["l_orderkey"], WIDE)
    return reshape.columns_to_variables(wide, ["l_orderkey"], WIDE)


@query
def var_join(spark, d):
    long = _long_lines(spark, d)
    parts = {n: reshape.select_variables(long, [n]) for n in WIDE}
    wide = reshape.join_variables(parts, ["l_orderkey"])
    return wide.select("l_orderkey", *WIDE, fields.range_above(F.col("t2max"), F.col("t2m")).alias("t2plus"))


@query
def add_ranges(spark, d):
    return prep.add_ranges(_long_lines(spark, d), ["l_orderkey"])


def _wrapped_grid(spark, d):
    return V.grid(spark, d).withColumn("lon", fields.wrap_longitude(F.col("lon")))


@query
def target_grid(spark, d):
    """Grid of half a degree over the box the source covers."""
    box = scan.coverage(_wrapped_grid(spark, d).withColumn("valid_date", F.lit(None).cast("date"))).first()
    bbox = (box["lon_min"], box["lon_max"], box["lat_min"], box["lat_max"])
    return regrid.target_grid(spark, bbox, 0.5)


@query
def regrid_bilinear(spark, d):
    """One field per market segment; targets that need a missing corner are NULL."""
    gone = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 12)
    source = (
        V.table(spark, d, "customer")
        .groupBy("c_mktsegment", "c_nationkey")
        .agg(F.max("c_acctbal").alias("value"))
        .select(
            F.floor(F.col("c_nationkey") / 5).cast("int").alias("lat_idx"),
            (F.col("c_nationkey") % 5).cast("int").alias("lon_idx"),
            "c_mktsegment",
            F.when(~gone, F.col("value")).alias("value"),
        )
    )
    grid = regrid.target_grid(spark, (-8.0, 8.0, 10.0, 14.0), 0.5)
    res = regrid.regrid_bilinear(source, grid, regrid.Axes(10.0, 1.0, -8.0, 4.0), ["c_mktsegment"])
    return res.select("lat_idx", "lon_idx", "lat", "lon", "c_mktsegment", out("value").alias("value"))


def _segments(spark, d):
    """A field per market segment on 5 x 5 nations, one value missing."""
    gone = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 12)
    rows = V.table(spark, d, "customer").groupBy("c_mktsegment", "c_nationkey").agg(F.max("c_acctbal").alias("value"))
    row, column = F.floor(F.col("c_nationkey") / 5).cast("int"), (F.col("c_nationkey") % 5).cast("int")
    return rows.select("c_mktsegment", row.alias("row"), column.alias("column"), F.when(~gone, F.col("value")).alias("value"))


@query
def regrid_global(spark, d):
    """Fields that go round the globe, onto both sides of the date line and of the first meridian."""
    source = _segments(spark, d).withColumnsRenamed({"row": "lat_idx", "column": "lon_idx"})
    grid = regrid.target_grid(spark, (-180.0, 180.0, -75.0, 75.0), 15.0)
    res = regrid.regrid_bilinear(source, grid, regrid.Axes(-60.0, 30.0, 0.0, 72.0, ring=5), ["c_mktsegment"])
    return res.select("lat_idx", "lon_idx", "lat", "lon", "c_mktsegment", out("value").alias("value"))


# latitudes fall and neither axis is evenly spaced
ARCHIVE = regrid.Coordinates((59.75, 31.25, 0.5, -28.5, -61.0), (5.0, 47.0, 140.0, 200.0, 301.0), ring=True)


@query
def regrid_irregular(spark, d):
    """Global fields on an archive's own axes, found by their coordinates."""
    pick = lambda values, at: F.element_at(F.array(*[F.lit(v) for v in values]), F.col(at) + 1)
    placed = _segments(spark, d).select("c_mktsegment", pick(ARCHIVE.lats, "row").alias("lat"), fields.wrap_longitude(pick(ARCHIVE.lons, "column")).alias("lon"), "value")
    box = Domain("box", (-75.0, 30.0, -66.0, 66.0), ("tp",), res=6.0)
    res = prep.to_target_grid(placed, box, ARCHIVE, ["c_mktsegment"])
    return res.select("lat", "lon", "c_mktsegment", out("value").alias("value"))


# ------------------------------------------------------------------ sources and sinks


def _placed(df: DataFrame) -> DataFrame:
    return df.select(
        "cell",
        (10.0 + F.floor(F.col("cell") / 5)).alias("lat"),
        fields.wrap_longitude(352.0 + 4 * (F.col("cell") % 5)).alias("lon"),
        "valid_date",
        "value",
    )


def _placed_obs(spark, d):
    return _placed(V.obs(spark, d))


def _placed_history(spark, d):
    return _placed(V.history(spark, d))


@query
def axes(spark, d):
    df = _placed_history(spark, d)
    parts = [
        scan.axis(df, name).select(F.lit(name).alias("axis"), F.col(name).cast("double").alias("at"))
        for name in ("lat", "lon")
    ]
    days = scan.axis(df, "valid_date").select(F.lit("time").alias("axis"), cal.day_number(F.col("valid_date")).cast("double").alias("at"))
    return parts[0].unionByName(parts[1]).unionByName(days)


@query
def coverage(spark, d):
    return scan.coverage(_placed_history(spark, d))


def _stored(df: DataFrame) -> DataFrame:
    return df.withColumn("issue_year", F.year("valid_date")).withColumn("issue_month", F.month("valid_date"))


@query
def roundtrip_packed(spark, d):
    path = scratch_path(spark, "packed")
    sink.write_packed(_stored(V.history(spark, d)), path, "ssrd", ["issue_year"], ["cell", "valid_date"])
    back = sink.read_packed(spark.read.parquet(path), "ssrd")
    return back.select("cell", "valid_date", out("value").alias("value"))


def _issues(spark, d):
    """Hindcast days as two variables, as a forecast store takes them; some values are NaN."""
    rows = _issued(V.mdl(spark, d))
    names = F.when(F.col("cell") % 2 == 0, "tp").otherwise("ssrd")
    value = F.when(F.col("cell") % 7 == 3, F.lit(float("nan"))).otherwise(F.col("value"))
    return rows.select(names.alias("variable"), "issue_date", "valid_date", "ens", F.col("cell").cast("double").alias("lat"), F.lit(0.0).alias("lon"), value.alias("value"))


STORE = Domain("store", (0.0, 25.0, 0.0, 1.0), ("tp", "ssrd"), syr=1996, eyr=1998)


@query
def roundtrip_issue(spark, d):
    """Written twice as packed issues, read back unpacked."""
    path = scratch_path(spark, "issues")
    products.write_issue(_issues(spark, d), path, STORE)
    products.write_issue(_issues(spark, d).where(F.year("issue_date") == 1997), path, STORE)
    back = products.read_issues(spark, path)
    return back.select("variable", "issue_date", "valid_date", "ens", "lat", out("value").alias("value"))


@query
def period_partition(spark, d):
    """Rows read back from the partitions labelled as calibration, and from one labelled otherwise."""
    path = scratch_path(spark, "periods")
    products.write_issue(_issues(spark, d), path, STORE)
    parts = [products.read_issues(spark, path, period=p) for p in ("calib", "1999_1999")]
    rows = parts[0].unionByName(parts[1])
    return rows.groupBy("period", "variable", "issue_year", "issue_month").agg(F.count("*").alias("n"), F.count("value").alias("n_value"))


@query
def append_idempotent(spark, d):
    """Writing an issue twice leaves it once; other issues stay."""
    path = scratch_path(spark, "append")
    df = _stored(V.history(spark, d))
    sink.write_partitions(df, path, ["issue_year"], ["cell", "valid_date"])
    sink.write_partitions(df.where(F.col("issue_year") == 1997), path, ["issue_year"], ["cell", "valid_date"])
    return spark.read.parquet(path).select("cell", "valid_date", out("value").alias("value"))


@query
def replace_store(spark, d):
    """Replacing a store leaves nothing of what it held before."""
    path = scratch_path(spark, "replace")
    df = _stored(V.history(spark, d))
    sink.write_partitions(df, path, ["issue_year"], ["cell", "valid_date"])
    sink.write_partitions(df.where(F.col("issue_month") <= 6), path, ["issue_year", "issue_month"], ["cell", "valid_date"], replace_all=True)
    return spark.read.parquet(path).select("cell", "valid_date", out("value").alias("value"))


def _layout(df: DataFrame, whole: str, along: str) -> DataFrame:
    """Of each ``whole``: in how many files it is, and whether ``along`` rises there without another in between."""
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    rows = df.select(whole, along, "value", file.alias("file"), row.alias("row"))
    order = Window.partitionBy(whole, "file").orderBy("row")
    rows = rows.withColumn("rises", F.coalesce(F.col(along) > F.lag(along).over(order), F.lit(True)))
    return rows.groupBy(whole).agg(
        F.countDistinct("file").alias("n_files"),
        F.bool_and("rises").alias("in_order"),
        (F.max("row") - F.min("row") + 1 == F.count("*")).alias("in_one_piece"),
        F.count("*").alias("n"),
        out(F.max("value")).alias("top"),
    )


@query
def layout_series(spark, d):
    path = scratch_path(spark, "series")
    sink.series_layout(V.history(spark, d), ["cell"], ["valid_date"]).write.parquet(path)
    return _layout(spark.read.parquet(path), "cell", "valid_date")


@query
def layout_map(spark, d):
    path = scratch_path(spark, "maps")
    sink.map_layout(V.history(spark, d), "valid_date", ["cell"]).write.parquet(path)
    return _layout(spark.read.parquet(path), "valid_date", "cell")


@query
def scan_store(spark, d):
    """Some days of a year and season; NaN and the fill value become NULL."""
    path = scratch_path(spark, "store")
    day = F.dayofmonth("valid_date")
    value = F.when(day == 3, F.lit(float("nan"))).when(day == 5, F.lit(-9999.0)).otherwise(F.col("value"))
    df = _stored(V.history(spark, d)).withColumn("variable", F.lit("tp")).withColumn("value", value)
    sink.write_partitions(df, path, ["variable", "issue_year", "issue_month"], ["cell", "valid_date"])
    got = scan.scan_store(spark, path, ["tp"], "1996,0,1997", "6,7", "issue_year", "issue_month")
    return got.select("cell", "valid_date", out("value").alias("value"))


@query
def scan_members(spark, d):
    """Events written as one folder per member, read back in one scan."""
    path = scratch_path(spark, "members")
    members = V.table(spark, d, "events").select((F.col("user_id") % 7).alias("member"), "event_id", "value")
    members.write.partitionBy("member").parquet(path)
    df = scan.scan_members(spark, f"{path}/member=*", r"member=(\d+)")
    return df.select("ens", "event_id", out("value").alias("value"))


@query
def scan_members_mixed(spark, d):
    """Members whose files name their columns differently, in one scan."""
    path = scratch_path(spark, "mixed")
    events = V.table(spark, d, "events").withColumn("member", (F.col("user_id") % 7).cast("int"))
    spelt = [("event_id", "value"), ("id", "var228"), ("id", "value")]
    for k, (key, value) in enumerate(spelt):
        events.where(F.col("member") % 3 == k).select("member", F.col("event_id").alias(key), F.col("value").alias(value)).write.partitionBy("member").parquet(f"{path}/{k}")
    df = scan.scan_members(spark, f"{path}/*/member=*", r"member=(\d+)", names={"event_id": ["id"], "value": ["var228"], "nothing": ["none"]})
    return df.select("ens", "event_id", out("value").alias("value"))


@query
def scan_cells(spark, d):
    """The cells of one region from a tiled reference store; other tiles are not read."""
    path = scratch_path(spark, "tiles")
    placed = _placed_history(spark, d).withColumn("variable", F.lit("tp"))
    products.write_reference(placed, path, tiled=True)
    cells = V.table(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("cell"))
    cells = cells.select((10.0 + F.floor(F.col("cell") / 5)).alias("lat"), fields.wrap_longitude(352.0 + 4 * (F.col("cell") % 5)).alias("lon"))
    got = scan.scan_store(spark, path, ["tp"], cells=cells)
    return got.select("cell", "valid_date", out("value").alias("value"))


@query
def relay_in_place(spark, d):
    """A store in series order laid anew as maps under its own path."""
    path = scratch_path(spark, "relay")
    sink.series_layout(V.history(spark, d), ["cell"], ["valid_date"]).write.parquet(path)
    sink.relay(spark, path, lambda df, to: sink.map_layout(df, "valid_date", ["cell"]).write.parquet(to))
    return _layout(spark.read.parquet(path), "valid_date", "cell")


@query
def thresholds_incremental(spark, d):
    """Thresholds after a year has been added to a summary, and one has come twice."""
    path = scratch_path(spark, "summary")
    months = _monthly_ref(spark, d).withColumn("year", F.year("month_start"))
    for years in ([1995, 1996, 1997, 1998], [1999], [1997]):
        products.add_to_summary(months.where(F.col("year").isin(years)), path, ["cell"])
    return _rounded_thresholds(products.summary_thresholds(spark, path, ["cell"]))


def _dates_as_text(fn):
    """Dates are returned as text, since engines hand them to clients in different types."""

    @functools.wraps(fn)
    def run(spark, d):
        df = fn(spark, d)
        dates = [c for c, kind in df.dtypes if kind == "date"]
        return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df

    return run


QUERIES.update({_name: _dates_as_text(_fn) for _name, _fn in list(QUERIES.items())})
