"""Bias correction of a forecast against a reference and a hindcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caelum.config import CorrectionParams
from caelum.operators.mapping import group_samples, map_arrays, map_lists, map_rows, with_draw
from caelum.operators.quantiles import SLICE_ROWS
from caelum.operators.tails import finish, needs_gumbel
from caelum.operators.windows import (
    calendar_pool,
    calendar_rows,
    lead_pool,
    lead_rows,
    other_years,
    other_years_missing,
    target_day,
    without_own_year,
)
from caelum.session import cut


def map_groups(
    pred: DataFrame,
    obs: DataFrame,
    mdl: DataFrame,
    keys: list[str],
    ids: list[str],
    params: CorrectionParams,
    bounded: bool = False,
    slice_rows: int = SLICE_ROWS,
    gumbel: bool = False,
) -> DataFrame:
    """Quantile-map ``pred`` (keys, ids, value) group by group; all values of a group pooled.

    ``bounded`` states that the inputs' keys bound every group, which then is one row; else all groups are cut into
    value slices.
    """
    pred = with_draw(pred, [*keys, *ids])
    if not bounded:
        return map_rows(pred, obs, mdl, keys, ids, params, slice_rows, gumbel)
    frames = [f.repartition(*keys) for f in (pred, obs, mdl)]
    return map_arrays(group_samples(*frames, keys, ids), keys, ids, params, gumbel)


def correct_groups(
    pred: DataFrame,
    obs: DataFrame,
    mdl: DataFrame,
    keys: list[str],
    ids: list[str],
    params: CorrectionParams,
    precip: bool = False,
    bounded: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``map_groups`` followed by tails, dry days and guards: adds ``corrected``."""
    gumbel = needs_gumbel(params, precip)
    mapped = map_groups(pred, obs, mdl, keys, ids, params, bounded, slice_rows, gumbel)
    return finish(mapped, params, precip)


def _corrected_in_arrays(
    pred: DataFrame,
    obs: DataFrame,
    mdl: DataFrame,
    cell: list[str],
    ids: list[str],
    first_year: int,
    params: CorrectionParams,
    gumbel: bool,
    crossval: bool,
) -> DataFrame:
    """Mapping with sliding windows; after hashing by cell nothing else is shuffled.

    For cross-validation the pools hold (year, value), and a group is taken apart by predicted year only once it is one
    row: each predicted year keeps the other years' values, within the task.
    """
    group = [*cell, "issue_month", "lead"]
    pred, obs, mdl = (f.repartition(*cell) for f in (pred, obs, mdl))
    day = target_day(first_year, F.col("issue_month"), F.col("lead"))
    targets = pred.select(*group).distinct().withColumn("day", day)
    reference = calendar_pool(obs, targets, cell, ["issue_month", "lead"], params.window, by_year=crossval)
    members = pred.select(*group, F.struct(*ids, "value", "draw").alias("member"))
    if crossval:
        held, gone = F.struct(F.col("issue_year").alias("year"), "value"), F.lit(0)
    else:
        held, gone = F.col("value"), F.col("value").isNull().cast("int")
    history = mdl.select(*group, held.alias("held"), gone.alias("gone"))
    # one grouping brings the three together; all are hashed by cell, so nothing moves
    steps = (
        history.unionByName(members, allowMissingColumns=True)
        .unionByName(reference, allowMissingColumns=True)
        .groupBy(*group)
        .agg(
            F.sort_array(F.collect_list("held")).alias("vals"),
            F.coalesce(F.sum("gone"), F.lit(0)).alias("gone"),
            F.collect_list("member").alias("members"),
            F.flatten(F.collect_list("obs")).alias("obs"),
            F.sum("obs_missing").alias("obs_missing"),
        )
    )
    pooled = lead_pool(steps, [*cell, "issue_month"], params.mdl_window).where(F.size("members") > 0)
    if crossval:
        years = F.array_distinct(F.transform("members", lambda m: m["issue_year"]))
        one = pooled.withColumn("_year", F.explode(years))
        pooled = one.select(
            *group,
            F.expr("filter(members, m -> m.issue_year = _year)").alias("members"),
            *[other_years(p, "_year").alias(p) for p in ("obs", "mdl")],
            *[other_years_missing(p, "_year").alias(f"{p}_missing") for p in ("obs", "mdl")],
        )
    return map_arrays(pooled, group, ids, params, gumbel)


def bias_correct(
    pred: DataFrame,
    obs: DataFrame,
    mdl: DataFrame,
    cell: list[str],
    ids: list[str],
    first_year: int,
    params: CorrectionParams,
    precip: bool = False,
    crossval: bool = False,
    bounded: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Correct every member of every lead day in one plan.

    ``pred``: cell, ids (``issue_year`` among them), issue_month, lead, value; ``obs``: cell,
    valid_date, value; ``mdl``: cell, issue_year, issue_month, lead, value. Reference days come
    from ``params.window`` days around the lead's calendar day in ``first_year``, hindcast steps
    from ``params.mdl_window`` lead days around it. ``bounded`` states that ``cell`` bounds the rows of a cell
    in every input, as on a grid, where years, members and days do; else cells are cut into value slices, and a
    window is a list of values a slice.

    ``crossval`` corrects each predicted issue year without it: without the hindcast issued in it and without the reference days dated in it
    (days of a lead that has crossed New Year are dated in the next year and stay).
    """
    group = [*cell, "issue_month", "lead"]
    pred = with_draw(pred, [*group, *ids])
    gumbel = needs_gumbel(params, precip)
    if bounded:
        mapped = _corrected_in_arrays(pred, obs, mdl, cell, ids, first_year, params, gumbel, crossval)
        return finish(mapped, params, precip)
    pred = cut(pred.select(*group, *ids, "value", "draw"), "forecast")
    day = target_day(first_year, F.col("issue_month"), F.col("lead"))
    targets = cut(pred.select(*group).distinct().withColumn("day", day), "targets")
    reference = calendar_rows(obs, targets, cell, ["issue_month", "lead"], params.window, crossval, slice_rows)
    year = "issue_year" if crossval else None
    hindcast = lead_rows(mdl, targets, [*cell, "issue_month"], params.mdl_window, year, slice_rows)
    reference, hindcast = cut(reference, "reference-pools"), cut(hindcast, "hindcast-pools")
    if crossval:  # each predicted year is a group of its own, with samples that lack it
        years = cut(pred.select(*group, "issue_year").distinct(), "predicted-years")
        reference, hindcast = (without_own_year(f, years, group, "issue_year") for f in (reference, hindcast))
        group, ids = [*group, "issue_year"], [c for c in ids if c != "issue_year"]
    mapped = map_lists(pred, reference, hindcast, group, ids, params, slice_rows, gumbel)
    return finish(mapped, params, precip)
