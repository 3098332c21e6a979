"""Calendar windows: which reference and hindcast days belong to a forecast's lead day.

Both are sliding frames over one array per cell and day, so a value is shuffled once and never
copied into the 31 windows it belongs to. Targets are put on the same axis as rows without
values ("spine"), since a frame only yields rows that exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caelum.functions.calendar import year_length
from caelum.operators.quantiles import SLICE_ROWS
from caelum.operators.skew import join_facts
from caelum.operators.value_lists import value_lists
from caelum.session import cut


def target_day(first_year: int, issue_month: Column, lead: Column) -> Column:
    """Day of year of a lead day, in the first hindcast year."""
    return F.dayofyear(F.date_add(F.make_date(F.lit(first_year), issue_month, F.lit(1)), lead.cast("int")))


def _on_ring(df: DataFrame, cell: list[str], width: int, ring: int | None, by_year: bool = False) -> DataFrame:
    """Dated values as (cell, ring length, axis position ``at``), repeated past both ends.

    ``by_year`` keeps each value with its year, missing ones too.
    """
    length = F.lit(ring) if ring else year_length(F.col("valid_date"))
    day = F.dayofyear("valid_date")
    held = F.struct(F.year("valid_date").alias("year"), "value") if by_year else F.col("value")
    dated = df.select(*cell, length.cast("int").alias("len"), day.alias("day"), held.alias("held"), "value").where(
        F.col("day") <= F.col("len")
    )
    per_day = dated.groupBy(*cell, "len", "day").agg(
        F.sort_array(F.collect_list("held")).alias("vals"),
        (F.lit(0) if by_year else F.count("*") - F.count("value")).cast("bigint").alias("gone"),
    )
    places = F.filter(
        F.array("day", F.col("day") - F.col("len"), F.col("day") + F.col("len")),
        lambda at: (at >= 1 - width) & (at <= 367 + width),
    )
    return per_day.select(*cell, "len", F.explode(places).alias("at"), "vals", "gone")


def calendar_pool(
    dated: DataFrame,
    targets: DataFrame,
    cell: list[str],
    ids: list[str],
    window: int = 15,
    name: str = "obs",
    ring: int | None = None,
    shift: int = 0,
    by_year: bool = False,
) -> DataFrame:
    """Values of all years whose day of year is within ``window`` days of each target's ``day``.

    ``targets`` has ``cell``, ``ids`` and ``day``. Days wrap at 365 or 366, whichever length the
    value's own year has, or always at ``ring`` with the centre moved by ``shift``. Result:
    cell, ids, sorted array ``name`` and ``{name}_missing``; with ``by_year`` an array of (year, value) that
    holds the missing ones too.
    """
    if not 0 < 2 * window + 1 <= 365:
        raise ValueError("the calendar window must be shorter than a year")
    cell_len = Window.partitionBy(*cell, "len").orderBy("at").rangeBetween(-window, window)
    lengths = [ring] if ring else [365, 366]
    spine = targets.select(
        *cell,
        F.explode(F.array(*[F.lit(n) for n in lengths])).alias("len"),
        (F.col("day") + shift).alias("at"),
        *ids,
        F.lit(True).alias("target"),
    )
    framed = (
        _on_ring(dated, cell, window, ring, by_year)
        .unionByName(spine, allowMissingColumns=True)
        .withColumn("pool", F.flatten(F.collect_list("vals").over(cell_len)))
        .withColumn("pool_gone", F.sum("gone").over(cell_len))
        .where("target")
    )
    return framed.groupBy(*cell, *ids).agg(
        F.sort_array(F.flatten(F.collect_list("pool"))).alias(name),
        F.coalesce(F.sum("pool_gone"), F.lit(0)).cast("bigint").alias(f"{name}_missing"),
    )


def lead_pool(
    steps: DataFrame, cell: list[str], window: int = 15, name: str = "mdl"
) -> DataFrame:
    """Pool ``vals`` / ``gone`` of one row per (cell, lead) over leads within ``window``.

    215 lead days are shorter than a year, so "day of year within 15 days, same issue" is the
    same as a lead distance of at most 15.
    """
    frame = Window.partitionBy(*cell).orderBy("lead").rangeBetween(-window, window)
    return (
        steps.withColumn(name, F.sort_array(F.flatten(F.collect_list("vals").over(frame))))
        .withColumn(f"{name}_missing", F.coalesce(F.sum("gone").over(frame), F.lit(0)).cast("bigint"))
        .drop("vals", "gone")
    )


def lead_steps(mdl: DataFrame, targets: DataFrame, cell: list[str]) -> DataFrame:
    """One row per (cell, lead) with the hindcast's values, including target leads without any."""
    rows = mdl.select(*cell, "lead", "value", F.lit(True).alias("real"))
    rows = rows.unionByName(targets.select(*cell, "lead").distinct(), allowMissingColumns=True)
    return rows.groupBy(*cell, "lead").agg(
        F.sort_array(F.collect_list("value")).alias("vals"),
        F.count_if(F.col("real") & F.col("value").isNull()).alias("gone"),
    )


def hindcast_pool(mdl: DataFrame, targets: DataFrame, cell: list[str], window: int = 15) -> DataFrame:
    pooled = lead_pool(lead_steps(mdl, targets, cell), cell, window)
    return pooled.join(targets.select(*cell, "lead").distinct(), [*cell, "lead"], "left_semi")


def other_years(pool: str, year: str) -> Column:
    """Sorted values of a (year, value) array without those of ``year``: cross-validation."""
    kept = f"filter({pool}, x -> x.year <> {year} and x.value is not null)"
    return F.expr(f"array_sort(transform({kept}, x -> x.value))")


def other_years_missing(pool: str, year: str) -> Column:
    return F.expr(f"size(filter({pool}, x -> x.year <> {year} and x.value is null))").cast("bigint")


# ---------------------------------------------------------------- lists per target, for cells of any size


def ring_days(targets: DataFrame, keys: list[str], window: int) -> DataFrame:
    """(keys, ring length, day) of every day in a target's window: 62 rows a target."""
    moved = targets.select(*keys, "day").distinct()
    return (
        moved.withColumn("len", F.explode(F.array(F.lit(365), F.lit(366))))
        .withColumn("step", F.explode(F.sequence(F.lit(-window), F.lit(window))))
        .select(
            *keys,
            "len",
            (F.pmod(F.col("day") + F.col("step") - 1, F.col("len")) + 1).cast("int").alias("doy"),
        )
    )


def calendar_rows(
    obs: DataFrame,
    targets: DataFrame,
    cell: list[str],
    ids: list[str],
    window: int,
    by_year: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Like ``calendar_pool`` but in ``value_lists``: one row per target and value slice of its cell.

    Values are counted per day first, so copies do not multiply with the window, and a day's list moves as one row.
    A slice serves the ``2 * window + 1`` days of a window, so it is that much smaller. ``by_year`` keeps values apart by ``year``.
    """
    year = [F.year("valid_date").alias("year")] if by_year else []
    apart = ["year"] if by_year else []
    dated = (
        obs.select(
            *cell,
            year_length(F.col("valid_date")).alias("len"),
            F.dayofyear("valid_date").alias("doy"),
            *year,
            "value",
        )
        .groupBy(*cell, "len", "doy", *apart, "value")
        .agg(F.count("*").alias("copies"))
    )
    days = value_lists(cut(dated, "reference-days"), cell, ["len", "doy"], apart, max(1, slice_rows // (2 * window + 1)))
    near = days.join(ring_days(targets, [*cell, *ids], window), [*cell, "len", "doy"])
    return near.groupBy(*cell, *ids, "slice").agg(F.flatten(F.collect_list("held")).alias("held"))


def without_own_year(counted: DataFrame, years: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Counted values (keys, year, value, copies) of all years but one, for each year predicted: keys, ``year``, value, copies.

    ``years`` has the predicted years (keys, ``year``). A sample without a year is the count of each value over all years less
    its count in that year: the two are added up with opposite signs, and what is left over is kept. So the sample's rows
    are counted once, and a value that only the predicted year has is gone. Of ``value_lists`` that hold the year of each entry a
    list is taken apart inside its row: keys, ``year``, slice, held.
    """
    if "held" in counted.columns:
        every = counted.join(years.select(*keys, year).distinct(), keys)
        others = F.filter("held", lambda h: ~h["year"].eqNullSafe(F.col(year)))
        return every.select(*keys, year, "slice", others.alias("held"))
    whole = counted.groupBy(*keys, "value").agg(F.sum("copies").alias("copies"))
    every = join_facts(whole, years.select(*keys, year).distinct(), keys, "inner")
    own = counted.select(*keys, "value", (-F.col("copies")).alias("copies"), F.col("year").cast("int").alias(year))
    rest = every.unionByName(own).groupBy(*keys, year, "value").agg(F.sum("copies").alias("copies"))
    return rest.where("copies > 0")


def lead_rows(
    mdl: DataFrame, targets: DataFrame, cell: list[str], window: int, year: str | None = None, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Like ``lead_pool`` but in ``value_lists``: one row per target lead and value slice; values kept apart by ``year`` if given."""
    apart = [F.col(year).alias("year")] if year else []
    counted = mdl.groupBy(*cell, "lead", *apart, "value").agg(F.count("*").alias("copies"))
    steps = value_lists(
        cut(counted, "hindcast-steps"), cell, ["lead"], ["year"] if year else [], max(1, slice_rows // (2 * window + 1))
    )
    reach = F.sequence(F.col("lead") - window, F.col("lead") + window)
    spread = steps.select(*cell, "slice", F.explode(reach).alias("lead"), "held")
    near = spread.join(targets.select(*cell, "lead").distinct(), [*cell, "lead"], "left_semi")
    return near.groupBy(*cell, "lead", "slice").agg(F.flatten(F.collect_list("held")).alias("held"))
