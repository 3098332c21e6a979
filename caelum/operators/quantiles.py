"""Exact quantiles and interpolation for groups of any size.

Groups that fit a task use sorted arrays (``functions.sorted_arrays``) or ``percentile``. The
functions here hold for a group of any size: copies are counted before the shuffle, and every
group is cut into value slices that sort independently; a short per-slice summary carries
positions and neighbours across the cuts. The cuts are values of the group itself, picked by a hash of
the value, so they follow its distribution, one far outlier moves none of them, and a recomputed task
cuts at the same places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caelum.functions.sorted_arrays import last_at_most
from caelum.operators.skew import join_facts

SLICE_ROWS = 2_000_000
DRAWN = 32
LONG = "decimal(18,0)"  # positions times knot counts pass 64 bits for very large groups


def sliced(df: DataFrame, keys: list[str], x: str, slice_rows: int) -> DataFrame:
    """``df``, which has few rows of equal keys and ``x``, with ``slice``: -1, 0, 1, ... by rising ``x``.

    A group gets about one slice for ``slice_rows`` rows, by the same rule whether it holds a hundred rows
    or 1e12: of values drawn by their hash, ``DRAWN`` for each slice, every ``DRAWN``-th in order begins one, so
    slices are about even. So there are as many cuts as the table has slices, and none in most groups.
    """
    share = min(1.0, DRAWN / slice_rows)
    drawn = F.shiftrightunsigned(F.xxhash64(*keys, x), 12) < share * float(1 << 52)
    cuts = df.where(drawn).groupBy(*keys).agg(F.sort_array(F.collect_set(x)).alias("_cuts"))
    cuts = cuts.withColumn("_cuts", F.filter("_cuts", lambda _, k: k % DRAWN == DRAWN - 1)).where(F.size("_cuts") > 0)
    return join_facts(df, cuts, keys).withColumn("slice", F.coalesce(F.expr(last_at_most("_cuts", x)), F.lit(-1))).drop("_cuts")


def weight(df: DataFrame) -> Column:
    """How many rows a row stands for: its ``copies`` where the table is already counted."""
    return F.col("copies") if "copies" in df.columns else F.lit(1).cast("bigint")


def positions(
    df: DataFrame, keys: list[str], value: str = "value", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """One row per distinct value of a group, with the positions its copies take when sorted.

    Columns: keys, ``x``, ``start`` (0-based), ``stop`` (exclusive), ``next_x``, ``m`` (values in
    the group), ``d`` (distinct values) and ``lo`` (smallest value). Missing values are left out.
    """
    seen = (
        df.select(*keys, F.col(value).cast("double").alias("x"), weight(df).alias("copies"))
        .where(F.col("x").isNotNull())
        .groupBy(*keys, "x")
        .agg(F.sum("copies").alias("copies"))
    )
    parts = sliced(seen, keys, "x", slice_rows)
    by_slice = Window.partitionBy(*keys).orderBy("slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    group = by_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a row a slice, so a group's extent comes from it too
    summary = (
        parts.groupBy(*keys, "slice")
        .agg(F.sum("copies").alias("in_slice"), F.count("*").alias("d_slice"), F.min("x").alias("first_x"))
        .select(
            *keys,
            "slice",
            F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("offset"),
            F.lead("first_x").over(by_slice).alias("after"),
            F.sum("in_slice").over(group).alias("m"),
            F.sum("d_slice").over(group).alias("d"),
            F.min("first_x").over(group).alias("lo"),
        )
    )
    in_order = Window.partitionBy(*keys, "slice").orderBy("x")
    upto = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        parts.withColumn("upto", F.sum("copies").over(upto))
        .withColumn("next_here", F.lead("x").over(in_order))
        .join(summary, [*keys, "slice"])
        .select(
            *keys,
            "x",
            (F.col("offset") + F.col("upto") - F.col("copies")).alias("start"),
            (F.col("offset") + F.col("upto")).alias("stop"),
            F.coalesce("next_here", "after").alias("next_x"),
            "m",
            "d",
            "lo",
        )
    )


def distinct_knots(pos: DataFrame, keys: list[str], n: Column) -> DataFrame:
    """Midpoint quantiles at i/(n+1), i = 1..n, keeping the smallest i of equal ones.

    ``n`` may refer to columns of ``pos``. A distinct value yields at most two knots: the first
    i whose two order statistics are both copies of it, and the first i that falls between it
    and the next value. So no knot list is ever spelled out. Columns: keys, ``q``, ``i``, ``n``.
    """
    pos = (
        pos.withColumn("n", n.cast("bigint"))
        .withColumn("gaps", F.col("m") - 1)
        # i * gaps / (n + 1) is the position of knot i; compare products, never quotients
        .withColumn("first_at", F.expr(f"cast(start as {LONG}) * cast(n + 1 as {LONG})"))
        .withColumn("last_at", F.expr(f"cast(stop - 1 as {LONG}) * cast(n + 1 as {LONG})"))
        .withColumn(
            "inside",
            F.expr("if(gaps = 0, 1L, greatest(1L, (first_at + gaps - 1) div gaps))"),
        )
        .withColumn("between", F.expr("if(gaps = 0, n + 1, last_at div gaps + 1)"))
    )

    def position(i: str) -> Column:
        return F.expr(f"cast({i} as {LONG}) * cast(gaps as {LONG})")

    on_value = F.when(
        (F.col("inside") <= F.col("n")) & (position("inside") <= F.col("last_at")),
        F.struct(F.col("x").alias("q"), F.col("inside").alias("i")),
    )
    on_gap = F.when(
        (F.col("between") <= F.col("n"))
        & F.col("next_x").isNotNull()
        & (position("between") < F.col("last_at") + F.col("n") + 1),
        F.struct(((F.col("x") + F.col("next_x")) / 2).alias("q"), F.col("between").alias("i")),
    )
    both = F.filter(F.array(on_value, on_gap), lambda k: k.isNotNull())
    return pos.select(*keys, "n", F.explode(both).alias("k")).select(*keys, "k.q", "k.i", "n")


def bracket(
    points: DataFrame,
    knots: DataFrame,
    keys: list[str],
    at: str,
    carried: list[str],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """For each distinct point of a group the knots around it: no range join, no pairs.

    ``points`` and ``knots`` both have column ``at``. Adds struct columns ``below`` (last knot at
    or below the point) and ``above`` (first knot beyond it), each with ``at`` and ``carried``.
    """
    knot = F.struct(F.col(at).alias("at"), *carried)
    points = points.select(*keys, at).where(F.col(at).isNotNull()).distinct()
    both = knots.select(*keys, at, knot.alias("knot")).unionByName(
        points.select(*keys, at), allowMissingColumns=True
    )
    both = sliced(both, keys, at, slice_rows)
    by_slice = Window.partitionBy(*keys).orderBy("slice")
    carry = (
        both.groupBy(*keys, "slice")
        .agg(F.max("knot").alias("top"), F.min("knot").alias("bottom"))
        .select(
            *keys,
            "slice",
            F.last("top", True)
            .over(by_slice.rowsBetween(Window.unboundedPreceding, -1))
            .alias("earlier"),
            F.first("bottom", True)
            .over(by_slice.rowsBetween(1, Window.unboundedFollowing))
            .alias("later"),
        )
    )
    # a knot sorts before a point of the same value
    in_order = Window.partitionBy(*keys, "slice").orderBy(F.col(at), F.col("knot").isNull())
    back = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # read backwards so that the frame grows instead of being rescanned for every row
    reverse = Window.partitionBy(*keys, "slice").orderBy(
        F.col(at).desc(), F.col("knot").isNull().desc()
    )
    ahead = reverse.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        both.withColumn("here_below", F.last("knot", True).over(back))
        .withColumn("here_above", F.last("knot", True).over(ahead))
        .where(F.col("knot").isNull())
        .join(carry, [*keys, "slice"])
        .select(
            *keys,
            at,
            F.coalesce("here_below", "earlier").alias("below"),
            F.coalesce("here_above", "later").alias("above"),
        )
    )


def _weights(method: str, prob: float, m: Column) -> list[tuple[Column, Column]]:
    """(0-based position, weight) of the order statistics a quantile is made of."""
    h = F.lit(float(prob)) * (m - 1)
    below, above = F.floor(h), F.ceil(h)
    part = F.lit(0.5) if method == "midpoint" else h - below
    return [(below, 1 - part), (above, part)]


def from_sorted(arr: str, prob: float, method: str) -> Column:
    """Quantile of a sorted array column."""
    (a, wa), (b, wb) = _weights(method, prob, F.size(arr))
    return F.get(arr, a.cast("int")) * wa + F.get(arr, b.cast("int")) * wb


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    wanted: dict[str, tuple[float, str]],
    bounded: bool = False,
    slice_rows: int = SLICE_ROWS,
    also: dict[str, Column] | None = None,
) -> DataFrame:
    """Exact quantiles per group; ``wanted`` maps a column name to (probability, method).

    ``linear`` interpolates between order statistics, ``midpoint`` takes their mean. Missing
    values are skipped. ``also`` holds further aggregates for the same pass. ``bounded`` states that the
    input's key bounds every group, which is then sorted as one array; else all groups go through value slices.
    """
    also = also or {}
    others = [agg.alias(name) for name, agg in also.items()]
    if not bounded:
        return _sliced_quantiles(df, keys, value, wanted, slice_rows, also)
    linear = {k: p for k, (p, method) in wanted.items() if method == "linear"}
    middle = {k: p for k, (p, method) in wanted.items() if method == "midpoint"}
    aggs = list(others)
    if linear:
        aggs.append(F.percentile(value, list(linear.values())).alias("_linear"))
    if middle:
        aggs.append(F.sort_array(F.collect_list(value)).alias("_sorted"))
    columns = {k: F.get("_linear", F.lit(n)) for n, k in enumerate(linear)}
    columns.update({k: from_sorted("_sorted", p, "midpoint") for k, p in middle.items()})
    picked = [*also, *[columns[k].alias(k) for k in wanted]]
    return df.groupBy(*keys).agg(*aggs).select(*keys, *picked)


def _sliced_quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict, slice_rows: int, also: dict[str, Column]) -> DataFrame:
    others = [agg.alias(name) for name, agg in also.items()]
    pos = positions(df, keys, value, slice_rows)
    sums = []
    for k, (p, method) in wanted.items():
        parts = [
            F.when((at >= F.col("start")) & (at < F.col("stop")), F.col("x") * w).otherwise(0.0)
            for at, w in _weights(method, p, F.col("m"))
        ]
        sums.append(F.sum(parts[0] + parts[1]).alias(k))
    groups = df.groupBy(*keys).agg(*others) if others else df.select(*keys).distinct()
    return groups.join(pos.groupBy(*keys).agg(*sums), keys, "left").select(*keys, *also, *wanted)
