"""Samples as lists: one row per value slice of a group, for calendar windows over cells of any size.

A cell's counted values are cut into value slices once; a day's values of a slice are one list, and a window is the
lists of its days. So a group's sample is as many rows as its cell has slices, not a row a value, and what a task
holds is a slice of one group. Inside a list the work is done by numpy, across slices by Spark, from a summary of one row a slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caelum.operators.quantiles import sliced

WHOLE = 2**62  # whole-number products below this fit 64 bits


def value_lists(counted: DataFrame, keys: list[str], at: list[str], apart: list[str], slice_rows: int) -> DataFrame:
    """Counted values (keys, at, apart, value, copies) as one row per keys, ``at`` and value slice of ``keys``: ``held``, a list
    of (x, copies, apart) in any order, missing values among them."""
    held = F.struct(F.col("value").cast("double").alias("x"), "copies", *apart)
    parts = sliced(counted, keys, "value", slice_rows)
    return parts.groupBy(*keys, *at, "slice").agg(F.collect_list(held).alias("held"))


def value_rows(lists: DataFrame, keys: list[str]) -> DataFrame:
    """One row per entry of the lists: keys, value, copies."""
    return lists.select(*keys, F.explode("held").alias("h")).select(*keys, F.col("h.x").alias("value"), "h.copies")


def extents(lists: DataFrame, keys: list[str], dry: float) -> DataFrame:
    """What the other slices of a group must know of one: number of values, of present and of distinct ones, ends, sum and dry count."""
    vals = lists.select(*keys, "slice", "held", F.filter("held", lambda h: h["x"].isNotNull()).alias("vals"))
    present = vals.withColumn("xs", F.transform("vals", lambda h: h["x"]))

    def added(name: str, each, zero: str = "bigint") -> Column:
        return F.aggregate(name, F.lit(0).cast(zero), lambda s, h: s + each(h))

    return present.select(
        *keys,
        "slice",
        added("held", lambda h: h["copies"]).alias("n_slice"),
        added("vals", lambda h: h["copies"]).alias("m_slice"),
        F.size(F.array_distinct("xs")).cast("bigint").alias("d_slice"),
        F.array_min("xs").alias("first_x"),
        F.array_max("xs").alias("last_x"),
        added("vals", lambda h: h["x"] * h["copies"], "double").alias("total"),
        added("vals", lambda h: F.when(h["x"] < dry, h["copies"]).otherwise(F.lit(0).cast("bigint"))).alias("dry_slice"),
    ).where("n_slice > 0")


def placed(parts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, slice, ``offset`` (the group's values before the slice) and ``after`` (the first one behind it), of ``extents``."""
    by_slice = Window.partitionBy(*keys).orderBy("slice")
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    return parts.where("m_slice > 0").select(
        *keys,
        "slice",
        F.coalesce(F.sum("m_slice").over(before), F.lit(0).cast("bigint")).alias("offset"),
        F.lead("first_x").over(by_slice).alias("after"),
    )


def _slice_knots(x, copies, offset, after, m, n):
    """Distinct sorted values, their ``start`` and ``stop``, and the knots (q, i) that the slice yields; see ``quantiles.distinct_knots``."""
    order = np.argsort(x, kind="stable")
    x, copies = x[order], copies[order]
    first = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
    x, copies = x[first], np.add.reduceat(copies, first)
    stop = offset + np.cumsum(copies)
    start = stop - copies
    gaps, width = m - 1, n + 1
    if gaps:
        exact = (lambda a: a) if m * (width + 1) < WHOLE else (lambda a: a.astype(object))
        first_at, last_at = exact(start) * width, exact(stop - 1) * width
        inside = np.maximum(1, (first_at + (gaps - 1)) // gaps)
        between = last_at // gaps + 1
        on_value = (inside <= n) & (inside * gaps <= last_at)
        on_gap = (between <= n) & (between * gaps < last_at + width)
    else:  # a single value is every knot
        inside, between = np.ones(len(x), np.int64), np.full(len(x), width)
        on_value, on_gap = np.full(len(x), n >= 1), np.zeros(len(x), bool)
    following = np.append(x[1:], np.nan if after is None else after)
    on_value, on_gap = on_value.astype(bool), on_gap.astype(bool)
    if after is None:
        on_gap[-1] = False
    q = np.concatenate((x[on_value], (x[on_gap] + following[on_gap]) / 2))
    i = np.concatenate((inside[on_value], between[on_gap])).astype(np.int64)
    return x, copies, start, stop, q, i


def _held_at(x, start, stop, i: int, m: int, n: int) -> float:
    """The part of the midpoint quantile i/(n+1) that the slice holds."""
    below, rest = divmod(i * (m - 1), n + 1)
    part = 0.0
    for at in (below, below + (rest > 0)):
        if start[0] <= at < stop[-1]:
            part += x[np.searchsorted(stop, at, "right")] / 2
    return float(part)


def slice_knots(lists: DataFrame, keys: list[str]) -> DataFrame:
    """Knots and order statistics of each slice: keys, n, ``q`` and ``i`` (lists, see ``quantiles.distinct_knots``), ``up``, ``low``, ``squares``.

    ``lists`` holds, beside keys and ``held``, offset, after, m and mean of the group, the number of knots ``n``, and ``n_obs``, at whose
    outermost knots ``up`` and ``low`` are; those two and ``squares`` about the mean are to be added over the slices.
    """
    given = lists.select(
        *keys,
        "n",
        F.transform("vals", lambda h: h["x"]).alias("x"),
        F.transform("vals", lambda h: h["copies"]).alias("copies"),
        "offset",
        "after",
        "m",
        "mean",
        "n_obs",
    )
    kept = [*keys, "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.list_(pa.float64()), pa.list_(pa.int64()), pa.float64(), pa.float64(), pa.float64()]
        for b in batches:
            xs, cs = b.column("x"), b.column("copies")
            ends = xs.offsets.to_numpy()
            flat_x, flat_c = xs.values.to_numpy(), cs.values.to_numpy()
            single = [b.column(c).to_pylist() for c in ("offset", "after", "m", "mean", "n", "n_obs")]
            found = [[] for _ in kinds]
            for r, (offset, after, m, mean, n, n_obs) in enumerate(zip(*single)):
                lo, hi = ends[r], ends[r + 1]
                x, copies, start, stop, q, i = _slice_knots(flat_x[lo:hi], flat_c[lo:hi], offset, after, m, n)
                up, low = (_held_at(x, start, stop, k, m, n_obs) for k in (n_obs, 1))
                for column, got in zip(found, (q, i, up, low, float(np.sum(copies * (x - mean) ** 2)))):
                    column.append(got)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in kept], *[pa.array(c, k) for c, k in zip(found, kinds)]],
                names=[*kept, "q", "i", "up", "low", "squares"],
            )

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.select(*kept).schema)
    return given.mapInArrow(work, f"{types}, q array<double>, i array<bigint>, up double, low double, squares double")


def knot_rows(knots: DataFrame, keys: list[str]) -> DataFrame:
    """``slice_knots`` as rows: keys, q, i, n."""
    both = F.explode(F.arrays_zip("q", "i")).alias("k")
    return knots.select(*keys, "n", both).select(*keys, "k.q", "k.i", "n")
