"""Probabilities of forecast categories relative to climatological thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caelum.config import members_in

# Probabilities that mark a forecast without skill.
SENTINEL = {"quintile": 25.0, "tercile": 35.0}
UNDECIDED = -0.5


def member_class(value: Column, product: str) -> Column:
    """Category of one member, from threshold columns q10 ... q90 on its row.

    ``extreme`` has 1 (below q10) and 2 (above q90); members between have none.
    """
    if product == "extreme":
        return F.when(value < F.col("q10"), 1).when(value > F.col("q90"), 2)
    limits = ["q20", "q40", "q60", "q80"] if product == "quintile" else ["q33", "q66"]
    out = F.when(value < F.col(limits[0]), 1)
    for k, (lo, hi) in enumerate(zip(limits, limits[1:]), start=2):
        out = out.when((value >= F.col(lo)) & (value < F.col(hi)), k)
    return out.when(value >= F.col(limits[-1]), len(limits) + 1)


def n_classes(product: str) -> int:
    return {"extreme": 2, "tercile": 3, "quintile": 5}[product]


def count_columns(product: str) -> list[str]:
    return [f"{product}_{k}" for k in range(1, n_classes(product) + 1)]


def class_counts(value: Column, product: str) -> list[Column]:
    """Aggregates: members per category."""
    cls = member_class(value, product)
    return [
        F.count_if(cls == k).alias(name) for k, name in enumerate(count_columns(product), start=1)
    ]


def first_present(df: DataFrame, cell: list[str]) -> DataFrame:
    """(cell, present): whether the first month and member of a forecast has a value."""
    first = F.min_by(F.struct("value"), F.struct("month_start", "ens"))
    return df.groupBy(*cell).agg(first["value"].isNotNull().alias("present"))


def nominal_members(issue_date: Column) -> Column:
    """Ensemble size of an issue as a column."""
    early, late = members_in(2016), members_in(2017)
    return F.when(F.year(issue_date) < 2017, early).otherwise(late)


def probability(count: Column, members, present: Column | None = None) -> Column:
    """Percent of the nominal ensemble size; NULL where the cell is masked."""
    share = count / members * 100
    return share if present is None else F.when(present, share)


def best_category(probabilities: list[Column]) -> Column:
    """struct(prob, category) of the likeliest category; of equals the first one."""
    options = F.array(
        *[
            F.struct(p.alias("prob"), F.lit(-k).alias("rank"))
            for k, p in enumerate(probabilities, start=1)
        ]
    )
    top = F.array_max(options)
    return F.when(
        top["prob"].isNotNull(),
        F.struct(top["prob"].alias("prob"), (-top["rank"]).alias("category")),
    )


def encode_category(
    best: Column,
    product: str,
    sentinel: str = "equal",
    wet_limit: Column | None = None,
) -> Column:
    """Category plus probability/100, the probability of a certain category capped at 99.99.

    A quintile or tercile forecast at the no-skill probability becomes -0.5; ``sentinel="below"``
    includes lower ones. With ``wet_limit`` (q90 of precipitation) so do cells where that is
    under 1 mm/day.
    """
    prob = F.when(best["prob"] == 100, F.lit(99.99)).otherwise(best["prob"])
    code = best["category"] + prob / 100
    if product in SENTINEL:
        low = prob <= SENTINEL[product] if sentinel == "below" else prob == SENTINEL[product]
        code = F.when(low, F.lit(UNDECIDED)).otherwise(code)
    if wet_limit is not None:
        code = F.when(wet_limit < 1, F.lit(UNDECIDED)).otherwise(code)
    return code


def categories_long(df: DataFrame, keys: list[str], product: str) -> DataFrame:
    """One row per category from the count columns: keys, category, members."""
    pairs = F.array(
        *[
            F.struct(F.lit(k).alias("category"), F.col(name).alias("members"))
            for k, name in enumerate(count_columns(product), start=1)
        ]
    )
    return df.select(*keys, F.explode(pairs).alias("c")).select(*keys, "c.category", "c.members")
