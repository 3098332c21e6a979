"""From mapped members to corrected values: tails, dry days, intermittency, guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caelum.config import CorrectionParams
from caelum.functions.normal import normal_quantile
from caelum.operators.gumbel import left_gumbel_quantile


def beyond_above(precip: bool) -> Column:
    above = F.col("rank") > F.col("n_obs") / (F.col("n_obs") + 1).cast("double")
    return above & (F.col("clamped") > 0) if precip else above


def beyond_below(precip: bool) -> Column:
    below = F.col("rank") < F.lit(1.0) / (F.col("n_obs") + 1).cast("double")
    return below & (F.col("clamped") > 0) if precip else below


def tail_value(rule: str, end: str, precip: bool) -> Column:
    """Value of a member beyond the reference's ``up`` or ``low`` end."""
    if rule == "constant":
        return F.col("obs_max") if end == "up" else F.col("obs_min")
    if rule == "delta_additive":
        return F.col("clamped") + (F.col(f"obs_{end}") - F.col(f"mdl_{end}"))
    if rule == "delta_scaling":
        return F.col("clamped") * F.try_divide(F.col(f"obs_{end}"), F.col(f"mdl_{end}"))
    if not precip:
        return F.col("obs_mean") + F.col("obs_sd") * normal_quantile(F.col("rank"))
    if end == "up":
        return left_gumbel_quantile(F.col("rank"), F.col("gumbel_loc"), F.col("gumbel_scale"))
    # no distribution is defined for the dry end: the interpolated value stays, which is missing
    return F.col("mapped")


def needs_gumbel(params: CorrectionParams, precip: bool) -> bool:
    return precip and params.up_extrapol == "distribution"


def with_tails(df: DataFrame, params: CorrectionParams, precip: bool) -> DataFrame:
    return df.withColumn(
        "corrected",
        F.when(beyond_below(precip), tail_value(params.low_extrapol, "low", precip))
        .when(beyond_above(precip), tail_value(params.up_extrapol, "up", precip))
        .otherwise(F.col("mapped")),
    )


def with_dry_days(df: DataFrame, params: CorrectionParams) -> DataFrame:
    """Ranks within the reference's dry share become 0; then dry members are redrawn or zeroed."""
    value = F.when(F.col("rank") <= F.col("dry_obs"), F.lit(0.0)).otherwise(F.col("corrected"))
    if params.intermittency:
        dry_member = F.col("clamped") < params.dry_thresh
        value = F.when(dry_member & (F.col("dry_obs") >= F.col("dry_mdl")), F.lit(0.0)).otherwise(value)
        if params.extremes == "weibull":
            redrawn = F.when(F.col("draw_rank") <= F.col("dry_obs"), F.lit(0.0)).otherwise(
                F.col("draw_mapped")
            )
            value = F.when(dry_member & (F.col("dry_obs") < F.col("dry_mdl")), redrawn).otherwise(value)
    return df.withColumn("corrected", value)


def with_guards(df: DataFrame) -> DataFrame:
    """No sample: missing. Too few distinct values: the reference mean for every member."""
    return df.withColumn(
        "corrected",
        F.when(~F.col("usable"), F.lit(None).cast("double"))
        .when(~F.col("varied"), F.col("obs_mean"))
        .otherwise(F.col("corrected")),
    )


def finish(df: DataFrame, params: CorrectionParams, precip: bool) -> DataFrame:
    """Add ``corrected`` to rows of ``mapping.mapped_columns``; the order of steps matters."""
    df = with_tails(df, params, precip)
    if precip:
        df = with_dry_days(df, params)
    return with_guards(df)
