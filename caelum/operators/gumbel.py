"""Left-skewed Gumbel fit per group by maximum likelihood.

The scale solves one equation whose left side is a ratio of sums, so a Newton step is one
aggregation. A group of any size is fitted without being collected. Steps go on until none changes a
scale by more than ``TOLERANCE`` of it; a group that has not got there after ``MOST`` steps has no fit (NULL).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caelum.operators.quantiles import weight
from caelum.operators.skew import join_facts
from caelum.session import cut

TOLERANCE = 1e-12
MOST = 100
BINS = 200


def fit_left_gumbel(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """keys, ``gumbel_loc``, ``gumbel_scale``; both NULL where any value is missing or the fit does not converge.

    With x the distance below the group's largest value, the scale s satisfies
    s = mean(x) - sum(x exp(-x/s)) / sum(exp(-x/s)), and the location follows from it. The counted sample is
    written once and read once a step; a step's scales, one row a group, are written too.
    """
    seen = df.groupBy(*keys, value).agg(F.sum(weight(df)).alias("copies"))
    seen = cut(seen, "gumbel-sample")
    v, n = F.col(value), F.col("copies")
    start = seen.groupBy(*keys).agg(
        F.max(v).alias("top"),
        (F.sum(v * n) / F.sum(n)).alias("mean"),
        (F.sum(v * v * n) / F.sum(n)).alias("square"),
        (F.count(v) == F.count("*")).alias("full"),
    )
    # moment estimate to start from
    spread = F.sqrt(F.greatest(F.col("square") - F.col("mean") * F.col("mean"), F.lit(0.0)))
    fit = start.where(F.col("full") & (F.col("mean") < F.col("top"))).select(
        *keys,
        "top",
        (F.col("top") - F.col("mean")).alias("mean_x"),
        F.when(spread > 0, spread * math.sqrt(6.0) / math.pi)
        .otherwise(F.col("top") - F.col("mean"))
        .alias("s"),
        F.lit(False).alias("done"),
    )
    fit = cut(_near_start(seen, fit, keys, value), "gumbel-fit")
    x = F.col("top") - F.col(value)
    share = F.col("copies") * F.exp(-x / F.col("s"))
    for _ in range(MOST):
        sums = join_facts(seen, fit, keys, "inner").groupBy(*keys).agg(
            *[F.first(c).alias(c) for c in ("top", "mean_x", "s", "done")],
            F.sum(share).alias("w0"),
            F.sum(share * x).alias("w1"),
            F.sum(share * x * x).alias("w2"),
        )
        ratio = F.col("w1") / F.col("w0")
        gap = F.col("s") - F.col("mean_x") + ratio
        slope = 1 + (F.col("w2") / F.col("w0") - ratio * ratio) / (F.col("s") * F.col("s"))
        # a step never more than halves the scale, so it stays positive
        step = F.greatest(F.col("s") - gap / slope, F.col("s") / 2)
        near = F.abs(step - F.col("s")) <= TOLERANCE * F.col("s")
        fit = sums.select(
            *keys,
            "top",
            "mean_x",
            F.when(F.col("done"), F.col("s")).otherwise(step).alias("s"),
            (F.col("done") | near).alias("done"),
        )
        fit = cut(fit, "gumbel-fit")
        if fit.where("not done").isEmpty():
            break
    last = join_facts(seen, fit.where("done"), keys, "inner").groupBy(*keys).agg(
        F.first("top").alias("top"),
        F.first("s").alias("s"),
        (F.sum(share) / F.sum("copies")).alias("mean_w"),
    )
    return last.select(
        *keys,
        (F.col("top") + F.col("s") * F.log("mean_w")).alias("gumbel_loc"),
        F.col("s").alias("gumbel_scale"),
    )


def _near_start(seen: DataFrame, fit: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``fit`` with scales solved on a histogram of at most ``BINS`` bins a group, in one job: few exact steps are then left."""
    x = F.col("top") - F.col(value)
    # bins of a tenth of the mean distance, wider beyond: x exp(-x/s) changes little within them
    place = F.least(F.floor(10 * F.log1p(3 * x / F.col("mean_x"))), F.lit(BINS - 1))
    bins = join_facts(seen, fit.select(*keys, "top", "mean_x"), keys, "inner").groupBy(*keys, place.alias("_bin"))
    bins = bins.agg(F.sum("copies").cast("double").alias("n"), (F.sum(x * F.col("copies")) / F.sum("copies")).alias("x"))
    held = bins.groupBy(*keys).agg(F.collect_list(F.struct("n", "x")).alias("_h"))
    weight = "h.n * exp(-h.x / s)"
    sums = (
        "aggregate(_h, named_struct('w0', 0D, 'w1', 0D, 'w2', 0D), (b, h) -> named_struct("
        f"'w0', b.w0 + {weight}, 'w1', b.w1 + {weight} * h.x, 'w2', b.w2 + {weight} * h.x * h.x))"
    )
    ratio = "w.w1 / w.w0"
    step = f"s - (s - mean_x + {ratio}) / (1 + (w.w2 / w.w0 - ({ratio}) * ({ratio})) / (s * s))"
    solved = F.expr(f"aggregate(sequence(1, 12), s, (s, _) -> get(transform(array({sums}), w -> greatest({step}, s / 2)), 0))")
    return fit.join(held, keys, "left").withColumn("s", F.coalesce(F.when(F.size("_h") > 0, solved), "s")).drop("_h")


def fit_left_gumbel_arrays(groups: DataFrame) -> DataFrame:
    """The same fit for rows holding a sorted array ``obs`` with ``obs_mean``, ``obs_sd`` and
    ``obs_max``, the last two NULL where a value is missing."""
    weight = "exp((v - obs_max) / a.s)"
    sums = (
        "aggregate(obs, named_struct('w0', 0D, 'w1', 0D, 'w2', 0D), (b, v) -> named_struct("
        f"'w0', b.w0 + {weight}, 'w1', b.w1 + {weight} * (obs_max - v), "
        f"'w2', b.w2 + {weight} * (obs_max - v) * (obs_max - v)))"
    )
    ratio = "w.w1 / w.w0"
    gap = f"(a.s - (obs_max - obs_mean) + {ratio})"
    slope = f"(1 + (w.w2 / w.w0 - ({ratio}) * ({ratio})) / (a.s * a.s))"
    # the one-element transform names the sums of a step
    step = f"get(transform(array({sums}), w -> greatest(a.s - {gap} / {slope}, a.s / 2)), 0)"
    moved = f"get(transform(array({step}), t -> named_struct('s', t, 'done', abs(t - a.s) <= {TOLERANCE!r}D * a.s)), 0)"
    begin = f"if(obs_sd > 0, named_struct('s', obs_sd * {math.sqrt(6.0) / math.pi!r}D, 'done', false), null)"
    g = groups.withColumn(
        "_fit", F.expr(f"aggregate(sequence(1, {MOST}), {begin}, (a, _) -> if(a is null or a.done, a, {moved}))")
    )
    g = g.withColumn("gumbel_scale", F.expr("if(_fit.done, _fit.s, null)")).drop("_fit")
    mean_w = "aggregate(obs, 0D, (b, v) -> b + exp((v - obs_max) / gumbel_scale)) / size(obs)"
    return g.withColumn("gumbel_loc", F.expr(f"if(gumbel_scale is null, null, obs_max + gumbel_scale * ln({mean_w}))"))


def left_gumbel_quantile(p: Column, loc: Column, scale: Column) -> Column:
    return F.when((p > 0) & (p < 1), loc + scale * F.log(-F.log(1.0 - p)))
