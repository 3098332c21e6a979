"""Empirical quantile mapping of ensemble members, group by group.

A group is whatever ``keys`` say: a cell, or a cell and a lead day. Each has a forecast, a
reference sample and a hindcast sample. Three routes give the same rows:

* ``map_arrays``: one row per group with sorted samples, looked up in O(log n) per member;
* ``map_rows``: value slices (``operators.quantiles``) for groups of any size;
* ``map_lists``: the same slices as lists (``operators.value_lists``), for samples of calendar windows.

Which one is for the caller to say, who knows whether the key bounds the group.

Both end in ``mapped_columns``, which ``operators.tails.finish`` turns into corrected values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caelum.config import CorrectionParams
from caelum.functions import sorted_arrays as sa
from caelum.operators.gumbel import fit_left_gumbel, fit_left_gumbel_arrays
from caelum.operators.quantiles import SLICE_ROWS, bracket, distinct_knots, positions, weight
from caelum.operators.skew import join_counted, join_facts
from caelum.operators.value_lists import extents, knot_rows, placed, slice_knots, value_rows
from caelum.session import cut

GROUP_FACTS = [
    "n_obs",
    "usable",
    "varied",
    "obs_mean",
    "obs_sd",
    "obs_min",
    "obs_max",
    "dry_obs",
    "dry_mdl",
    "obs_up",
    "obs_low",
    "mdl_up",
    "mdl_low",
]
MEMBER_FACTS = ["value", "clamped", "rank", "mapped", "draw_rank", "draw_mapped"]


GUMBEL_FACTS = ["gumbel_loc", "gumbel_scale"]


def mapped_columns(keys: list[str], ids: list[str]) -> list[str]:
    return [*keys, *ids, *MEMBER_FACTS, *GROUP_FACTS]


def default_draw(columns: list[str], seed: int = 0) -> Column:
    """Uniform number in [0, 1) from a hash of the row's key: the same on every rerun."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(2**53)) / F.lit(float(2**53))


def with_draw(pred: DataFrame, columns: list[str], seed: int = 0) -> DataFrame:
    if "draw" in pred.columns:
        return pred
    return pred.withColumn("draw", default_draw(columns, seed))


# ---------------------------------------------------------------- groups held in one row


def sample_arrays(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Sorted non-missing values of each group and the number of missing ones."""
    return df.groupBy(*keys).agg(
        F.sort_array(F.collect_list("value")).alias(name),
        (F.count("*") - F.count("value")).alias(f"{name}_missing"),
    )


def group_samples(
    pred: DataFrame, obs: DataFrame, mdl: DataFrame, keys: list[str], ids: list[str]
) -> DataFrame:
    """One row per forecast group with its members and both samples, by a single grouping."""
    rows = (
        pred.select(*keys, F.struct(*ids, "value", "draw").alias("member"))
        .unionByName(
            obs.select(*keys, F.col("value").alias("o"), F.lit("obs").alias("role")),
            allowMissingColumns=True,
        )
        .unionByName(
            mdl.select(*keys, F.col("value").alias("m"), F.lit("mdl").alias("role")),
            allowMissingColumns=True,
        )
    )
    return (
        rows.groupBy(*keys)
        .agg(
            F.collect_list("member").alias("members"),
            F.sort_array(F.collect_list("o")).alias("obs"),
            F.count_if((F.col("role") == "obs") & F.col("o").isNull()).alias("obs_missing"),
            F.sort_array(F.collect_list("m")).alias("mdl"),
            F.count_if((F.col("role") == "mdl") & F.col("m").isNull()).alias("mdl_missing"),
        )
        .where(F.size("members") > 0)
    )


def map_arrays(
    groups: DataFrame,
    keys: list[str],
    ids: list[str],
    params: CorrectionParams,
    gumbel: bool = False,
) -> DataFrame:
    """Map the ``members`` of rows holding ``obs``, ``obs_missing``, ``mdl``, ``mdl_missing``."""
    nq, dry = params.nquants, params.dry_thresh
    group_facts = GROUP_FACTS + (GUMBEL_FACTS if gumbel else [])
    exact = "if({0}_missing = 0, {1}, null)"
    facts = {
        "n_obs": "size(obs) + obs_missing",
        "usable": "size(obs) > 0 and size(mdl) > 0",
        "varied": (
            # more than ten, missing values counting as one
            f"{sa.more_distinct_than('obs', 'if(obs_missing > 0, 9, 10)')} and "
            f"{sa.more_distinct_than('mdl', 'if(mdl_missing > 0, 9, 10)')}"
        ),
        "obs_mean": f"if(size(obs) > 0, {sa.total('obs')} / size(obs), null)",
        "obs_min": exact.format("obs", "get(obs, 0)"),
        "obs_max": exact.format("obs", "get(obs, size(obs) - 1)"),
        "dry_obs": f"({sa.last_below('obs', f'{dry}D')} + 1) / (size(obs) + obs_missing)",
        "dry_mdl": f"({sa.last_below('mdl', f'{dry}D')} + 1) / (size(mdl) + mdl_missing)",
    }
    g = (
        groups.withColumn("obs", F.coalesce("obs", F.expr("cast(array() as array<double>)")))
        .withColumn("mdl", F.coalesce("mdl", F.expr("cast(array() as array<double>)")))
        .withColumn("obs_missing", F.coalesce("obs_missing", F.lit(0).cast("bigint")))
        .withColumn("mdl_missing", F.coalesce("mdl_missing", F.lit(0).cast("bigint")))
    )
    g = g.select(
        *keys,
        "obs",
        "obs_missing",
        "mdl",
        "mdl_missing",
        "members",
        *[F.expr(sql).alias(name) for name, sql in facts.items() if name not in ("dry_obs", "dry_mdl")],
        *[
            F.expr(f"if(usable, {facts[name]}, null)").alias(name)
            for name in ("dry_obs", "dry_mdl")
        ],
    )
    g = g.select(
        *keys,
        "obs",
        "mdl",
        "members",
        *[c for c in GROUP_FACTS if c in facts],
        F.expr(
            f"if(usable and obs_missing = 0, sqrt({sa.squares_about('obs', 'obs_mean')} / size(obs)), null)"
        ).alias("obs_sd"),
        F.expr(exact.format("obs", sa.midpoint("obs", "n_obs", "n_obs"))).alias("obs_up"),
        F.expr(exact.format("obs", sa.midpoint("obs", "1", "n_obs"))).alias("obs_low"),
        F.expr(exact.format("mdl", sa.midpoint("mdl", "n_obs", "n_obs"))).alias("mdl_up"),
        F.expr(exact.format("mdl", sa.midpoint("mdl", "1", "n_obs"))).alias("mdl_low"),
    )

    if gumbel:
        g = fit_left_gumbel_arrays(g)

    # Knots are quantiles of a sorted sample by position: a search computes the few it looks at.
    mdl_knot = lambda k: sa.knot("mdl", k, str(nq))
    steps = _Members([*ids, "value", "draw"])
    steps.add(
        clamped=f"if(r.value is null or not (usable and varied), null, least(greatest(r.value, {mdl_knot('0')}), {mdl_knot(str(nq - 1))}))"
    )
    steps.add(at=f"if(r.clamped is null, null, {sa.last_knot_at_most('mdl', str(nq), 'r.clamped')})")
    steps.add(
        knot=f"if(r.at is null, null, {mdl_knot('r.at')})",
        above=f"if(r.at is null or r.at + 1 >= {nq}, null, {mdl_knot('(r.at + 1)')})",
    )
    steps.add(first=f"if(r.at is null, null, {sa.last_knot_below('mdl', str(nq), 'r.knot')} + 1)")
    p_first = f"((r.first + 1) / {nq + 1}.0D)"
    p_next = f"((r.at + 2) / {nq + 1}.0D)"
    steps.add(
        rank=(
            f"if(r.clamped = r.knot, {p_first}, {p_first} + (r.clamped - r.knot)"
            f" * ({p_next} - {p_first}) / (r.above - r.knot))"
        ),
        draw_rank="dry_mdl * r.draw",
    )
    _add_value_at(steps, "rank", "mapped", params.fill_tied_max)
    if params.intermittency:
        _add_value_at(steps, "draw_rank", "draw_mapped", False)
    else:
        steps.add(draw_mapped="cast(null as double)")
    # explode would add a size filter, which is pushed down and repeats the work above;
    # members are never empty, so the outer form gives the same rows
    out = g.select(*keys, *group_facts, F.explode_outer(F.expr(steps.sql)).alias("r"))
    return out.select(
        *keys, *[f"r.{c}" for c in ids], *[f"r.{c}" for c in MEMBER_FACTS], *group_facts
    )


class _Members:
    """Adds fields to the structs of the ``members`` array.

    Each step is a ``transform`` over the result of the one before, so an earlier field is
    computed once however often later steps use it.
    """

    def __init__(self, fields: list[str]):
        self.sql, self.fields = "members", list(fields)

    def add(self, **new: str) -> None:
        old = ", ".join(f"'{f}', r.{f}" for f in self.fields)
        more = ", ".join(f"'{name}', {sql}" for name, sql in new.items())
        self.sql = f"transform({self.sql}, r -> named_struct({old}, {more}))"
        self.fields += list(new)


def _add_value_at(steps: _Members, rank: str, out: str, fill_tied_max: bool) -> None:
    """Interpolate rank -> value on the distinct reference knots; NULL outside them."""
    guess = f"least(cast(floor(r.{rank} * (n_obs + 1)) as int), cast(n_obs as int))"
    steps.add(**{f"{out}_g": guess})
    g = f"r.{out}_g"
    steps.add(
        **{
            f"{out}_k": (
                f"case when {g} < n_obs and ({g} + 1) / cast(n_obs + 1 as double) <= r.{rank} then {g} "
                f"when {g} / cast(n_obs + 1 as double) > r.{rank} then {g} - 2 else {g} - 1 end"
            )
        }
    )
    k = f"r.{out}_k"
    n = "cast(n_obs as int)"
    none = f"{k} is null or {k} < 0 or not (usable and varied)"
    steps.add(**{f"{out}_v": f"if({none}, null, {sa.knot('obs', k, 'n_obs')})"})
    v = f"r.{out}_v"
    steps.add(
        **{
            f"{out}_f": f"if({v} is null, null, {sa.last_knot_below('obs', n, v)} + 1)",
            f"{out}_n": f"if({v} is null, null, {sa.last_knot_at_most('obs', n, v)} + 1)",
        }
    )
    p_first = f"((r.{out}_f + 1) / cast(n_obs + 1 as double))"
    p_next = f"((r.{out}_n + 1) / cast(n_obs + 1 as double))"
    beyond = f"r.{rank} <= n_obs / cast(n_obs + 1 as double)" if fill_tied_max else "false"
    steps.add(
        **{
            out: (
                f"case when r.{out}_f is null then null when r.{rank} = {p_first} then {v} "
                f"when r.{out}_n >= n_obs then if({beyond}, {v}, null) "
                f"else {v} + (r.{rank} - {p_first}) * ({sa.knot('obs', f'r.{out}_n', 'n_obs')} - {v}) / ({p_next} - {p_first}) end"
            )
        }
    )


# ---------------------------------------------------------------- groups of any size


def _at_position(i: str, n: str) -> Column:
    """Sum that picks the midpoint quantile i/(n+1) out of ``positions`` rows."""
    scaled = f"cast({i} as decimal(18,0)) * cast(m - 1 as decimal(18,0))"
    width = f"cast({n} + 1 as decimal(18,0))"
    below = F.expr(f"({scaled}) div {width}")
    above = below + F.expr(f"if(({scaled}) % {width} > 0, 1, 0)")

    def held(at: Column) -> Column:
        return F.when((at >= F.col("start")) & (at < F.col("stop")), F.col("x") / 2).otherwise(0.0)

    return F.sum(held(below) + held(above))


def map_rows(
    pred: DataFrame,
    obs: DataFrame,
    mdl: DataFrame,
    keys: list[str],
    ids: list[str],
    params: CorrectionParams,
    slice_rows: int = SLICE_ROWS,
    gumbel: bool = False,
) -> DataFrame:
    """Same result as ``map_arrays`` without holding a group's sample anywhere.

    ``obs`` and ``mdl`` may be counted already: a ``copies`` column says how many rows a row is.
    """
    dry, nq = params.dry_thresh, params.nquants

    def sizes(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum(weight(df)).alias(f"n_{tag}"))

    def profile(pos: DataFrame, counts: DataFrame, tag: str) -> DataFrame:
        copies = F.col("stop") - F.col("start")
        df = join_facts(pos, counts, keys).groupBy(*keys).agg(
            F.max("m").alias(f"m_{tag}"),
            F.max("d").alias(f"d_{tag}"),
            F.min("x").alias(f"{tag}_min"),
            F.max("x").alias(f"{tag}_max"),
            (F.sum(F.col("x") * copies) / F.max("m")).alias(f"{tag}_mean"),
            F.sum(F.when(F.col("x") < dry, copies).otherwise(0)).alias(f"{tag}_dry"),
            _at_position("n_obs", "n_obs").alias(f"{tag}_up"),
            _at_position("1", "n_obs").alias(f"{tag}_low"),
        )
        # the deviation about the mean, in a second pass over the written positions
        away = F.col("x") - F.col("mean")
        about = join_facts(pos, df.select(*keys, F.col(f"{tag}_mean").alias("mean")), keys, "inner")
        squares = about.groupBy(*keys).agg(F.sqrt(F.sum(away * away * copies) / F.max("m")).alias(f"{tag}_sd"))
        return df.join(squares, keys, "left")

    po = cut(positions(obs, keys, "value", slice_rows), "obs-positions")
    pm = cut(positions(mdl, keys, "value", slice_rows), "mdl-positions")
    n_obs = cut(sizes(obs, "obs"), "obs-sizes")
    facts = (
        n_obs.join(sizes(mdl, "mdl"), keys, "full")
        .join(profile(po, n_obs, "obs"), keys, "left")
        .join(profile(pm, n_obs, "mdl"), keys, "left")
    )
    facts = cut(_group_facts(facts, keys), "group-facts")
    ready = facts.where("usable and varied").select(*keys, "n_obs", "dry_mdl")
    k_mdl = distinct_knots(pm, keys, F.lit(nq))
    k_obs = distinct_knots(join_facts(po, ready.select(*keys, "n_obs"), keys, "inner"), keys, F.col("n_obs"))
    rows = _looked_up(pred, facts, ready, k_mdl, k_obs, keys, ids, params, slice_rows)
    return join_facts(rows, fit_left_gumbel(obs, keys), keys) if gumbel else rows


def map_lists(
    pred: DataFrame,
    obs: DataFrame,
    mdl: DataFrame,
    keys: list[str],
    ids: list[str],
    params: CorrectionParams,
    slice_rows: int = SLICE_ROWS,
    gumbel: bool = False,
) -> DataFrame:
    """Same result as ``map_rows`` of samples held in ``value_lists``: keys, slice, ``held``."""
    parts = {tag: cut(extents(df, keys, params.dry_thresh), f"{tag}-slices") for tag, df in (("obs", obs), ("mdl", mdl))}

    def sizes(tag: str) -> DataFrame:
        return parts[tag].groupBy(*keys).agg(
            F.sum("n_slice").alias(f"n_{tag}"),
            F.sum("m_slice").alias(f"m_{tag}"),
            F.sum("d_slice").alias(f"d_{tag}"),
            F.min("first_x").alias(f"{tag}_min"),
            F.max("last_x").alias(f"{tag}_max"),
            F.try_divide(F.sum("total"), F.sum("m_slice")).alias(f"{tag}_mean"),
            F.sum("dry_slice").alias(f"{tag}_dry"),
        )

    groups = cut(sizes("obs").join(sizes("mdl"), keys, "full"), "group-sizes")

    def knots(df: DataFrame, tag: str, n: Column) -> DataFrame:
        known = groups.select(
            *keys,
            F.col(f"m_{tag}").alias("m"),
            F.col(f"{tag}_mean").alias("mean"),
            F.coalesce("n_obs", F.lit(0).cast("bigint")).alias("n_obs"),
            n.cast("bigint").alias("n"),
        )
        whole = placed(parts[tag], keys).join(known, keys)
        present = df.select(*keys, "slice", F.filter("held", lambda h: h["x"].isNotNull()).alias("vals"))
        return cut(slice_knots(present.join(whole, [*keys, "slice"]), keys), f"{tag}-knots")

    found = {"obs": knots(obs, "obs", F.col("n_obs")), "mdl": knots(mdl, "mdl", F.lit(params.nquants))}
    facts = groups
    for tag, df in found.items():
        ends = df.groupBy(*keys).agg(
            F.sum("up").alias(f"{tag}_up"), F.sum("low").alias(f"{tag}_low"), F.sum("squares").alias(f"{tag}_squares")
        )
        facts = facts.join(ends, keys, "left")
    facts = facts.withColumn("obs_sd", F.sqrt(F.try_divide("obs_squares", "m_obs")))
    facts = cut(_group_facts(facts, keys), "group-facts")
    ready = facts.where("usable and varied").select(*keys, "n_obs", "dry_mdl")
    k_obs = knot_rows(found["obs"].join(ready, keys, "left_semi"), keys)
    rows = _looked_up(pred, facts, ready, knot_rows(found["mdl"], keys), k_obs, keys, ids, params, slice_rows)
    return join_facts(rows, fit_left_gumbel(value_rows(obs, keys), keys), keys) if gumbel else rows


def _group_facts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """``GROUP_FACTS`` of the sizes and profiles of both samples."""
    facts = facts.withColumn("usable", F.coalesce((F.col("m_obs") > 0) & (F.col("m_mdl") > 0), F.lit(False)))
    obs_full = F.col("m_obs") == F.col("n_obs")
    mdl_full = F.col("m_mdl") == F.col("n_mdl")

    def many(tag: str) -> Column:
        missing = F.coalesce(F.col(f"m_{tag}"), F.lit(0)) < F.col(f"n_{tag}")
        return F.coalesce(F.col(f"d_{tag}"), F.lit(0)) + F.when(missing, 1).otherwise(0) > 10

    return facts.select(
        *keys,
        "n_obs",
        "usable",
        (many("obs") & many("mdl")).alias("varied"),
        "obs_mean",
        F.when(obs_full, F.col("obs_sd")).alias("obs_sd"),
        F.when(obs_full, F.col("obs_min")).alias("obs_min"),
        F.when(obs_full, F.col("obs_max")).alias("obs_max"),
        F.when(F.col("usable"), F.col("obs_dry") / F.col("n_obs")).alias("dry_obs"),
        F.when(F.col("usable"), F.col("mdl_dry") / F.col("n_mdl")).alias("dry_mdl"),
        *[F.when(obs_full, F.col(c)).alias(c) for c in ("obs_up", "obs_low")],
        *[F.when(mdl_full, F.col(c)).alias(c) for c in ("mdl_up", "mdl_low")],
    )


def _looked_up(
    pred: DataFrame,
    facts: DataFrame,
    ready: DataFrame,
    k_mdl: DataFrame,
    k_obs: DataFrame,
    keys: list[str],
    ids: list[str],
    params: CorrectionParams,
    slice_rows: int,
) -> DataFrame:
    """Forecast members brought through both samples' knots (keys, q, i, n): ``mapped_columns``."""
    dry, nq = params.dry_thresh, params.nquants
    # each distinct forecast value is looked up once
    limits = k_mdl.groupBy(*keys).agg(F.min("q").alias("q_min"), F.max("q").alias("q_max"))
    distinct = pred.where(F.col("value").isNotNull()).groupBy(*keys, "value").agg(F.count("*").alias("asked"))
    values = (
        join_facts(distinct, limits.join(ready, keys, "left_semi"), keys, "inner")
        .withColumn("clamped", F.least(F.greatest("value", "q_min"), "q_max"))
        .select(*keys, "value", "clamped", "asked")
    )
    values = cut(values, "forecast-values")
    p_mdl = F.col("i") / F.lit(float(nq + 1))
    forward = bracket(
        values.select(*keys, F.col("clamped").alias("q")),
        k_mdl.withColumn("p", p_mdl),
        keys,
        "q",
        ["p"],
        slice_rows,
    ).select(
        *keys,
        F.col("q").alias("clamped"),
        F.when(F.col("below.at") == F.col("q"), F.col("below.p"))
        .otherwise(
            F.col("below.p")
            + (F.col("q") - F.col("below.at"))
            * (F.col("above.p") - F.col("below.p"))
            / (F.col("above.at") - F.col("below.at"))
        )
        .alias("rank"),
    )
    forward = cut(forward, "ranks")
    k_obs = k_obs.withColumn("p", F.col("i") / (F.col("n") + 1).cast("double"))

    def value_at(points: DataFrame, fill_tied_max: bool) -> DataFrame:
        found = bracket(points, k_obs, keys, "p", ["q", "n"], slice_rows)
        last = F.col("below.n") / (F.col("below.n") + 1).cast("double")
        beyond = F.when(F.lit(fill_tied_max) & (F.col("p") <= last), F.col("below.q"))
        return found.select(
            *keys,
            "p",
            F.when(F.col("below").isNull(), F.lit(None))
            .when(F.col("below.at") == F.col("p"), F.col("below.q"))
            .when(F.col("above").isNull(), beyond)
            .otherwise(
                F.col("below.q")
                + (F.col("p") - F.col("below.at"))
                * (F.col("above.q") - F.col("below.q"))
                / (F.col("above.at") - F.col("below.at"))
            )
            .alias("v"),
        )

    ranks = forward.select(*keys, F.col("rank").alias("p"))
    back = value_at(ranks, params.fill_tied_max).select(
        *keys, F.col("p").alias("rank"), F.col("v").alias("mapped")
    )
    looked_up = join_facts(values, forward.join(back, [*keys, "rank"], "left"), [*keys, "clamped"], "inner")
    rows = (
        join_facts(join_counted(pred, looked_up, [*keys, "value"], "asked", slice_rows), facts, keys)
        .withColumn("usable", F.coalesce("usable", F.lit(False)))
        .withColumn("varied", F.coalesce("varied", F.lit(False)))
        .withColumn("draw_rank", F.col("dry_mdl") * F.col("draw"))
    )
    if not params.intermittency:
        rows = rows.withColumn("draw_mapped", F.lit(None).cast("double"))
    else:
        # only dry members of groups wetter than the hindcast use a draw
        needs = (
            F.col("usable")
            & F.col("varied")
            & (F.col("clamped") < dry)
            & (F.col("dry_obs") < F.col("dry_mdl"))
        )
        rows = cut(rows.withColumn("at_draw", F.when(needs, F.col("draw_rank"))), "mapped")
        drawn = value_at(rows.select(*keys, F.col("at_draw").alias("p")), False).select(
            *keys, F.col("p").alias("at_draw"), F.col("v").alias("draw_mapped")
        )
        rows = join_facts(rows, drawn, [*keys, "at_draw"])
    return rows.select(*mapped_columns(keys, ids))
