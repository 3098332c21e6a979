"""SQL for DuckDB that recomputes each query by another route.

Order statistics come from ``row_number`` and joins by index, lookups from ASOF joins, calendar
windows from the literal modulo rule, monthly matching from plain joins.
"""

from __future__ import annotations

from caelum.functions import normal
from catalogue.queries import NQ, TAIL_QUERIES
from catalogue.views import with_views

ORACLES: dict[str, str] = {}


def r(x: str) -> str:
    return f"round(({x}) + 5e-9, 4)"


# ------------------------------------------------------------------ mapping


def mapping_ctes(keys: str, dry: float = 0.1, nq: int = NQ) -> str:
    """From o(keys, value), m(keys, value), p(keys, ..., value, draw) to ``res``: p's rows with
    y (rank), c (clamped), mapped, drawn and the group's facts. ``keys`` is comma separated."""
    on = lambda a, b: " and ".join(f"{a}.{k} = {b}.{k}" for k in keys.split(","))
    k_of = lambda a: ", ".join(f"{a}.{k}" for k in keys.split(","))
    return f"""
os as materialized (select {keys}, value, row_number() over (partition by {keys} order by value) - 1 k from o where value is not null),
ms as materialized (select {keys}, value, row_number() over (partition by {keys} order by value) - 1 k from m where value is not null),
og as materialized (select {keys}, count(*) n, count(value) m, count(distinct value) d, avg(value) mean, stddev_pop(value) sd,
  min(value) lo, max(value) hi, sum(case when value < {dry} then 1 else 0 end) / count(*) dry from o group by {keys}),
mg as materialized (select {keys}, count(*) mn, count(value) mm, count(distinct value) md,
  sum(case when value < {dry} then 1 else 0 end) / count(*) mdry from m group by {keys}),
g as (select og.*, mg.mn, mg.mm, mg.md, mg.mdry,
  og.m > 0 and mg.mm > 0 usable,
  og.d + (case when og.m < og.n then 1 else 0 end) > 10 and mg.md + (case when mg.mm < mg.mn then 1 else 0 end) > 10 varied
  from og join mg on {on('og', 'mg')}),
gg as materialized (select * from g where usable and varied),
mi as (select {keys}, i, (i * (mm - 1)) // {nq + 1} a, (i * (mm - 1)) // {nq + 1} + (case when (i * (mm - 1)) % {nq + 1} > 0 then 1 else 0 end) b
  from (select *, unnest(range(1, {nq + 1})) i from gg)),
mk as (select {k_of('mi')}, mi.i, (x.value + y.value) / 2 q from mi
  join ms x on {on('mi', 'x')} and x.k = mi.a join ms y on {on('mi', 'y')} and y.k = mi.b),
mu as materialized (select *, lead(q) over w q2, lead(p) over w p2 from (select {keys}, q, min(i) / {nq + 1} p from mk group by {keys}, q)
  window w as (partition by {keys} order by q)),
oi as (select {keys}, n, i, (i * (m - 1)) // (n + 1) a, (i * (m - 1)) // (n + 1) + (case when (i * (m - 1)) % (n + 1) > 0 then 1 else 0 end) b
  from (select *, unnest(range(1, n + 1)) i from gg)),
ok as materialized (select {k_of('oi')}, oi.n, oi.i, (x.value + y.value) / 2 q from oi
  join os x on {on('oi', 'x')} and x.k = oi.a join os y on {on('oi', 'y')} and y.k = oi.b),
ou as materialized (select *, lead(q) over w q2, lead(p) over w p2 from (select {keys}, q, min(i) / (max(n) + 1) p from ok group by {keys}, q)
  window w as (partition by {keys} order by p)),
lim as (select {keys}, min(q) qmin, max(q) qmax from mk group by {keys}),
pc as (select p.*, case when p.value is null then null when p.value < qmin then qmin when p.value > qmax then qmax else p.value end c
  from p left join lim on {on('p', 'lim')}),
py as (select pc.*, case when pc.c = mu.q then mu.p else mu.p + (pc.c - mu.q) * (mu.p2 - mu.p) / (mu.q2 - mu.q) end y
  from pc asof left join mu on {on('pc', 'mu')} and pc.c >= mu.q),
pz as (select py.*, case when py.y = ou.p then ou.q when ou.q2 is null then null
    else ou.q + (py.y - ou.p) * (ou.q2 - ou.q) / (ou.p2 - ou.p) end mapped
  from py asof left join ou on {on('py', 'ou')} and py.y >= ou.p),
pg as (select pz.*, g.n, g.mean, g.sd, g.lo, g.hi, g.dry, g.mdry, coalesce(g.usable, false) usable, coalesce(g.varied, false) varied,
  case when g.m = g.n then g.lo end lo0, case when g.m = g.n then g.hi end hi0, g.mdry * pz.draw u, g.m om, g.mm, g.mn
  from pz left join g on {on('pz', 'g')}),
res as (select pg.*, case when pg.u = ou.p then ou.q when ou.q2 is null then null
    else ou.q + (pg.u - ou.p) * (ou.q2 - ou.q) / (ou.p2 - ou.p) end drawn
  from pg asof left join ou on {on('pg', 'ou')} and pg.u >= ou.p),
ends as (select {k_of('g')},
  (a1.value + b1.value) / 2 oup, (a2.value + b2.value) / 2 olow, (c1.value + d1.value) / 2 mup, (c2.value + d2.value) / 2 mlow
  from g
  left join os a1 on {on('g', 'a1')} and a1.k = (g.n * (g.m - 1)) // (g.n + 1) and g.m = g.n
  left join os b1 on {on('g', 'b1')} and b1.k = (g.n * (g.m - 1) + g.n) // (g.n + 1) and g.m = g.n
  left join os a2 on {on('g', 'a2')} and a2.k = (g.m - 1) // (g.n + 1) and g.m = g.n
  left join os b2 on {on('g', 'b2')} and b2.k = (g.m - 1 + g.n) // (g.n + 1) and g.m = g.n
  left join ms c1 on {on('g', 'c1')} and c1.k = (g.n * (g.mm - 1)) // (g.n + 1) and g.mm = g.mn
  left join ms d1 on {on('g', 'd1')} and d1.k = (g.n * (g.mm - 1) + g.n) // (g.n + 1) and g.mm = g.mn
  left join ms c2 on {on('g', 'c2')} and c2.k = (g.mm - 1) // (g.n + 1) and g.mm = g.mn
  left join ms d2 on {on('g', 'd2')} and d2.k = (g.mm - 1 + g.n) // (g.n + 1) and g.mm = g.mn),
full_res as (select res.*, oup, olow, mup, mlow from res left join ends on {on('res', 'ends')})"""


def horner(coefficients, x: str) -> str:
    text = repr(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + ({c!r}))"
    return text


def normal_sql(p: str) -> str:
    low, high = f"sqrt(-2e0 * ln({p}))", f"sqrt(-2e0 * ln(1e0 - {p}))"
    q = f"({p} - 0.5e0)"
    return (
        f"case when {p} < {normal.TAIL!r} then {horner(normal.TAIL_NUM, low)} / {horner(normal.TAIL_DEN, low)} "
        f"when {p} > 1 - {normal.TAIL!r} then -({horner(normal.TAIL_NUM, high)}) / {horner(normal.TAIL_DEN, high)} "
        f"else {horner(normal.CENTRE_NUM, f'({q} * {q})')} * {q} / {horner(normal.CENTRE_DEN, f'({q} * {q})')} end"
    )


TAILS = {
    "constant": ("lo0", "hi0"),
    "delta_additive": ("c + (olow - mlow)", "c + (oup - mup)"),
    "delta_scaling": ("c * (olow / nullif(mlow, 0))", "c * (oup / nullif(mup, 0))"),
    "distribution": tuple(2 * [f"mean + (case when om = n then sd end) * ({normal_sql('y')})"]),
}


def corrected(rule: str = "delta_additive", precip: bool = False, intermittency: bool = True, up: str | None = None) -> str:
    low_value, up_value = TAILS[rule]
    wet = " and c > 0" if precip else ""
    value = (
        f"case when y < 1e0 / (n + 1){wet} then {low_value} "
        f"when y > n / (n + 1){wet} then {up or up_value} else mapped end"
    )
    if precip:
        value = f"case when y <= dry then 0e0 else {value} end"
        if intermittency:
            value = (
                f"case when c < 0.1 and dry >= mdry then 0e0 "
                f"when c < 0.1 then (case when u <= dry then 0e0 else drawn end) else {value} end"
            )
    return f"case when not usable then null when not varied then mean else {value} end"


STEP = 'issue_year, issue_month, "lead", ens'
PRICE = f"o as (select cell, value from obs), m as (select cell, value from mdl), p as (select cell, {STEP}, value, 0e0 draw from pred),"
PRICE_VIEWS = ["obs", "mdl", "pred"]

ORACLES["qmap_knots"] = with_views(
    ["mdl"],
    f"""s as (select cell, value, row_number() over (partition by cell order by value) - 1 k from mdl),
c as (select cell, count(*) m from mdl group by cell),
i as (select cell, m, unnest(range(1, {NQ + 1})) i from c)""",
    f"""select i.cell, cast(i.i as int) i, {r(f'i.i / {NQ + 1}')} p, {r('(a.value + b.value) / 2')} q from i
join s a on a.cell = i.cell and a.k = (i.i * (m - 1)) // {NQ + 1}
join s b on b.cell = i.cell and b.k = (i.i * (m - 1) + {NQ}) // {NQ + 1}""",
)
ORACLES["rank_space"] = with_views(PRICE_VIEWS, PRICE + mapping_ctes("cell"), f"select cell, {STEP}, {r('c')} clamped, {r('y')} rank from res")
ORACLES["qmap"] = with_views(PRICE_VIEWS, PRICE + mapping_ctes("cell"), f"select cell, {STEP}, {r('value')} as value, {r('mapped')} mapped from res")
for name, rule in TAIL_QUERIES.items():
    ORACLES[name] = with_views(PRICE_VIEWS, PRICE + mapping_ctes("cell", 0.01), f"select cell, {STEP}, {r(corrected(rule))} corrected from full_res")

RAIN = """o as (select cell, value from rain where role = 'obs'), m as (select cell, value from rain where role = 'mdl'),
p as (select cell, event_id, value, ((cell * 7919 + lead * 10473 + event_id * 1299) % 10007) / 10007e0 draw from rain where role = 'pred'),"""


def rain(body: str, extra: str = "") -> str:
    return with_views(["rain"], RAIN + mapping_ctes("cell") + extra, body)


ORACLES["qmap_events"] = rain(f"select cell, event_id, {r('y')} rank, {r('mapped')} mapped from res")
ORACLES["dry_zero"] = rain(f"select cell, event_id, {r(corrected(precip=True, intermittency=False))} corrected from full_res")
ORACLES["intermittency_dry"] = rain(f"select cell, event_id, {r(corrected(precip=True))} corrected from full_res where dry >= mdry")
ORACLES["intermittency_wet"] = rain(f"select cell, event_id, {r(corrected(precip=True))} corrected from full_res where dry < mdry")
DRY = "avg(case when value < 0.1 then 1 else 0 end) filter (role = '{}')"
ORACLES["dry_share"] = with_views(["rain"], "", f"select cell, {r(DRY.format('obs'))} dry_obs, {r(DRY.format('mdl'))} dry_mdl from rain group by 1")

# Newton on the scale equation, bracket-free, started from the moment estimate
steps = ["gf0 as (select cell, max(value) top, max(value) - avg(value) mx, stddev_pop(value) * sqrt(6e0) / pi() s from o group by cell)"]
for k in range(12):
    steps.append(
        f"""gf{k + 1} as (select cell, top, mx, greatest(s - (s - mx + w1 / w0) / (1 + (w2 / w0 - (w1 / w0) * (w1 / w0)) / (s * s)), s / 2) s from (
  select f.cell, any_value(top) top, any_value(mx) mx, any_value(s) s, sum(exp(-(top - value) / s)) w0,
    sum(exp(-(top - value) / s) * (top - value)) w1, sum(exp(-(top - value) / s) * (top - value) * (top - value)) w2
  from o join gf{k} f on o.cell = f.cell group by f.cell))"""
    )
steps.append("gl as (select f.cell, any_value(s) scale, any_value(top) + any_value(s) * ln(avg(exp(-(top - value) / s))) loc from o join gf12 f on o.cell = f.cell group by f.cell)")
steps.append("gr as (select full_res.*, loc, scale from full_res left join gl on full_res.cell = gl.cell)")
GUMBEL = corrected("constant", True, up="case when y > 0 and y < 1 then loc + scale * ln(-ln(1 - y)) end").replace("then lo0", "then mapped")
ORACLES["tail_gumbel"] = rain(f"select cell, event_id, {r(GUMBEL)} corrected from gr", ",\n" + ",\n".join(steps))
ORACLES["tail_gumbel_cells"] = with_views(
    PRICE_VIEWS, PRICE + mapping_ctes("cell") + ",\n" + ",\n".join(steps), f"select cell, {STEP}, {r(GUMBEL)} corrected from gr"
)

ORACLES["positions_events"] = with_views(
    ["rain"],
    "",
    f"""select cell, {r('value')} x, cast(s as bigint) "start", cast(s + n as bigint) stop, {r('nx')} next_x, m from (
select cell, value, count(*) n, coalesce(sum(count(*)) over (partition by cell order by value rows between unbounded preceding and 1 preceding), 0) s,
  lead(value) over (partition by cell order by value) nx, cast(sum(count(*)) over (partition by cell) as bigint) m
from rain group by cell, value)""",
)
ORACLES["bc_guards"] = with_views(
    [],
    """e as (select user_id, event_id, event_type, case when user_id % 10 <> 0 then floor(value / (1 + user_id % 12)) end v from events),
o as (select user_id, v as value from e where event_type in ('view','click')), m as (select user_id, v as value from e where event_type in ('purchase','signup')),
p as (select user_id, event_id, v as value, 0e0 draw from e where event_type = 'error'),"""
    + mapping_ctes("user_id"),
    f"select user_id, event_id, usable, varied, {r(corrected())} corrected from full_res",
)

# ------------------------------------------------------------------ calendar windows

DAY = 'cast(dayofyear(make_date(1995, issue_month, 1) + "lead") as int)'
SUMMARY = f"count(value) n, {r('sum(value)')} total, {r('min(value)')} lowest"
RING = """((({doy} - t.d + 15) % {len}) + {len}) % {len} <= 30"""
YEAR_DAYS = "dayofyear(make_date(cast(year({0}) as int), 12, 31))"
TARGETS = f't as materialized (select distinct cell, issue_month, "lead", {DAY} d from pred)'
OBS_JOIN = "obs join t on obs.cell = t.cell and " + RING.format(doy="dayofyear(valid_date)", len=YEAR_DAYS.format("valid_date"))
ORACLES["obs_window"] = with_views(["obs", "pred"], TARGETS, f"select t.cell, t.issue_month, t.lead, {SUMMARY} from {OBS_JOIN} group by 1, 2, 3")
MDL_JOIN = "mdl join t on mdl.cell = t.cell and mdl.issue_month = t.issue_month and abs(mdl.lead - t.lead) <= 15"
ORACLES["mdl_window"] = with_views(["mdl", "pred"], TARGETS, f"select t.cell, t.issue_month, t.lead, {SUMMARY} from {MDL_JOIN} group by 1, 2, 3")
ORACLES["mdl_ring_window"] = with_views(
    ["mdl", "pred"],
    't as (select distinct cell, issue_month, "lead", dayofyear(make_date(2000, issue_month, 1) + "lead") d from pred), h as (select *, make_date(issue_year, issue_month, 1) + "lead" dt from mdl)',
    f"select t.cell, t.issue_month, t.lead, {SUMMARY} from h join t on h.cell = t.cell and "
    + RING.format(doy="dayofyear(dt)", len=YEAR_DAYS.format("dt"))
    + " group by 1, 2, 3",
)
ORACLES["fixed_ring_window"] = with_views(
    ["obs", "pred"],
    TARGETS + ', days as (select cell, issue_month, "lead", (d + s + 365) % 365 + 1 doy from t, (select unnest(range(-15, 16)) s))',
    f"select t.cell, t.issue_month, t.lead, {SUMMARY} from obs join days t on obs.cell = t.cell and dayofyear(valid_date) = t.doy group by 1, 2, 3",
)

BCSD = (
    TARGETS
    + f""",
o as materialized (select t.cell, t.issue_month, t.lead, value from {OBS_JOIN}),
m as materialized (select t.cell, t.issue_month, t.lead, value from {MDL_JOIN}),
p as (select cell, {STEP}, value, 0e0 draw from pred),"""
    + mapping_ctes("cell,issue_month,lead")
)
FULL = f"select cell, {STEP}, {r('y')} rank, {r(corrected())} corrected from full_res"
ORACLES["bcsd_full"] = ORACLES["bcsd_full_rows"] = with_views(PRICE_VIEWS, BCSD, FULL)
# each predicted year is a group of its own, which its own year's rows do not join
CROSS = (
    TARGETS.replace("select distinct cell", "select distinct issue_year, cell").replace("from pred", "from mdl")
    + f""",
o as materialized (select t.cell, t.issue_year, t.issue_month, t.lead, value from {OBS_JOIN} and year(obs.valid_date) <> t.issue_year),
m as materialized (select t.cell, t.issue_year, t.issue_month, t.lead, value from {MDL_JOIN} and mdl.issue_year <> t.issue_year),
p as (select cell, {STEP}, value, 0e0 draw from mdl),"""
    + mapping_ctes("cell,issue_year,issue_month,lead")
)
ORACLES["bcsd_crossval"] = ORACLES["bcsd_crossval_rows"] = with_views(["obs", "mdl"], CROSS, f"select cell, {STEP}, {r(corrected())} corrected from full_res")

# ------------------------------------------------------------------ monthly products

ISSUED = "cell, make_date(issue_year, issue_month, 1) issue_date, ens, cast(date_trunc('month', make_date(issue_year, issue_month, 1) + \"lead\") as date) month_start"
MM = f"mm as (select {ISSUED}, avg(value) as value from {{0}} group by all)"
MR = "mr as (select cell, cast(date_trunc('month', valid_date) as date) month_start, avg(value) as value from obs group by all)"
ORACLES["monthly_mean_ens"] = with_views(["mdl"], MM.format("mdl"), f"select cell, issue_date, ens, month_start, {r('value')} as value from mm")
ORACLES["monthly_mean_ref"] = with_views(["obs"], MR, f"select cell, month_start, {r('value')} as value from mr")
ORACLES["monthly_series"] = with_views(
    ["mdl"], MM.format("mdl"), f"select cell, issue_date, ens, month_start, {r('value')} as value from mm where (month(month_start) - month(issue_date) + 12) % 12 < 5"
)
CORRECTED = BCSD + f", fr as (select cell, {STEP}, {corrected()} as value from full_res), " + MM.format("fr")
ORACLES["monthly_mean_corrected"] = with_views(PRICE_VIEWS, CORRECTED, f"select cell, issue_date, ens, month_start, {r('value')} as value from mm")
ORACLES["clim_ref"] = with_views(["obs"], "", f"select cell, cast(month(valid_date) as int) as month, {r('avg(value)')} as value from obs group by 1, 2")
ORACLES["clim_fcst"] = with_views(
    ["mdl"],
    "",
    f"select cell, ens, issue_month, cast(month(make_date(issue_year, issue_month, 1) + \"lead\") as int) as month, {r('avg(value)')} as value from mdl group by all",
)
PROBS = {"q20": 0.2, "q40": 0.4, "q60": 0.6, "q80": 0.8, "q33": 0.33, "q66": 0.66, "q10": 0.1, "q90": 0.9}


def quantile_columns(wrap=r) -> str:
    return ", ".join(f"{wrap(f'quantile_cont(value, {p}::double)')} {name}" for name, p in PROBS.items())


def thresholds(source: str) -> str:
    return f"select cell, cast(month(month_start) as int) as month, {quantile_columns()} from {source} group by 1, 2"


ORACLES["thresholds_ref"] = with_views(["obs"], MR, thresholds("mr"))
ORACLES["thresholds_fcst"] = with_views(
    ["mdl"], MM.format("mdl"), f"select cell, cast(month(issue_date) as int) issue_month, cast(month(month_start) as int) as month, {quantile_columns()} from mm group by 1, 2, 3"
)
ORACLES["thresholds_corrected"] = with_views(PRICE_VIEWS, CORRECTED, thresholds("mm"))
ORACLES["thresholds_events"] = with_views(["rain"], "", f"select cell, cast(cell % 3 + 1 as int) as month, {quantile_columns()} from rain group by 1, 2")

# ------------------------------------------------------------------ ensemble and categories


def stats(source: str, keys: str, wrap=r) -> str:
    """Midpoint IQR from ranks, the rest from aggregates."""
    pick = lambda h: f"(max(case when k = floor({h} * (m - 1)) then value end) + max(case when k = ceil({h} * (m - 1)) then value end)) / 2"
    return (
        f"select {keys}, {wrap('avg(value)')} mean, {wrap('median(value)')} median, {wrap('stddev_pop(value)')} std, "
        f"{wrap(pick('0.75') + ' - ' + pick('0.25'))} iqr, {wrap('max(value) - min(value)')} spread from "
        f"(select *, row_number() over (partition by {keys} order by value) - 1 k, count(value) over (partition by {keys}) m from {source}) group by {keys}"
    )


ORACLES["ens_stats"] = with_views(["pred"], MM.format("pred"), stats("mm", "cell, month_start"))
ORACLES["ens_stats_daily"] = with_views(["pred"], "", stats("pred", 'cell, issue_year, issue_month, "lead"'))
CLIM = "cl as (select cell, month(valid_date) mon, avg(value) clim from obs group by 1, 2)"
MEANS = (
    MM.format("pred") + ", " + CLIM
    + ", a as (select mm.cell, month_start, avg(value) mean, median(value) med, any_value(clim) clim from mm join cl on mm.cell = cl.cell and month(month_start) = mon group by 1, 2)"
)
ORACLES["anomaly"] = with_views(["obs", "pred"], MEANS, f"select cell, month_start, {r('mean - clim')} anomaly from a")
ORACLES["anomaly_rel"] = with_views(
    ["obs", "pred"], MEANS, f"select cell, month_start, {r('(mean / clim - 1) * 100')} mean_rel, {r('(med / clim - 1) * 100')} median_rel from a"
)

CONDITIONS = {
    "extreme": ["value < q10", "value > q90"],
    "quintile": ["value < q20", "value >= q20 and value < q40", "value >= q40 and value < q60", "value >= q60 and value < q80", "value >= q80"],
    "tercile": ["value < q33", "value >= q33 and value < q66", "value >= q66"],
}


def counted(unit: str = "1") -> str:
    """mm, mr, th and ct: members per category and month."""
    sums = ", ".join(
        f"sum(case when {c} then 1 else 0 end) {p}_{k}" for p, cs in CONDITIONS.items() for k, c in enumerate(cs, 1)
    )
    return (
        MM.format("pred").replace("avg(value)", f"avg(value) / ({unit})").replace("group by all", "group by 1, 2, 3, 4")
        + ", "
        + MR.replace("avg(value)", f"avg(value) / ({unit})").replace("group by all", "group by 1, 2")
        + f", th as (select cell, month(month_start) mon, {quantile_columns(lambda x: x)} from mr group by 1, 2)"
        + f", ct as (select mm.cell, month_start, any_value(issue_date) issue_date, any_value(q90) q90, {sums} from mm left join th on mm.cell = th.cell and month(month_start) = mon group by 1, 2)"
    )


def prob(product: str, k: int, mask: str = "true") -> str:
    return f"(case when {mask} then {product}_{k} / 7 * 100 end)"


def best(product: str, mask: str = "true") -> tuple[str, str]:
    """(category, probability) by comparing each category with all earlier and later ones."""
    ps = [prob(product, k, mask) for k in range(1, len(CONDITIONS[product]) + 1)]
    top = f"greatest({', '.join(ps)})"
    cases = " ".join(f"when {p} = {top} then {k}" for k, p in enumerate(ps, 1))
    return f"(case when {ps[0]} is null then null {cases} end)", f"(case when {ps[0]} is null then null else {top} end)"


def code(product: str, sentinel: str = "equal", wet: bool = False, mask: str = "true") -> str:
    category, top = best(product, mask)
    text = f"{category} + (case when {top} = 100 then 99.99e0 else {top} end) / 100"
    limit = {"quintile": 25, "tercile": 35}.get(product)
    if limit:
        text = f"case when {top} {'<=' if sentinel == 'below' else '='} {limit} then -0.5e0 else {text} end"
    return f"case when q90 < 1 then -0.5e0 else {text} end" if wet else text


for product in CONDITIONS:
    rows = " union all ".join(
        f"select cell, month_start, {k} category, cast({product}_{k} as bigint) members from ct" for k in range(1, len(CONDITIONS[product]) + 1)
    )
    ORACLES[f"cat_{product}"] = with_views(["obs", "pred"], counted(), rows)
ORDER = ("tercile", "quintile", "extreme")
ORACLES["cat_best"] = with_views(
    ["obs", "pred"], counted(), "select cell, month_start, " + ", ".join(f"{r(best(p)[1])} {p}_prob, {best(p)[0]} {p}_category" for p in ORDER) + " from ct"
)
ORACLES["cat_encoded"] = with_views(
    ["obs", "pred"], counted(), "select cell, month_start, " + ", ".join(f"{r(code(p, s))} {p}_{s}" for p in ORDER for s in ("equal", "below")) + " from ct"
)
FIRST = "(first_ens.v is not null)"
MASKED = (
    counted("20000e0 * (1 + cell % 5)")
    + """, fe as (select cell, issue_date, case when cell % 4 = 0 and month(month_start) in (1, 4) and ens = 1 then null else value end v,
  row_number() over (partition by cell, issue_date order by month_start, ens) k from mm), first_ens as (select * from fe where k = 1)"""
)
ORACLES["cat_masked"] = with_views(
    ["obs", "pred"],
    MASKED,
    f"select ct.cell, month_start, {FIRST} present, "
    + ", ".join(f"{r(code(p, wet=True, mask=FIRST))} {p}" for p in ORDER)
    + " from ct join first_ens on ct.cell = first_ens.cell and ct.issue_date = first_ens.issue_date",
)
ORACLES["valid_cell_mask"] = with_views(
    ["mdl"],
    MM.format("mdl"),
    """select cell, issue_date, v is not null present from (select cell, issue_date, case when cell % 3 <> 0 then value end v,
row_number() over (partition by cell, issue_date order by month_start, ens) k from mm) where k = 1""",
)


def even(x: str, digits: int) -> str:
    return f"round_even(round({x}, 6) * {10 ** digits}e0, 0) / {10 ** digits}e0"


def evaluation(unit: str = "1", wet: bool = False) -> str:
    clim = CLIM.replace("avg(value)", f"avg(value / ({unit}))")
    measures = [
        ("mean", 1, "ensemble_mean"),
        ("median", 1, "ensemble_median"),
        ("spread", 1, "ensemble_spread"),
        ("std", 1, "ensemble_std"),
        ("iqr", 1, "ensemble_iqr"),
        ("mean - clim", 1, "ensemble_anomaly"),
        ("(mean / clim - 1) * 100", 1, "ensemble_mean_relative"),
        (code("tercile", wet=wet), 2, "tercile_probab"),
        (code("quintile", wet=wet), 2, "quintile_probab"),
        (code("extreme", wet=wet), 2, "extreme_probab"),
        (prob("tercile", 3), 1, "above_normal_probab"),
        (prob("tercile", 1), 1, "below_normal_probab"),
        (prob("extreme", 2), 1, "extreme_high_probab"),
        (prob("extreme", 1), 1, "extreme_low_probab"),
    ]
    return with_views(
        ["obs", "pred"],
        counted(unit) + ", " + clim + ", st as (" + stats("mm", "cell, month_start", lambda x: x) + ")",
        "select ct.cell, issue_date, ct.month_start, "
        + ", ".join(f"{even(x, n)} {name}" for x, n, name in measures)
        + " from ct join st on ct.cell = st.cell and ct.month_start = st.month_start join cl on ct.cell = cl.cell and month(ct.month_start) = mon",
    )


DRY_UNIT = "20000e0 * (1 + cell % 5)"
ORACLES["eval_product"] = evaluation()
ORACLES["eval_precip"] = evaluation(DRY_UNIT, True)
ORACLES["cat_nominal"] = with_views(
    ["obs", "pred"],
    counted(),
    f"""select cell, month_start, cast(issue_date + to_months(case when cell % 2 = 1 then 204 else 0 end) as date) issue_date,
{r("tercile_3 / (case when year(issue_date) + (cell % 2) * 17 < 2017 then 25 else 51 end) * 100")} above from ct""",
)
TWENTY = (
    """mm as (select cast(s_nationkey as int) cell, cast(date_trunc('month', l_shipdate) as date) issue_date, l_orderkey % 20 ens,
  cast(date_trunc('month', l_shipdate) as date) month_start, max(l_extendedprice) as value from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2, 3, 4)"""
    + counted()[counted().index(", mr as") :]
)


def of_twenty(sql: str) -> str:
    return sql.replace("/ 7 * 100", "/ 20 * 100")


ORACLES["cat_sentinel"] = with_views(
    ["obs"], TWENTY, of_twenty("select cell, month_start, " + ", ".join(f"{r(code(p, s))} {p}_{s}" for p in ("tercile", "quintile") for s in ("equal", "below")) + " from ct")
)
ORACLES["normals_store"] = with_views(
    ["obs"],
    MR + ", " + CLIM + f", th as (select cell, month(month_start) mon, {quantile_columns(lambda x: x)} from mr group by 1, 2)",
    f"""select 10e0 + th.cell // 5 lat, -8e0 + 4 * (th.cell % 5) lon, cast(th.mon as int) as month, {r('clim')} clim, {r('q20')} q20, {r('q33')} q33, {r('q90')} q90
from th join cl on th.cell = cl.cell and th.mon = cl.mon""",
)

# ------------------------------------------------------------------ raw fields

RAW = "raw as (select cast(event_id // 10965 as int) issue, event_id % 10965 pos, value from events)"
ORACLES["deinterleave"] = with_views([], RAW, f"select issue, pos, cast(pos % 51 as int) ens, cast(pos // 51 as int) lead, {r('value')} as value from raw")
ORACLES["deaccumulate"] = with_views(
    [],
    RAW,
    f"""select a.issue, cast(a.pos % 51 as int) ens, cast(a.pos // 51 as int) lead, {r('a.value - coalesce(b.value, 0)')} as value
from raw a left join raw b on a.issue = b.issue and b.pos = a.pos - 51""",
)
ORACLES["raw_to_daily"] = with_views(
    [],
    """raw as (select case when event_id % 97 = 0 then null when event_id % 2 = 0 then 'tp' else 't2m' end v, event_id % 2 side, event_id // 21930 k,
  (event_id // 2) % 10965 % 51 ens, (event_id // 2) % 10965 // 51 as "lead",
  case when event_id % 101 = 0 or event_id % 103 = 0 then null when event_id % 97 <> 0 and event_id % 2 = 0 then value * 1000 else value end as value
  from events where event_id % 89 <> 0),
head as (select v, side, k, ens, min("lead") first from raw group by all)""",
    f"""select a.v as variable, cast(date '2000-01-01' + to_months(cast(a.k as int)) as date) issue_date, cast(a.ens as int) ens, cast(a.lead as int) "lead", 2.5e0 + a.side lon,
cast(cast(date '2000-01-01' + to_months(cast(a.k as int)) as date) + cast(a.lead as int) as date) valid_date,
{r("case when a.v = 'tp' and a.lead > first then a.value - b.value else a.value end")} as value
from raw a join head h on a.v is not distinct from h.v and a.side = h.side and a.k = h.k and a.ens = h.ens
left join raw b on a.v = b.v and a.side = b.side and a.k = b.k and a.ens = b.ens and b.lead = a.lead - 1""",
)
ORACLES["prepare"] = with_views(
    [],
    """raw as (select event_id % 25 // 5 y, event_id % 5 x, event_id // 25 // 10965 k, event_id // 25 % 10965 % 51 ens, event_id // 25 % 10965 // 51 as "lead", value * 1000 as value from events),
src as (select a.y, a.x, a.k, a.ens, a.lead, case when a.lead = 0 then a.value else a.value - b.value end v
  from raw a left join raw b on a.y = b.y and a.x = b.x and a.k = b.k and a.ens = b.ens and b.lead = a.lead - 1),
field as (select distinct k, ens, "lead" from src),
tg as (select 11e0 + i lat, -5e0 + j lon, 1e0 + i fy, (j + 3) / 4e0 fx from generate_series(0, 4) a(i), generate_series(0, 14) b(j)),
cr as (select tg.*, floor(fy) + dy y, floor(fx) + dx x, (case dy when 0 then 1 - (fy - floor(fy)) else fy - floor(fy) end) * (case dx when 0 then 1 - (fx - floor(fx)) else fx - floor(fx) end) w
  from tg, (select unnest([0, 1]) dy), (select unnest([0, 1]) dx))""",
    f"""select lat, lon, cast(date '2000-01-01' + to_months(cast(f.k as int)) as date) issue_date, cast(f.ens as int) ens, cast(f.lead as int) "lead",
{r('case when bool_and(w = 0 or v is not null) then sum(case when w > 0 then w * v end) end')} as value
from cr cross join field f left join src on src.k = f.k and src.ens = f.ens and src.lead = f.lead and src.y = cr.y and src.x = cr.x group by all""",
)
ORACLES["drop_auxiliary"] = "select l_orderkey, l_linenumber, l_quantity from lineitem"
ORACLES["lon_wrap"] = with_views(["grid"], "", "select lat_idx, lon_idx, case when lon >= 180 then lon - 360 else lon end lon from grid")
ORACLES["bbox_halo"] = with_views(
    ["grid"],
    "w as (select lat_idx, lon_idx, lat, case when lon >= 180 then lon - 360 else lon end lon, value from grid)",
    f"select lat_idx, lon_idx, lat, lon, {r('value')} as value from w where lon >= -4 and lon <= 4 and lat >= 10 and lat <= 13",
)
KIND = "case l_linenumber % 3 when 0 then 'tp' when 1 then 't2m' else 'ssrd' end"
ORACLES["units"] = f"""select l_orderkey, l_linenumber, {KIND} as variable,
{r('case l_linenumber % 3 when 0 then l_extendedprice * 1000 when 1 then l_extendedprice else l_extendedprice / 86400 end')} as value from lineitem"""
ORACLES["rename_variables"] = """select case l_linenumber when 1 then 'tp' when 2 then 't2m' when 3 then 't2min' when 4 then 't2max'
when 5 then 'ssrd' when 6 then 't2m' else 'rh' end as variable, count(*) n from lineitem group by 1"""
T = "(250e0 + l_quantity)"
ORACLES["ranges"] = f"select l_orderkey, l_linenumber, {r(f'({T} + 100 * l_discount) - {T}')} t2plus, {r(f'{T} - ({T} - 100 * l_tax)')} t2minus from lineitem"
ORACLES["ranges_inverse"] = f"select l_orderkey, l_linenumber, {r(f'{T} + 100 * l_discount')} t2max, {r(f'{T} - 100 * l_tax')} t2min from lineitem"
PACKED = "round_even((250e0 + l_quantity + l_extendedprice / 7777 - 273.15e0) / 0.01e0, 0)"
ORACLES["pack"] = f"select l_orderkey, l_linenumber, case when l_discount < 0.095 then cast({PACKED} as int) else -9999 end packed from lineitem"
ORACLES["unpack"] = f"select l_orderkey, l_linenumber, {r(f'case when l_discount < 0.095 then {PACKED} * 0.01e0 + 273.15e0 end')} as value from lineitem"
ORACLES["missing"] = f"""select l_linenumber, count(v) n, {r('avg(v)')} mean, {r('max(v)')} top from (
select l_linenumber, case when l_discount < 0.02 or l_tax < 0.02 then null else l_quantity end v from lineitem) group by 1"""
ORACLES["half_even"] = "select l_orderkey, l_linenumber, round_even(l_quantity / 4, 1) one, round_even(l_quantity / 40, 2) two from lineitem"
ORACLES["clamp"] = "select l_orderkey, l_linenumber, case when l_discount > 0.01 then (case when l_quantity < 10 then 10e0 when l_quantity > 40 then 40e0 else l_quantity end) end as value from lineitem"

# ------------------------------------------------------------------ periods and dates

ORD = "od as (select o_orderkey, o_custkey, cast(o_orderdate as date) dt, make_date(cast(year(o_orderdate) as int), cast(o_custkey % 12 + 1 as int), 1) issue from orders)"
LEAD = "cast((month(dt) - month(issue) + 12) % 12 as int)"


def orders(body: str) -> str:
    return with_views([], ORD, body)


ORACLES["period_filter"] = orders("select o_orderkey, dt as date from od where year(dt) in (1996, 1997, 1998) and month(dt) in (2, 5, 11)")
ORACLES["eval_period"] = orders(
    """select cast(year(dt) as int) as year, count(*) filter (year(dt) = 1997 and month(dt) = 3) as month,
count(*) filter (year(dt) in (1995, 1996)) as years, count(*) filter (year(dt) in (1996, 1997)) as calibration from od group by 1"""
)
ORACLES["month_set"] = orders(f"select o_orderkey, cast(month(issue) as int) issue_month, {LEAD} lead_month from od where {LEAD} < 8")
ORACLES["eval_months"] = orders(
    f'select cast(month(issue) as int) issue_month, count(*) filter (month(dt) <= 7) as calendar, count(*) filter ({LEAD} < 7) as "lead" from od group by 1'
)
ORACLES["valid_date"] = orders("select o_orderkey, cast(o_custkey % 215 as int) as \"lead\", cast(dt + cast(o_custkey % 215 as int) as date) valid_date from od")
ORACLES["day_number"] = orders("select o_orderkey, cast(dt - date '1950-01-01' as int) n, dt back from od")
ORACLES["calendar_parts"] = orders(
    """select o_orderkey, cast(year(dt) as int) y, cast(month(dt) as int) m, cast(dayofyear(dt) as int) doy,
cast(make_date(cast(year(dt) as int) + 1, 1, 1) - make_date(cast(year(dt) as int), 1, 1) as int) year_days, cast(date_trunc('month', dt) as date) month_start from od"""
)
ORACLES["flatten_5d"] = orders("select o_orderkey, cast(cast(date_trunc('month', dt) as date) + cast(o_custkey % 215 as int) as date) valid_date from od")

# ------------------------------------------------------------------ variables and grids

LONG = "lo as (select l_orderkey, case l_linenumber % 3 when 0 then 't2m' when 1 then 't2max' else 't2min' end variable, max(l_quantity) as value from lineitem group by 1, 2)"
WIDE = LONG + ", wi as (pivot lo on variable in ('t2m', 't2max', 't2min') using first(value) group by l_orderkey)"
ORACLES["pivot_vars"] = with_views([], WIDE, "select l_orderkey, t2m, t2max, t2min from wi")
ORACLES["unpivot_vars"] = with_views(
    [], LONG, "select k.l_orderkey, n.variable, lo.value from (select distinct l_orderkey from lo) k cross join (select unnest(['t2m', 't2max', 't2min']) variable) n left join lo on lo.l_orderkey = k.l_orderkey and lo.variable = n.variable"
)
ORACLES["var_join"] = with_views([], WIDE, "select l_orderkey, t2m, t2max, t2min, t2max - t2m t2plus from wi")
ORACLES["add_ranges"] = with_views(
    [],
    WIDE,
    " union all ".join(
        f"select l_orderkey, '{n}' as variable, {x} as value from wi"
        for n, x in (("t2m", "t2m"), ("t2max", "t2max"), ("t2min", "t2min"), ("t2plus", "t2max - t2m"), ("t2minus", "t2m - t2min"))
    ),
)
ORACLES["target_grid"] = with_views(
    ["grid"],
    "b as (select min(lon - 360 * (case when lon >= 180 then 1 else 0 end)) w, max(lon - 360 * (case when lon >= 180 then 1 else 0 end)) e, min(lat) s, max(lat) n from grid)",
    """select cast(i as int) lat_idx, cast(j as int) lon_idx, s + i * 0.5e0 lat, w + j * 0.5e0 lon from b, generate_series(0, 200) a(i), generate_series(0, 200) c(j)
where i <= (n - s) / 0.5 and j <= (e - w) / 0.5""",
)
ORACLES["regrid_bilinear"] = with_views(
    [],
    """src as (select c_mktsegment seg, c_nationkey // 5 y, c_nationkey % 5 x, case when c_mktsegment <> 'BUILDING' or c_nationkey <> 12 then max(c_acctbal) end v from customer group by c_mktsegment, c_nationkey),
seg as (select distinct c_mktsegment seg from customer),
tg as (select i, j, 10 + i * 0.5e0 lat, -8 + j * 0.5e0 lon, i * 0.5e0 fy, j * 0.125e0 fx from generate_series(0, 8) a(i), generate_series(0, 32) b(j)),
cr as (select tg.*, floor(fy) + dy y, floor(fx) + dx x, (case dy when 0 then 1 - (fy - floor(fy)) else fy - floor(fy) end) * (case dx when 0 then 1 - (fx - floor(fx)) else fx - floor(fx) end) w
  from tg, (select unnest([0, 1]) dy), (select unnest([0, 1]) dx))""",
    f"""select cast(i as int) lat_idx, cast(j as int) lon_idx, lat, lon, seg.seg c_mktsegment, {r('case when bool_and(w = 0 or v is not null) then sum(case when w > 0 then w * v end) end')} as value
from cr cross join seg left join src on src.seg = seg.seg and src.y = cr.y and src.x = cr.x group by 1, 2, 3, 4, 5""",
)

SEGMENTS = """src as (select c_mktsegment seg, c_nationkey // 5 y, c_nationkey % 5 x, case when c_mktsegment <> 'BUILDING' or c_nationkey <> 12 then max(c_acctbal) end v from customer group by c_mktsegment, c_nationkey),
seg as (select distinct c_mktsegment seg from customer),
"""
CORNERS = f"""select {{}} seg.seg c_mktsegment, {r('case when bool_and(w = 0 or v is not null) then sum(case when w > 0 then w * v end) end')} as value
from cr cross join seg left join src on src.seg = seg.seg and src.y = cr.y and src.x = cr.x group by all"""
ORACLES["regrid_global"] = with_views(
    [],
    SEGMENTS
    + """tg as (select i, j, -75 + i * 15e0 lat, -180 + j * 15e0 lon, (i * 15e0 - 15) / 30 fy, ((180 + j * 15) % 360) / 72e0 fx from generate_series(0, 10) a(i), generate_series(0, 24) b(j)),
cr as (select i, j, lat, lon, floor(fy) + dy y, (floor(fx) + dx) % 5 x, (case dy when 0 then 1 - (fy - floor(fy)) else fy - floor(fy) end) * (case dx when 0 then 1 - (fx - floor(fx)) else fx - floor(fx) end) w
  from tg, (select unnest([0, 1]) dy), (select unnest([0, 1]) dx))""",
    CORNERS.format("cast(i as int) lat_idx, cast(j as int) lon_idx, lat, lon,"),
)
ORACLES["regrid_irregular"] = with_views(
    [],
    SEGMENTS
    + """la as (select * from (values (-1, 90e0, 59.75e0), (0, 59.75e0, 31.25e0), (1, 31.25e0, 0.5e0), (2, 0.5e0, -28.5e0), (3, -28.5e0, -61e0), (4, -61e0, -90e0)) t(y, a, b)),
lo as (select * from (values (4, -59e0, 5e0), (0, 5e0, 47e0), (3, -160e0, -59e0)) t(x, a, b)),
tg as (select -66 + i * 6e0 lat, -75 + j * 6e0 lon from generate_series(0, 22) a(i), generate_series(0, 17) b(j)),
bx as (select lat, lon, y, (la.a - lat) / (la.a - la.b) fy, x, (lon - lo.a) / (lo.b - lo.a) fx from tg join la on lat <= la.a and lat > la.b join lo on lon >= lo.a and lon < lo.b),
cr as (select lat, lon, y + dy y, (x + dx) % 5 x, (case dy when 0 then 1 - fy else fy end) * (case dx when 0 then 1 - fx else fx end) w
  from bx, (select unnest([0, 1]) dy), (select unnest([0, 1]) dx))""",
    CORNERS.format("lat, lon,"),
)

# ------------------------------------------------------------------ sources and sinks

PLACED = "pl as (select cell, 10e0 + cell // 5 lat, -8e0 + 4 * (cell % 5) lon, valid_date from history)"
ORACLES["axes"] = with_views(
    ["history"],
    PLACED,
    """select distinct 'lat' axis, lat "at" from pl union all select distinct 'lon', lon from pl
union all select distinct 'time', cast(valid_date - date '1950-01-01' as double) from pl""",
)
ORACLES["coverage"] = with_views(
    ["history"], PLACED, 'select min(lon) lon_min, max(lon) lon_max, min(lat) lat_min, max(lat) lat_max, min(valid_date) "start", max(valid_date) stop from pl'
)
SAME = f"select cell, valid_date, {r('value')} as value from history"
ORACLES["append_idempotent"] = with_views(["history"], "", SAME)
ORACLES["replace_store"] = with_views(["history"], "", SAME + " where month(valid_date) <= 6")
for name, whole in (("layout_series", "cell"), ("layout_map", "valid_date")):
    ORACLES[name] = with_views(
        ["history"], "", f"select {whole}, cast(1 as bigint) n_files, true in_order, true in_one_piece, count(*) n, {r('max(value)')} top from history group by 1"
    )
ORACLES["roundtrip_packed"] = with_views(["history"], "", f"select cell, valid_date, {r('round_even(value / 0.01e0, 0) * 0.01e0')} as value from history")
STORED = """st as (select case when cell % 2 = 0 then 'tp' else 'ssrd' end as variable, make_date(issue_year, issue_month, 1) issue_date,
  cast(make_date(issue_year, issue_month, 1) + "lead" as date) valid_date, ens, cast(cell as double) lat,
  case when cell % 7 <> 3 then round_even(value / 0.01e0, 0) * 0.01e0 end as value from mdl)"""
ORACLES["roundtrip_issue"] = with_views(["mdl"], STORED, f"select variable, issue_date, valid_date, ens, lat, {r('value')} as value from st")
ORACLES["period_partition"] = with_views(
    ["mdl"],
    STORED,
    """select case when year(issue_date) = 1999 then '1999_1999' else 'calib' end period, variable, cast(year(issue_date) as int) issue_year,
cast(month(issue_date) as int) issue_month, count(*) n, count(value) n_value from st where year(issue_date) between 1996 and 1999 group by all""",
)
ORACLES["scan_store"] = with_views(
    ["history"],
    "",
    f"select cell, valid_date, case when day(valid_date) not in (3, 5) then {r('value')} end as value from history where year(valid_date) in (1996, 1997) and month(valid_date) in (6, 7)",
)
ORACLES["scan_members"] = f"select cast(user_id % 7 as int) ens, event_id, {r('value')} as value from events"
ORACLES["scan_members_mixed"] = ORACLES["scan_members"]
ORACLES["relay_in_place"] = ORACLES["layout_map"]
ORACLES["thresholds_incremental"] = ORACLES["thresholds_ref"]
ORACLES["scan_cells"] = with_views(["history"], "", SAME + " join nation on cell = n_nationkey where n_regionkey = 1")

# ------------------------------------------------------------------ dates as text, on both sides

DATES = {
    "month_start": "monthly_mean_ens monthly_mean_ref monthly_mean_corrected monthly_series ens_stats anomaly anomaly_rel "
    "cat_extreme cat_quintile cat_tercile cat_best cat_encoded cat_masked cat_sentinel cat_nominal eval_product eval_precip calendar_parts",
    "issue_date": "monthly_mean_ens monthly_mean_corrected monthly_series valid_cell_mask eval_product eval_precip cat_nominal raw_to_daily prepare roundtrip_issue",
    "valid_date": "raw_to_daily valid_date flatten_5d roundtrip_packed roundtrip_issue append_idempotent replace_store layout_map scan_store relay_in_place scan_cells",
    "date": "period_filter",
    "back": "day_number",
    "start": "coverage",
    "stop": "coverage",
}
for name in list(ORACLES):
    dates = [c for c, users in DATES.items() if name in users.split()]
    if dates:
        text = ", ".join(f'cast("{c}" as varchar) as "{c}"' for c in dates)
        ORACLES[name] = f"select * replace ({text}) from ({ORACLES[name]})"
