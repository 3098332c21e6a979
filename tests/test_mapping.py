import math
import random

import pytest
from pyspark.sql import functions as F

from caelum.config import CorrectionParams
from caelum.functions.sorted_arrays import last_at_most, last_below, more_distinct_than
from caelum.operators import mapping, value_lists, windows
from caelum.operators.quantiles import distinct_knots, positions
from caelum.plans import bias_correction
from caelum.plans.bias_correction import bias_correct, correct_groups
from tests.brute import correct

SCHEMA = "g int, value double"


def samples(seed):
    """Groups with ties, missing values, few values, none at all, dry days, and long tails."""
    rnd = random.Random(seed)
    rain = lambda k, dry: [0.0 if rnd.random() < dry else round(rnd.expovariate(0.2), 2) for _ in range(k)]
    temp = lambda k, mu: [round(rnd.gauss(mu, 4), 2) for _ in range(k)]
    obs = {
        1: temp(60, 10),
        2: [float(v) for v in list(range(1, 12)) + [12, 12, 12]],
        3: [None] * 20,
        4: [float(i % 10) for i in range(50)],
        5: rain(80, 0.3),
        6: rain(80, 0.7),
        7: temp(40, 5) + [None, None],
        9: [float(i) for i in range(10)] + [None],
        10: rain(61, 0.0),
    }
    mdl = {
        1: temp(301, 13),
        2: [float(v) for v in range(1, 200)],
        3: temp(50, 3),
        4: temp(50, 3),
        5: rain(300, 0.6),
        6: rain(300, 0.3),
        7: temp(200, 6),
        8: temp(50, 1),
        9: temp(50, 4),
        10: [float(i) for i in range(1000)] + [None],
    }
    pred = {g: (temp(12, 9) if g in (1, 3, 4, 7, 8, 9) else rain(12, 0.4)) for g in range(1, 11)}
    pred[1] += [1e9, -1e9, None]
    pred[2] = [float(v) for v in range(170, 199)]
    pred[10] += [500.0, 999.0, 0.0, -1.0]
    return obs, mdl, pred


def frames(spark, data):
    obs, mdl, pred = data
    flat = lambda d: spark.createDataFrame([(g, v) for g, vs in d.items() for v in vs], SCHEMA)
    rows = [(g, k, v, ((k * 37 + g * 11) % 100) / 100) for g, vs in pred.items() for k, v in enumerate(vs)]
    return spark.createDataFrame(rows, "g int, k int, value double, draw double"), flat(obs), flat(mdl)


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize(
    "rule,precip", [("delta_additive", False), ("constant", True), ("delta_scaling", True), ("distribution", False)]
)
def test_against_brute_force(spark, rule, precip, bounded):
    """Both routes, the sliced one with slices of a few values."""
    data = samples(7)
    params = CorrectionParams(nquants=101, dry_thresh=0.1, low_extrapol=rule, up_extrapol=rule)
    pred, obs, mdl = frames(spark, data)
    got = correct_groups(pred, obs, mdl, ["g"], ["k"], params, precip, bounded=bounded, slice_rows=9)
    found = {(r["g"], r["k"]): r["corrected"] for r in got.collect()}
    assert len(found) == sum(len(v) for v in data[2].values())
    for g, members in data[2].items():
        draws = [((k * 37 + g * 11) % 100) / 100 for k in range(len(members))]
        want = correct(members, data[0].get(g, []), data[1].get(g, []), params, precip, draws)
        for k, w in enumerate(want):
            v = found[g, k]
            assert (v is None) == (w is None), (g, k, v, w)
            if w is not None:
                assert math.isclose(v, w, rel_tol=1e-7, abs_tol=1e-7), (g, k, v, w)


def test_tied_maximum(spark):
    """Ranks between the first of the tied maxima and n/(n+1) are missing unless filled."""
    pred = spark.createDataFrame([(1, 0, 180.0)], "g int, k int, value double")
    obs = spark.createDataFrame([(1, float(v)) for v in list(range(1, 12)) + [12, 12, 12]], SCHEMA)
    mdl = spark.createDataFrame([(1, float(v)) for v in range(1, 200)], SCHEMA)
    for bounded in (True, False):
        plain = CorrectionParams(nquants=100)
        filled = CorrectionParams(nquants=100, fill_tied_max=True)
        row = correct_groups(pred, obs, mdl, ["g"], ["k"], plain, bounded=bounded).first()
        assert 13 / 15 < row["rank"] < 14 / 15 and row["corrected"] is None
        assert correct_groups(pred, obs, mdl, ["g"], ["k"], filled, bounded=bounded).first()["corrected"] == 12.0


def test_identity_and_order(spark):
    """Equal samples map values onto themselves; the mapping never reverses an order."""
    rnd = random.Random(3)
    sample = [(1, rnd.uniform(0, 100)) for _ in range(200)]
    df = spark.createDataFrame(sample, SCHEMA)
    pred = spark.createDataFrame([(1, k, 5.0 + k) for k in range(90)], "g int, k int, value double")
    rows = correct_groups(pred, df, df, ["g"], ["k"], CorrectionParams(nquants=200)).orderBy("k").collect()
    values = [r["corrected"] for r in rows]
    assert all(abs(r["corrected"] - r["value"]) < 1e-9 for r in rows)
    assert values == sorted(values)


def test_gumbel_routes_agree(spark):
    params = CorrectionParams(nquants=50, up_extrapol="distribution", low_extrapol="distribution")
    pred, obs, mdl = frames(spark, samples(11))
    a = correct_groups(pred, obs, mdl, ["g"], ["k"], params, True, bounded=True)
    b = correct_groups(pred, obs, mdl, ["g"], ["k"], params, True, bounded=False, slice_rows=20)
    j = a.alias("a").join(b.alias("b"), ["g", "k"], "full")
    for c in ("corrected", "gumbel_loc", "gumbel_scale"):
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        assert j.where(~(x.eqNullSafe(y) | F.coalesce(F.abs(x - y) < 1e-6, F.lit(False)))).count() == 0
    loc, scale = a.where("g = 5").select("gumbel_loc", "gumbel_scale").first()
    v = [x for x in samples(11)[0][5]]
    # both likelihood equations hold
    w = [math.exp((x - loc) / scale) for x in v]
    assert math.isclose(sum(w) / len(v), 1, rel_tol=1e-6)
    assert math.isclose(scale, sum(x * e for x, e in zip(v, w)) / sum(w) - sum(v) / len(v), rel_tol=1e-6)


def test_array_search(spark):
    df = spark.createDataFrame([([1.0, 2.0, 2.0, 5.0],), ([],), ([3.0],)], "a array<double>")
    for x, most, below in ((2.0, [2, -1, -1], [0, -1, -1]), (9.0, [3, -1, 0], [3, -1, 0]), (1.0, [0, -1, -1], [-1, -1, -1])):
        got = df.select(F.expr(last_at_most("a", f"{x}D")), F.expr(last_below("a", f"{x}D"))).collect()
        assert [r[0] for r in got] == most and [r[1] for r in got] == below
    assert [r[0] for r in df.select(F.expr(more_distinct_than("a", "2"))).collect()] == [True, False, False]
    assert [r[0] for r in df.select(F.expr(more_distinct_than("a", "3"))).collect()] == [False, False, False]


def calendar_inputs(spark):
    """Two cells, leap and normal years, an issue in December that runs over the year's end."""
    from datetime import date, timedelta

    rnd = random.Random(5)
    obs, mdl, pred = [], [], []
    for cell in (1, 2):
        d = date(1995, 1, 1)
        while d.year < 1999:
            if rnd.random() < 0.6:
                obs.append((cell, d, None if rnd.random() < 0.02 else round(rnd.gauss(10, 3), 2)))
            d += timedelta(days=1)
        for year in range(1995, 1999):
            for lead in range(0, 45):
                for ens in range(2):
                    if rnd.random() < 0.8:
                        mdl.append((cell, year, 12, lead, ens, round(rnd.gauss(12, 4), 2)))
        pred += [(cell, 1999, 12, lead, ens, round(rnd.gauss(12, 4), 2)) for lead in (0, 20, 30, 31, 44) for ens in range(3)]
    cols = "cell int, issue_year int, issue_month int, lead int, ens int, value double"
    return (
        spark.createDataFrame(pred, cols),
        spark.createDataFrame(obs, "cell int, valid_date date, value double"),
        spark.createDataFrame(mdl, cols),
        (pred, obs, mdl),
    )


@pytest.mark.parametrize("bounded", [True, False])
def test_calendar_against_brute_force(spark, bounded):
    from datetime import date, timedelta

    pred, obs, mdl, (p, o, m) = calendar_inputs(spark)
    params = CorrectionParams(nquants=40, window=10, mdl_window=7)
    got = bias_correct(
        pred, obs, mdl, ["cell"], ["issue_year", "ens"], 1995, params, bounded=bounded, slice_rows=25
    )
    found = {(r["cell"], r["lead"], r["ens"]): r["corrected"] for r in got.collect()}
    assert len(found) == len(p)
    for cell, _, _, lead, ens, value in p:
        day = (date(1995, 12, 1) + timedelta(days=lead)).timetuple().tm_yday
        near = []
        for c, d, v in o:
            length = date(d.year, 12, 31).timetuple().tm_yday
            ring = {(day + s - 1) % length + 1 for s in range(-10, 11)}
            if c == cell and d.timetuple().tm_yday in ring:
                near.append(v)
        steps = [v for c, _, _, k, _, v in m if c == cell and abs(k - lead) <= 7]
        want = correct([value], near, steps, params)[0]
        v = found[cell, lead, ens]
        assert (v is None) == (want is None)
        assert want is None or math.isclose(v, want, rel_tol=1e-9)


@pytest.mark.parametrize("slice_rows", [25, 2_000_000])
def test_left_out_years_write_no_row_per_value_and_window(spark, monkeypatch, slice_rows):
    """Cells of any size are cross-validated as bounded ones are, and no table on the way holds a row per value, window and year."""
    _, obs, mdl, (_, o, m) = calendar_inputs(spark)
    zero = F.when(F.col("lead") % 5 == 0, 0.0).when(F.col("lead") % 7 > 0, F.col("value"))  # many copies, some missing
    mdl = mdl.withColumn("value", zero).localCheckpoint()
    params = CorrectionParams(nquants=40, window=10, mdl_window=7)
    args = (mdl, obs, mdl, ["cell"], ["issue_year", "ens"], 1995, params)
    written = {}

    def counting(cut):
        def counted(df, name):
            res = cut(df, name)
            written[name] = res.count()
            return res

        return counted

    for module in (bias_correction, mapping, windows):
        if hasattr(module, "cut"):
            monkeypatch.setattr(module, "cut", counting(module.cut))
    whole = bias_correct(*args, crossval=True, bounded=True).toPandas().set_index(["cell", "issue_year", "lead", "ens"])["corrected"]
    got = bias_correct(*args, crossval=True, slice_rows=slice_rows).toPandas().set_index(["cell", "issue_year", "lead", "ens"])["corrected"]
    assert len(got) == len(whole) == len(m)
    assert whole.notna().sum() > len(m) / 2
    both = whole.to_frame("a").join(got.to_frame("b"))
    assert (both["a"].isna() == both["b"].isna()).all()
    assert (both["a"] - both["b"]).abs().max() < 1e-9
    slices = max(written["obs-slices"], written["mdl-slices"]) if "obs-slices" in written else 0
    assert (slices > 2 * 45 * 4) == (slice_rows == 25)  # cells, leads and years; more only where cells are cut
    most = max(len(o), len(m), slices)
    assert {name: n for name, n in written.items() if n > most} == {}


@pytest.mark.parametrize("scale", [1, 10**12])
def test_knots_of_lists_are_those_of_rows(spark, scale):
    """Slices of lists yield the knots and order statistics that rows do, products beyond 64 bits among them."""
    rnd = random.Random(scale)
    rows = [(g, None if rnd.random() < 0.1 else float(rnd.randrange(size)), rnd.randrange(1, 4) * scale) for g, size in ((1, 90), (2, 9), (3, 400)) for _ in range(120)] + [(4, 2.5, 1)]
    counted = spark.createDataFrame(rows, "g int, value double, copies long").groupBy("g", "value").agg(F.sum("copies").alias("copies"))
    n = 7 * scale
    lists = value_lists.value_lists(counted, ["g"], [], [], 40)
    parts = value_lists.extents(lists, ["g"], 3.0)
    assert parts.count() > 6
    sizes = parts.groupBy("g").agg(F.sum("m_slice").alias("m"), (F.sum("total") / F.sum("m_slice")).alias("mean"))
    sizes = sizes.select("*", F.lit(n).cast("bigint").alias("n"), F.lit(n).cast("bigint").alias("n_obs"))
    present = lists.select("g", "slice", F.filter("held", lambda h: h["x"].isNotNull()).alias("vals"))
    found = value_lists.slice_knots(present.join(value_lists.placed(parts, ["g"]).join(sizes, ["g"]), ["g", "slice"]), ["g"]).cache()
    pos = positions(counted, ["g"], slice_rows=40)
    key = lambda df: sorted((r["g"], r["i"], r["q"], r["n"]) for r in df.collect())
    assert key(value_lists.knot_rows(found, ["g"])) == key(distinct_knots(pos, ["g"], F.lit(n)))
    ends = {r["g"]: r for r in found.groupBy("g").agg(F.sum("up").alias("up"), F.sum("low").alias("low")).collect()}
    at = lambda i: mapping._at_position(i, f"{n}L")
    for r in pos.groupBy("g").agg(at(f"{n}L").alias("up"), at("1L").alias("low")).collect():
        assert (ends[r["g"]]["up"], ends[r["g"]]["low"]) == (r["up"], r["low"])
