"""From stores to the evaluation product, on a small domain."""

import datetime as dt
import random
from dataclasses import replace

import numpy as np
import pytest

from caelum.config import CorrectionParams, Domain
from caelum.plans import products as P

YEARS = range(2000, 2006)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(9)
    ref, past, new = [], [], []
    for lat, lon in ((1.0, 2.0), (1.0, 2.1)):
        for year in YEARS:
            day = dt.date(year, 1, 1)
            while day.year == year:
                ref.append(("t2m", day, lat, lon, round(280 + rnd.gauss(0, 5), 2)))
                day += dt.timedelta(days=1)
            for lead in range(70):
                for ens in range(3):
                    past.append(("t2m", dt.date(year, 1, 1), lead, ens, lat, lon, round(283 + rnd.gauss(0, 7), 2)))
        for lead in range(70):
            for ens in range(25):
                new.append(("t2m", dt.date(2010, 1, 1), lead, ens, lat, lon, round(283 + rnd.gauss(0, 7), 2)))
    cols = "variable string, issue_date date, lead int, ens int, lat double, lon double, value double"
    return (
        spark.createDataFrame(new, cols),
        spark.createDataFrame(ref, "variable string, valid_date date, lat double, lon double, value double"),
        spark.createDataFrame(past, cols),
    )


def test_chain(spark, data, tmp_path):
    new, ref, past = data
    domain = Domain("d", (2.0, 2.1, 1.0, 1.0), ("t2m",), syr=2000, eyr=2005)
    domain = replace(domain, params=CorrectionParams(nquants=200))
    P.write_reference(ref, str(tmp_path / "ref"))
    P.write_issue(past, str(tmp_path / "past"), domain)
    P.write_issue(past.where("issue_date = '2003-01-01'"), str(tmp_path / "past"), domain)
    history = P.reference(spark, str(tmp_path / "ref"), "t2m", domain)
    hind = P.hindcast(spark, str(tmp_path / "past"), "t2m", 1, domain)
    assert history.count() == ref.count() and hind.count() == past.count()

    fixed = P.correct_variable(new, history, hind, domain, "t2m")
    rows = fixed.toPandas()
    assert len(rows) == new.count() and rows["value"].notna().all()
    # the bias of three degrees and the too wide spread are gone
    assert abs(rows["value"].mean() - 280) < 0.5 and abs(rows["value"].std() - 5) < 0.5

    P.write_issue(fixed, str(tmp_path / "out"), domain)
    stored = P.read_issues(spark, str(tmp_path / "out"))
    months = P.monthly_forecast(stored)
    clim, limits = P.normals(history)
    got = P.evaluate_variable(months, clim, limits, "t2m").toPandas()
    assert len(got) == 2 * 3 and list(got["month_start"].astype(str).unique()) != []
    want = rows.assign(m=rows["valid_date"].astype(str).str[:7])
    means = want.groupby(["lat", "lon", "m", "ens"])["value"].mean().groupby(["lat", "lon", "m"]).mean()
    for _, r in got.iterrows():
        assert r["ensemble_mean"] == pytest.approx(means[r["lat"], r["lon"], str(r["month_start"])[:7]], abs=0.0551)
        assert 0 <= r["above_normal_probab"] <= 100 and np.floor(r["tercile_probab"]) in (-1, 1, 2, 3)
    assert P.forecast_thresholds(months).count() == 2 * 3


def test_crossval_chain(spark, data):
    """Correcting a hindcast year with and without itself in the samples differs."""
    _, ref, past = data
    domain = Domain("d", (2.0, 2.1, 1.0, 1.0), ("t2m",), syr=2000, eyr=2005, params=CorrectionParams(nquants=100))
    one = past.where("issue_date = '2002-01-01'")
    keys = ["lat", "lon", "lead", "ens"]
    every = P.correct_variable(past, ref, past, domain, "t2m", crossval=True).where("issue_date = '2002-01-01'")
    every = every.toPandas().set_index(keys)["value"].sort_index()
    a = P.correct_variable(one, ref, past, domain, "t2m", crossval=True).toPandas().set_index(keys)["value"]
    b = P.correct_variable(one, ref, past, domain, "t2m").toPandas().set_index(keys)["value"]
    without = past.where("issue_date <> '2002-01-01'")
    c = P.correct_variable(one, ref.where("year(valid_date) <> 2002"), without, domain, "t2m").toPandas().set_index(keys)["value"]
    assert (a.sort_index() != b.sort_index()).any()
    assert np.allclose(a.sort_index(), c.sort_index()) and np.allclose(every, c.sort_index())
