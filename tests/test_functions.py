import datetime as dt

import pytest
from pyspark.sql import functions as F

from caelum.config import DOMAINS, VARIABLES, CorrectionParams, members_in
from caelum.functions import calendar as cal
from caelum.functions import codec, fields
from caelum.functions.normal import normal_quantile


# Period texts and the years or months they stand for.
@pytest.mark.parametrize(
    "text,want",
    [
        ("2000", [2000]),
        ("2000,0,2010", list(range(2000, 2011))),
        ("2000,2002", [2000, 2002]),
        ("2000,2002,2004", [2000, 2002, 2004]),
        ("01", [1]),
        ("2,0,6", [2, 3, 4, 5, 6]),
        ("01,10", [1, 10]),
        ("4,6,7", [4, 6, 7]),
        ("1,2,3,4", [1, 2, 3, 4]),
    ],
)
def test_period(text, want):
    assert cal.parse_period(text) == want


def test_evaluation_period():
    assert cal.evaluation_period("2019,4", 1981, 2016) == (2019, 2019, 4, 4)
    assert cal.evaluation_period("2017,2019", 1981, 2016) == (2017, 2019, 1, 12)
    assert cal.evaluation_period(None, 1981, 2016) == (1981, 2016, 1, 12)
    with pytest.raises(ValueError):
        cal.evaluation_period("4,2019", 1981, 2016)


def column(spark, values, kind, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_longitude(spark):
    got = column(spark, [0.0, 180.0, 190.0, 359.0, 360.0, -10.0], "double", fields.wrap_longitude)
    assert got == [0, -180, -170, -1, 0, -10]


def test_pack(spark):
    t2m = VARIABLES["t2m"]
    packed = column(spark, [273.154, None, 273.155, 250.0], "double", lambda v: codec.pack(v, t2m))
    assert packed[0] == 0 and packed[1] == -9999 and packed[3] == -2315
    back = column(spark, [273.154, None, 290.0], "double", lambda v: codec.unpack(codec.pack(v, t2m), t2m))
    assert back[1] is None and abs(back[0] - 273.154) <= 0.005 and abs(back[2] - 290) <= 0.005


def test_half_even(spark):
    got = column(spark, [0.25, 0.35, -0.25, 0.75, None], "double", lambda v: codec.half_even(v, 1))
    assert got == [0.2, 0.4, -0.2, 0.8, None]


def test_missing(spark):
    got = column(spark, [float("nan"), -9999.0, 1.0, None], "double", lambda v: codec.missing_to_null(v, -9999))
    assert got == [None, None, 1.0, None]


def test_clamp_keeps_missing(spark):
    got = column(spark, [None, -1.0, 5.0, 99.0], "double", lambda v: codec.clamp(v, F.lit(0.0), F.lit(10.0)))
    assert got == [None, 0.0, 5.0, 10.0]


def test_month_set_wraps_december(spark):
    months = [dt.date(2000, m, 1) for m in range(1, 13)]
    keep = column(spark, months, "date", lambda v: cal.in_month_set(v, F.lit(dt.date(1999, 11, 1))))
    assert [m for m, k in zip(range(1, 13), keep) if k] == [1, 2, 3, 4, 5, 6, 11, 12]


def test_day_number(spark):
    days = [dt.date(1950, 1, 1), dt.date(1949, 12, 31), dt.date(2000, 2, 29)]
    n = column(spark, days, "date", cal.day_number)
    assert n == [0, -1, (days[2] - days[0]).days]
    assert column(spark, n, "int", cal.from_day_number) == days


def test_normal_quantile(spark):
    from statistics import NormalDist

    ps = [0.001, 0.02, 0.02425, 0.3, 0.5, 0.9, 0.99, 0.9999]
    got = column(spark, ps, "double", normal_quantile)
    assert all(abs(g - NormalDist().inv_cdf(p)) < 1e-7 for g, p in zip(got, ps))
    assert column(spark, [0.0, 1.0], "double", normal_quantile) == [None, None]


def test_configuration():
    assert DOMAINS["germany"].params.dry_thresh == 0.1
    assert DOMAINS["ceara"].params.nquants == 2500 and DOMAINS["ceara"].params.window == 15
    assert VARIABLES["tp"].precip and not VARIABLES["t2m"].precip
    assert (members_in(2016), members_in(2017)) == (25, 51)
    with pytest.raises(ValueError):
        CorrectionParams(up_extrapol="none")
