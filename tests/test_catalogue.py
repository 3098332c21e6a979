import pytest

from __spark_entry__ import entry
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES
from tools.compare import connect, difference


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert difference(df, connect(sf_dir), ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
