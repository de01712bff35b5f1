"""Every registered query against its SQL twin."""

import os

import pytest

from tests import oracle
from veristar.plans.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got, want = df.toPandas(), con.sql(ORACLES[name])
    assert oracle.type_difference(df, want) is None
    assert oracle.difference(got, want.df()) is None
    assert len(got) > 0


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"model_sentiment", "train_models", "score_batch"}


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 200
