"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from shelfwatch.plans.oracles import ORACLES
from shelfwatch.plans.queries import QUERIES

from .oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


#: Fits of deep trees, which SQL cannot state; test_models.py holds them against other fits and the rules.
WITHOUT_SQL = {"train_regressor", "search_params"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) | WITHOUT_SQL and not WITHOUT_SQL & set(ORACLES)


def test_fits_without_sql(spark):
    rows = {r["split"]: r for r in QUERIES["train_regressor"](spark, SF_DIR).collect()}
    assert rows.keys() == {"train", "valid"} and rows["train"]["rmse"] < rows["train"]["plain_rmse"] and 1 <= rows["train"]["rounds"] <= 10
    trials = QUERIES["search_params"](spark, SF_DIR).collect()
    assert [sum(r["rung"] == n for r in trials) for n in range(3)] == [20, 7, 3]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
    assert entry.queries().keys() >= QUERIES.keys() and entry.oracle_sql().keys() >= ORACLES.keys()
