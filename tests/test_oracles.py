"""Every registered query against its SQL oracle on the smallest tables."""

import pytest
from compare import compare, duck
from conftest import SF

import __spark_entry__ as driver
from plumbline.plans.queries import REGISTRY

ORACLES = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) >= set(REGISTRY) and set(ORACLES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare(driver.queries()[name](spark, SF), con, ORACLES[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() == 21 * 15
