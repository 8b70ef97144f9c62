"""Every query against its SQL twin."""

import __spark_entry__ as driver
import pytest
from checking import connect, differences

from ferrytab.plans.catalogue import QUERIES

ORACLE = driver.oracle_sql()
LIBRARY = sorted(set(QUERIES) & set(driver.queries()))


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(ORACLE)
    assert set(ORACLE) <= set(driver.queries())


@pytest.mark.parametrize("name", LIBRARY)
def test_query(name, spark, sf_dir, connection):
    assert differences(driver.queries()[name](spark, sf_dir), connection, ORACLE[name]) == []


def test_entry(spark):
    report = driver.entry(spark).first()
    assert (report["matched"], report["mismatched"]) == (1450, 34)
    assert (report["missing_in_target"], report["missing_in_source"]) == (16, 15)
