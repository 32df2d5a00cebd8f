"""Every registered query against its SQL twin on the small tables."""

import pytest

import __spark_entry__ as entry_point
import compare

SF = "/root/testdata/sf0.001"
EMPTY_HERE = {"log_rate_anomalies"}  # too few hours per host on the smallest tables


@pytest.fixture(scope="module")
def duck():
    return compare.oracle(SF)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_sql_twin(spark, duck, name):
    verdict = compare.compare(spark, duck, SF, name)
    assert verdict is None or (verdict == "both empty" and name in EMPTY_HERE), verdict


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql())))
def test_rows_only(spark, name):
    assert entry_point.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
