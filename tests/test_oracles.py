"""Every query with a SQL twin returns the same rows; the others return some."""

import pytest

import __spark_entry__ as entry
import check
from labelmill.plans.queries import QUERIES



@pytest.fixture(scope="session")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, name):
    assert check.compare(spark, con, sf_dir, name) == ""


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = {r["metric"]: r for r in entry.entry(spark).collect()}
    assert rows["Duplicate rows"]["after"] == 0
    assert {r["verdict"] for r in rows.values()} == {"better"}
