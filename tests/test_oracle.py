"""Every registered query against its comparison SQL."""

import pytest
from workload.compare import check, differences, duck
from workload.oracle import ORACLE
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_comparison_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches(spark, con, sf_dir, name):
    problem, count = check(spark, con, name, sf_dir)
    assert problem is None
    assert count > 0


def test_compare_sees_a_changed_value(spark, con, sf_dir):
    theirs = con.execute(ORACLE["month_counter"]).df()
    changed = theirs.copy()
    changed.loc[0, "month_counter"] += 1
    assert differences(theirs, theirs) is None
    assert differences(theirs, changed) is not None
    assert differences(theirs, theirs.iloc[1:]) is not None
    assert differences(theirs, theirs.rename(columns={"month_counter": "x"})) is not None


def test_entry_runs(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() == 83
