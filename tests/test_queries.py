"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry
import check
from corpusforge import workloads

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.tables(FOLDER)


@pytest.mark.parametrize("name", workloads.queries())
def test_query_equals_sql(spark, db, name):
    verdict, _ = check.compare(spark, db, FOLDER, name)
    assert verdict.startswith("same"), verdict


def test_every_query_has_sql():
    assert set(workloads.queries()) == set(workloads.oracle_sql())
    assert workloads.queries().keys() <= entry.queries().keys()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["lang", "source", "completions"]
    assert df.count() > 0
