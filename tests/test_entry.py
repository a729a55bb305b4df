import pytest

import __spark_entry__ as entry
import verify
from flowsight.plans import tables
from tests.conftest import SMALL

# the window job refuses parts with fewer than five windows of a label, which the smallest tables have
LARGER = {"window_measures_check": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def db():
    return verify.connect(SMALL)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_counterpart_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    folder = LARGER.get(name, SMALL)
    assert verify.compare(spark, verify.connect(folder) if name in LARGER else db, name, folder) == ""


@pytest.mark.parametrize("name", sorted(tables.SCHEMAS))
def test_given_tables_have_the_stated_columns(spark, name):
    assert spark.read.parquet(f"{SMALL}/{name}.parquet").schema == tables.SCHEMAS[name]
