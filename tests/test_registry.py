import os

import pytest

import __spark_entry__ as entry
from tidemark.plans import REGISTRY
from tests import parity
from tidemark.session import scratch_dir

SF_DIR = f"{parity.TESTDATA}/sf0.001"
# Found only in larger tables.
MAY_BE_EMPTY = {"duplicate_trade_keys", "duplicate_keys", "sustained_breaches"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    return parity.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, database, name):
    good, note = parity.compare(spark, database, name, SF_DIR)
    assert good or (name in MAY_BE_EMPTY and note == "0 rows"), note


def test_every_query_has_sql():
    assert all(q.sql for q in REGISTRY.values())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scratch_folders_are_shared_and_fresh(spark):
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))
