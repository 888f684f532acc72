"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are absent")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


# The pipeline of the corpus operators has tests of its own.
@pytest.mark.parametrize("name", [name for name in QUERIES if name != "pipeline"])
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], ORACLES.get(name)) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["target_id", "pid_order", "pid", "epli", "n_sequences_msa0"] and df.count() > 0
