"""Every registered query equals its SQL on the given tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registry  # noqa: E402
from oracle import compare, connect  # noqa: E402

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    df = registry.queries()[name](spark, FOLDER)
    assert compare(con, df, registry.oracle_sql()[name]) == []


def test_every_query_outside_the_training_data_package_has_sql():
    from caseloom.catalog import load

    assert set(load()) <= set(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).limit(1).count() == 1
