"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tools.check_oracle import connect, difference

SF_DIR = contract.SMOKE_DIR

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


#: Those of the optional subpackage have tests of their own.
NAMES = [name for name in contract.queries() if name not in contract.LLM_QUERIES]


def test_every_query_has_sql():
    assert set(NAMES) == set(contract.oracle_sql()) - set(contract.LLM_SQL)


@pytest.mark.parametrize("name", NAMES)
def test_same_result(spark, db, name):
    assert difference(spark, db, name, SF_DIR) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
