"""Every registered query against its SQL twin."""

from pathlib import Path

import pytest

from compare import database, differences
from souk.plans.oracle import oracle_sql
from souk.plans.queries import queries

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_a_twin():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", queries())
def test_same_result(spark, con, name):
    assert differences(queries()[name](spark, FOLDER), oracle_sql()[name], con) == ""
