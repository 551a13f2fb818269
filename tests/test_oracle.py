"""Every registered query against its SQL, over the whole smallest driver tables."""

import os

import pytest

from checks.compare import compare, connect
from checks.oracle import SQL
from checks.queries import REGISTERED

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables here")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert sorted(SQL) == sorted(REGISTERED)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_same_rows_as_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) is None
