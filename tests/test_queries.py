"""Every registered query against its SQL."""

import pytest
from compare import connect, difference

from quotelake.workload.oracles import ORACLES
from quotelake.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_each_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SF), db, ORACLES[name]) is None
