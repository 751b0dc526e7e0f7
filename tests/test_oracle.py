"""Every registered query against its SQL over the whole test tables."""

import pytest

from annoloom.plans.oracle import ORACLE
from annoloom.plans.registry import QUERIES
from tests.compare import duck, duck_rows, spark_rows


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, sf_dir, con, key):
    columns, rows = spark_rows(QUERIES[key](spark, sf_dir))
    want_columns, want = duck_rows(con, ORACLE[key])
    assert columns == want_columns
    assert len(rows) == len(want)
    assert rows == want
    assert rows, "an empty result checks nothing"
