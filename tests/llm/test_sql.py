"""The registered queries that SQL can express, against that SQL over the whole test tables."""

import pytest

from annoloom.llm.queries import ORACLE, QUERIES
from tests.compare import duck, duck_rows, spark_rows


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, key):
    assert spark_rows(QUERIES[key](spark, sf_dir)) == duck_rows(duck(sf_dir), ORACLE[key])


def test_thirteen_queries():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
