"""Every registered query against its SQL on the same tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import difference, oracle_rows, spark_rows
from tests.conftest import SF_DIR


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, name):
    got = spark_rows(queries()[name](spark, SF_DIR))
    assert sum(got[1].values()) > 0
    assert difference(got, oracle_rows(SF_DIR, oracle_sql()[name])) == ""


def test_entry_runs(spark):
    assert entry(spark).count() > 0
