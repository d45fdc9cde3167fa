"""Registered corpus queries against their SQL, over whole tables."""

import oracle
import pytest

from docstream.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    columns, found = oracle.spark_rows(queries.queries()[name](spark, sf_dir))
    assert (columns, found) == oracle.sql_rows(oracle.connect(sf_dir), queries.oracle_sql()[name])
    assert found
