"""Every registered query against its SQL, over whole tables."""

import oracle
import pytest

import __spark_entry__ as entry_module
from docstream.plans import catalogue, oracles

QUERIES = catalogue.queries()
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    columns, found = oracle.spark_rows(QUERIES[name](spark, sf_dir))
    expected_columns, expected = oracle.sql_rows(con, SQL[name])
    assert columns == expected_columns
    assert found == expected
    assert found


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_reference_figures(spark):
    """Figures worked out independently for the middle data set."""
    sf_dir = "/root/testdata/sf0.01"
    outcomes = {r["outcome"]: r["n_records"] for r in QUERIES["decode_classify"](spark, sf_dir).collect()}
    assert outcomes == {"ok": 9518, "decode_error": 391, "reject_error": 91}
    summary = QUERIES["lag_summary"](spark, sf_dir).first()
    assert summary["total_lag"] == 15847
    assert summary["max_partition_lag"] == 603
    assert summary["most_behind_partition"] == "view-5:KafkaImporterGroup:events"
    assert QUERIES["commit_ledger_daily"](spark, sf_dir).count() == 1498
    assert QUERIES["current_docs"](spark, sf_dir).count() == 150
