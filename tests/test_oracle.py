"""Every registered query against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as E
from oracle_check import compare
from tollgate.plans.catalog import ORACLE_SQL, QUERIES

from conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_id", "year_month", "total_amount", "num_services", "rate_plan_id"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, name, SF_SMALL, QUERIES[name], ORACLE_SQL[name])
    assert res["status"] == "match", res
