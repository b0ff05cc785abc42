"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

from __spark_entry__ import oracle_sql, queries

KEYS = sorted(oracle_sql())


def test_every_load_query_has_an_oracle():
    from dimforge.plans.queries import QUERIES

    # queries that SQL cannot express are named, with their plain versions, beside the operators' tests
    assert set(QUERIES) <= set(KEYS) <= set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, sf_dir, key):
    from tools.oracle_check import check

    rec = check(spark, sf_dir, [key], verbose=False)[key]
    assert "error" not in rec, rec.get("error")
    assert rec["rows"] == rec["oracle_rows"], rec
    assert rec["schema_ok"], rec
    assert rec["hash_ok"], rec


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "customer_account_sk" in df.columns
