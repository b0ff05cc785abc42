"""Same results with 1 and 64 shuffle partitions; a key holding a third of
the rows is cut before it is shuffled."""

import pytest
from pyspark.sql import functions as F

from dimforge.operators.keys import latest_per_key
from dimforge.operators.quality import duplicate_keys

KEYS = ["scd2_next_state", "latest_per_key", "dedup_natural_key", "supersede_expire", "surrogate_keys",
        "lookup_enrich", "reversal_load", "held_update_next_state", "type1_upsert", "audit_summary"]


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_results_do_not_depend_on_partitioning(spark, sf_dir, partitions):
    from tools.oracle_check import check

    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        res = check(spark, sf_dir, KEYS, verbose=False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    bad = {k: r for k, r in res.items() if not (r.get("hash_ok") and r.get("schema_ok"))}
    assert not bad, bad


def _hot(spark, n=30000):
    # one key holds a third of all rows
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string"))).alias("k"),
        F.col("id"))


def test_hot_key_latest_is_limited_before_the_shuffle(spark):
    df = _hot(spark)
    out = latest_per_key(df, ["k"], [F.col("id").desc()])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    got = {r.k: r.id for r in out.collect()}
    assert got["HOT"] == 29997 and len(got) == 1 + 1000 - 334 + 334  # every key once


def test_hot_key_counts_use_partial_aggregation(spark):
    out = duplicate_keys(_hot(spark), "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert {r.k: r.n_rows for r in out.collect()}["HOT"] == 10000
