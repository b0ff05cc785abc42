"""The README's "Running a load" example, run for two batches."""

from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.plans import account
from dimforge.plans import fixtures as fx
from dimforge.session import scratch_path
from dimforge.sources.scans import typed_parquet
from dimforge.sources.sinks import publish_versioned, read_versioned, write_rejections

COLUMNS = [("account_id", "string"), ("account_name", "string"), ("industry", "string"),
           ("annual_revenue", "string"), ("created_date", "timestamp_ntz"), ("last_modified_date", "timestamp_ntz")]


def test_two_batches_published_and_read_back(spark, sf_dir):
    staging, target_root, rejects = (scratch_path(spark, n) for n in ("rd-staging", "rd-target", "rd-rejects"))
    fx.stg_account(spark, sf_dir).write.parquet(staging)
    valid = account.prepare_batch(fx.stg_account(spark, sf_dir)).incoming.count()
    for batch_id, ts, suffix in ((20250102, "2025-01-02 06:00:00", ""), (20250103, "2025-01-03 06:00:00", " II")):
        ctx = RunContext(batch_id=batch_id, batch_ts=ts, batch_date=ts[:10], job="ods_load")
        staged = typed_parquet(spark, staging, COLUMNS).withColumn(
            "account_name", F.concat("account_name", F.lit(suffix)))
        target = read_versioned(spark, target_root, account.TARGET_SCHEMA)
        batch, result = account.load_account(target, staged, ctx)
        account.check_next_state(result)
        publish_versioned(target_root, ctx.batch_id, result.next_current(), result.expired)
        write_rejections(batch.rejections(ctx), rejects)
    state = read_versioned(spark, target_root, account.TARGET_SCHEMA)
    assert state.where("is_current").count() == valid
    assert state.count() == 2 * valid
    assert state.where("is_current and customer_name like '% II'").count() == valid
    assert spark.read.parquet(rejects).count() == 2 * (fx.stg_account(spark, sf_dir).count() - valid)
