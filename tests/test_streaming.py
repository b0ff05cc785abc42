"""Arriving staging files are loaded one micro-batch each, idempotently."""

from pyspark.sql import functions as F

from dimforge.context import DEFAULT_CONTEXT
from dimforge.plans import account, fixtures as fx
from dimforge.session import scratch_path
from dimforge.sources.sinks import read_versioned, snapshot_versions
from dimforge.streaming import account_loader, run_on_arrivals


def test_two_arriving_files_give_two_versions(spark, sf_dir):
    staged = fx.stg_account(spark, sf_dir)
    src = scratch_path(spark, "arrivals")
    first = staged.where(F.substring("account_name", -1, 1).isin("0", "2", "4", "6", "8"))
    first.coalesce(1).write.parquet(f"{src}/f1")
    second = staged.withColumn("account_name", F.concat(F.col("account_name"), F.lit(" v2")))
    target_root = scratch_path(spark, "account-dim")
    ckpt = scratch_path(spark, "arrivals-ckpt")

    q = run_on_arrivals(spark, f"{src}/*", staged.schema, ckpt, account_loader(spark, target_root, DEFAULT_CONTEXT))
    q.awaitTermination(300)
    second.coalesce(1).write.parquet(f"{src}/f2")
    q = run_on_arrivals(spark, f"{src}/*", staged.schema, ckpt, account_loader(spark, target_root, DEFAULT_CONTEXT))
    q.awaitTermination(300)

    assert len(snapshot_versions(spark, target_root)) == 2
    state = read_versioned(spark, target_root, account.TARGET_SCHEMA)
    cur = state.where("is_current")
    assert cur.groupBy("customer_id").count().where("count > 1").count() == 0
    valid = account.prepare_batch(staged).incoming.count()
    assert cur.count() == valid
    assert cur.where(F.col("customer_name").endswith(" v2")).count() == valid
    assert state.where(~F.col("is_current")).count() == first.where("account_id is not null").count() - \
        account.prepare_batch(first).bad_revenue.count()


def test_replayed_micro_batch_leaves_the_table_unchanged(spark, sf_dir):
    """A micro-batch handed over again after a failure gets the same batch id
    and time, and rewrites only its own folders with the same rows."""
    staged = fx.stg_account(spark, sf_dir)
    root = scratch_path(spark, "replay-dim")
    handle = account_loader(spark, root, DEFAULT_CONTEXT)
    handle(staged, 0)
    first = sorted(read_versioned(spark, root, account.TARGET_SCHEMA).collect())
    handle(staged, 0)  # replay of the same epoch
    again = sorted(read_versioned(spark, root, account.TARGET_SCHEMA).collect())
    assert snapshot_versions(spark, root) == [DEFAULT_CONTEXT.batch_id]
    assert first == again
