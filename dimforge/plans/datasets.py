"""Dataset specs for the loads the tests and bench run through ``job.run``."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimforge.plans import account, fixtures as fx, policy, trade
from dimforge.plans.job import DatasetSpec, Step


def trade_policy_master(sf_dir: str) -> DatasetSpec:
    """Trade file -> policy master, insert-only.

    The lookup step carries the natural key alone through dedup and the anti join; the constant and audit
    columns are put on the rows that are left.
    """
    return DatasetSpec(
        name="STG_TRADE", target_table="plcy_mastr", load_type=0, natural_key=trade.MASTER_KEY,
        surrogate_key="plcy_mastr_id", entity="trade",
        sources={"time": lambda spark: fx.stg_trade(spark, sf_dir)},
        lookup=Step("lkp", sql="select src_sys, acct_num as plcy_num from {src}"),
        select_fields=Step("final", fn=lambda f, ctx: trade.finished_master(f["sink"], ctx)),
    )


def account_upsert(sf_dir: str) -> DatasetSpec:
    """Account batch -> account table updated in place (type 1)."""
    return DatasetSpec(
        name=account.SOURCE_TABLE, target_table="customer_account_t1", load_type=1, natural_key=("customer_id",),
        surrogate_key=None, entity="account", tracked=("customer_name", "industry", "revenue_usd"),
        sources={"time": lambda spark: fx.stg_account(spark, sf_dir)},
        lookup=Step("lkp", fn=lambda f, ctx: account.prepare_batch(f["src"]).incoming.select(
            "customer_id", "customer_name", "industry", "revenue_usd")),
    )


def account_upsert_target(spark, sf_dir: str):
    t = fx.ods_account(spark, sf_dir).where(F.col("is_current"))
    return t.select("customer_id", "customer_name", "industry", "revenue_usd",
                    F.lit(None).cast("string").alias("mdfd_by"), F.lit(None).cast("timestamp_ntz").alias("mdfd_dt"))


def policy_detail(sf_dir: str) -> DatasetSpec:
    """Trade file -> policy detail, versioned by hash (type 2)."""
    return DatasetSpec(
        name="STG_TRADE", target_table="plcy_detl", load_type=2, natural_key=policy.SPEC.keys,
        surrogate_key=policy.SPEC.sk, entity=policy.ENTITY, hash_spec=policy.SPEC, carry=policy.carry_forward,
        file_scope=policy.file_scope,
        sources={"time": lambda spark: fx.stg_trade(spark, sf_dir),
                 "full": lambda spark: fx.stg_trade(spark, sf_dir)},
        lookups={"cstmr": lambda spark: fx.stg_cstmr(spark, sf_dir),
                 "master": lambda spark: fx.ods_plcy_mastr(spark, sf_dir),
                 "products": fx.src_prod_mastr, "statuses": fx.ref_status},
        temp_steps=[Step("newest", fn=lambda f, ctx: policy.latest_trade_per_account(f["src"]), filters="src")],
        lookup=Step("lkp", fn=lambda f, ctx: policy.enriched(f["src"], f["cstmr"], f["master"], f["products"],
                                                             f["statuses"], ctx, newest=f["newest"])),
        select_fields=Step("final", fn=lambda f, ctx: f["sink"].select(*policy.VERSION_COLUMNS)),
    )


def account_versioned(sf_dir: str) -> DatasetSpec:
    """Account batch -> account dimension, versioned by tracked columns."""
    from dimforge.operators.quality import INVALID_REVENUE_CAST, Rule, bad_cast_condition
    from dimforge.operators.schema import rename

    return DatasetSpec(
        name=account.SOURCE_TABLE, target_table="customer_account", load_type=2, natural_key=("customer_id",),
        surrogate_key=account.ACCOUNT_SPEC.sk, entity="account", scd2_columns=account.ACCOUNT_SPEC,
        duplicates="halt",
        sources={"time": lambda spark: fx.stg_account(spark, sf_dir)},
        reject_rules=[Rule(INVALID_REVENUE_CAST, bad_cast_condition("annual_revenue", "decimal(18,2)"))],
        lookup=Step("lkp", fn=lambda f, ctx: rename(
            f["src"].withColumn("revenue_usd", F.col("annual_revenue").try_cast("decimal(18,2)")), account.MAPPING)),
    )


def trade_policy_master_from_text(path: str, sf_dir: str, delimiter: str = ",") -> DatasetSpec:
    """The insert-only policy-master load reading the trade file as delimited
    text (header, every column text), as staged files arrive."""
    from dimforge.sources.scans import read_delimited

    spec = trade_policy_master(sf_dir)
    spec.sources = {"time": lambda spark: read_delimited(spark, path, TRADE_FILE_COLUMNS, delimiter=delimiter)}
    return spec


# Column order of the trade staging file.
TRADE_FILE_COLUMNS = ("trade_id", "src_sys", "acct_num", "trx_cd", "sc_trx_actn_cd", "amount", "created_dt",
                      "btch_dt", "frst_trd_acct_cd")
