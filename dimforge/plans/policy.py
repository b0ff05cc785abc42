"""Policy detail from the trade file: five lookups, carry-forward, hash
compare, versioned append and supersede."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.functions.columns import derived_status, first_known, first_seen, safe_date, sticky, when_codes
from dimforge.operators import quality
from dimforge.operators.keys import count_and_high_water, latest_per_key, surrogate_keys
from dimforge.operators.lookup import Lookup, enrich
from dimforge.operators.schema import blank_to_null
from dimforge.session import reliable_checkpoint
from dimforge.operators.scd_hash import (HashScd2Spec, changed_or_new, identify, in_force, inactivation_rows,
                                         open_versions, supersede)

SPEC = HashScd2Spec(
    keys=("src_sys", "plcy_mastr_id"),
    sk="plcy_detl_id",
    hashed=("plcy_iss_dt", "plcy_status_id", "custdn_firm_nm"),
)

PLAN_CD = "INVESTMENTS"
ENTITY = "trade"
# Action codes for which the account open date becomes the policy inception date.
INCEPTION_CODES = ("O", "U", "R")


def latest_trade_per_account(stg: DataFrame) -> DataFrame:
    """Newest created date first, a reversal ('R') before other codes on the
    same date, then the highest trade id."""
    r_first = F.when(F.col("sc_trx_actn_cd") == "R", F.lit(1)).otherwise(F.lit(2))
    return latest_per_key(stg, ["acct_num"], [F.col("created_dt").desc(), r_first.asc(), F.col("trade_id").desc()])


def policy_source(stg: DataFrame) -> DataFrame:
    return latest_trade_per_account(stg).select(
        "src_sys", "acct_num", "sc_trx_actn_cd", "created_dt",
        safe_date("btch_dt").alias("btch_dt"), F.lit(PLAN_CD).alias("plan_cd"))


def first_trade_lookup(trade_summary: DataFrame) -> DataFrame:
    """Latest first-trade flag row per account, by batch date then created date."""
    flagged = trade_summary.where(F.col("frst_trd_acct_cd") == "Y")
    latest = latest_per_key(flagged, ["acct_num"], [safe_date("btch_dt").desc(), F.col("created_dt").desc(),
                                                      F.col("trade_id").desc()])
    return latest.select(safe_date("created_dt").alias("trd_dt"), "acct_num", "frst_trd_acct_cd")


def customer_lookup(cstmr: DataFrame, ctx: RunContext) -> DataFrame:
    """Customer attributes: '' to NULL, derived policy status."""
    c = blank_to_null(cstmr, ["custdn_firm_mnm"])
    return c.select(
        "acct_num", "state_nm", "acct_closg_dt", "acct_open_dt", "custdn_firm_mnm",
        F.lit(PLAN_CD).alias("plan_cd"),
        derived_status("acct_closg_dt", ctx.date()).alias("plcy_status"),
    )


def enriched(stg: DataFrame, cstmr: DataFrame, master: DataFrame, products: DataFrame, statuses: DataFrame,
             ctx: RunContext, newest: DataFrame | None = None) -> DataFrame:
    """The newest trade per account with the five lookups; ``newest`` are those trades where a step has them already."""
    src = policy_source(stg if newest is None else newest)
    cust = customer_lookup(cstmr, ctx)
    lookups = [
        Lookup(master.where(F.col("src_sys") == ctx.source_system), on=[("acct_num", "plcy_num")],
               columns={"plcy_mastr_id": "plcy_mastr_id"}, unique_by=[F.col("plcy_mastr_id").desc()]),
        Lookup(products, on=[("plan_cd", "plan_cd")], columns={"src_prod_mastr_id": "src_prod_mastr_id"},
               defaults={"src_prod_mastr_id": -99}, unique_by=[F.col("src_prod_mastr_id").desc()]),
        Lookup(cust, on=[("acct_num", "acct_num")],
               columns={"state_nm": "state_nm", "acct_closg_dt": "acct_closg_dt", "acct_open_dt": "acct_open_dt",
                        "custdn_firm_mnm": "cust_custdn_firm_nm", "plcy_status": "cust_plcy_status"},
               unique_by=[F.col("state_nm").desc_nulls_last(), F.col("acct_closg_dt").desc_nulls_last()]),
        Lookup(first_trade_lookup(stg), on=[("acct_num", "acct_num")], columns={"trd_dt": "frst_trd_dt"}),
        Lookup(statuses, on=[("cust_plcy_status", "src_sys_ref_cd")], columns={"ref_id": "plcy_status_id"},
               defaults={"plcy_status_id": -99}, null_equals="-", unique_by=[F.col("ref_id").desc()]),
    ]
    e = enrich(src, lookups)
    return e.select(
        "src_sys", "acct_num", "plcy_mastr_id", "src_prod_mastr_id",
        F.col("btch_dt").alias("src_btch_dt"), "frst_trd_dt",
        when_codes("sc_trx_actn_cd", INCEPTION_CODES, safe_date("acct_open_dt")).alias("cust_plcy_incptn_dt"),
        F.lit(-99).alias("lob_mastr_id"),
        "plcy_status_id",
        F.coalesce(F.col("state_nm"), F.lit("N/A")).alias("cust_plcy_iss_state_cd"),
        F.lit("N/A").alias("resdnt_state_cd"),
        safe_date("acct_closg_dt").alias("plcy_trmntn_dt"),
        F.lit(None).cast("string").alias("plcy_nm"),
        "cust_custdn_firm_nm",
        F.lit("Y").alias("actv_indctr"),
    )


def split_unmatched(lkp: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a policy, rows whose account has no policy master row)."""
    return quality.split_null_keys(lkp, "plcy_mastr_id")


def carry_forward(j: DataFrame) -> dict:
    tk = f"tgt_{SPEC.sk}"
    return {
        "plcy_iss_dt": first_seen(tk, "tgt_plcy_iss_dt", "src_btch_dt"),
        "custdn_firm_nm": sticky(tk, "tgt_custdn_firm_nm", "cust_custdn_firm_nm"),
        "first_depst_dt": first_known(tk, "tgt_first_depst_dt", "frst_trd_dt", "src_btch_dt"),
    }


def identified(lkp: DataFrame, target: DataFrame, small: bool | None = None) -> DataFrame:
    """Batch rows with a policy, joined to the version in force (``small``: the
    caller's bound on the batch, e.g. ``trade.staged_is_small``)."""
    matched, _ = split_unmatched(lkp)
    return identify(matched, in_force(target, SPEC), SPEC, carry=carry_forward, small=small)


TARGET_COLUMNS = ("plcy_detl_id", "plcy_mastr_id", "src_sys", "plcy_iss_dt", "custdn_firm_nm", "plcy_status_id",
                  "first_depst_dt", "actv_indctr", "eff_from_dt", "eff_to_dt", "btch_id", "crtd_by", "crtd_dt", "mdfd_by", "mdfd_dt",
                  "hash_key")


VERSION_COLUMNS = ("plcy_mastr_id", "src_sys", "plcy_iss_dt", "custdn_firm_nm", "plcy_status_id", "first_depst_dt",
                   "hash_key")


def version_rows(ident: DataFrame, ctx: RunContext) -> DataFrame:
    """Changed or new rows stamped as open versions (no surrogate key yet)."""
    rows = changed_or_new(ident, SPEC).select(*VERSION_COLUMNS)
    return open_versions(rows, SPEC, ctx, f"{ctx.job}-{ENTITY}")


def number_versions(stamped: DataFrame, target: DataFrame) -> DataFrame:
    """Surrogate keys above the target's high-water mark, in policy order.

    The stamped rows (batch-sized) are checkpointed once: the numbering, the
    touched-key probe and the next state all read them, and each read would
    otherwise rerun the lookups.
    """
    return number_versions_counted(stamped, target)[0]


def number_versions_counted(stamped: DataFrame, target: DataFrame) -> tuple[DataFrame, int]:
    """``number_versions`` plus the number of versions (one job counts the
    rows and reads the high-water mark)."""
    stamped = reliable_checkpoint(stamped)
    n, hwm = count_and_high_water(stamped, target, SPEC.sk)
    numbered = surrogate_keys(stamped, ["plcy_mastr_id", "src_sys"], SPEC.sk, start=hwm)
    return numbered.select(*TARGET_COLUMNS), n


def new_versions(ident: DataFrame, target: DataFrame, ctx: RunContext) -> DataFrame:
    return number_versions(version_rows(ident, ctx), target)


def new_versions_counted(ident: DataFrame, target: DataFrame, ctx: RunContext) -> tuple[DataFrame, int]:
    return number_versions_counted(version_rows(ident, ctx), target)


def next_state(target: DataFrame, versions: DataFrame, ctx: RunContext, n_versions: int | None = None
               ) -> DataFrame:
    """Target plus the new versions, older active versions of the touched keys closed."""
    return supersede(target.select(*TARGET_COLUMNS).unionByName(versions), SPEC, ctx, f"{ctx.job}-{ENTITY}",
                     touched=versions, touched_rows=n_versions)


def file_scope(ctx: RunContext) -> Column:
    """Target rows a full file speaks for: those of its source system."""
    return F.col("src_sys") == ctx.source_system


def full_file_changes(target: DataFrame, ident: DataFrame, batch_keys: DataFrame, ctx: RunContext,
                      ) -> tuple[DataFrame, int]:
    """Full file: new versions plus an inactivation version ('D') for every
    active key of the file's source system missing from it, numbered together; with their count."""
    gone = inactivation_rows(target.select(*TARGET_COLUMNS), batch_keys, SPEC, ctx, f"{ctx.job}-{ENTITY}",
                             scope=file_scope(ctx))
    stamped = version_rows(ident, ctx).unionByName(gone.select(*version_rows(ident, ctx).columns))
    return number_versions_counted(stamped, target)
