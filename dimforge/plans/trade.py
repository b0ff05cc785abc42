"""Trade file loads: policy master (insert-only), trade facts with reversals,
positions with held updates, and code checks against the transaction master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.operators import quality
from dimforge.operators.keys import dedup_natural_key, latest_per_key
from dimforge.operators.joins import batch_is_small
from dimforge.operators.lookup import broadcast_if_small
from dimforge.operators.schema import audit_insert_columns, with_defaults
from dimforge.operators.upsert import (apply_updates, held_update_split, hold_updates, insert_only,
                                       reversal_rows)
from dimforge.session import reliable_checkpoint

MASTER_KEY = ("src_sys", "plcy_num")

# Fixed values the policy-master rows carry for a trade source.
MASTER_DEFAULTS = (
    ("src_admn_sys", "SS", "string"),
    ("plcy_comp_cd", "N/A", "string"),
    ("invstmt_comp_tax_id", "N/A", "string"),
    ("case_mastr_id", -99, "int"),
    ("plcy_sold_status_indctr", "P", "string"),
    ("del_indctr", "-99", "string"),
)

MASTER_OUTPUT = ("src_admn_sys", "plcy_comp_cd", "plcy_num", "left_justfd_plcy_num", "btch_id", "crtd_dt",
                 "mdfd_dt", "crtd_by", "mdfd_by", "case_mastr_id", "src_sys", "plcy_sold_status_indctr",
                 "del_indctr", "invstmt_comp_tax_id")


def master_rows(stg: DataFrame) -> DataFrame:
    """Trade file -> policy-master shaped rows (mapping plus constant columns)."""
    src = stg.select("src_sys", "acct_num")
    mapped = src.select("src_sys", F.col("acct_num").alias("plcy_num"), F.col("acct_num").alias("left_justfd_plcy_num"))
    return with_defaults(mapped, MASTER_DEFAULTS)


def finished_master(keys: DataFrame, ctx: RunContext, entity: str = "trade") -> DataFrame:
    """Policy-master rows of new natural keys: constant and audit columns on, in the table's order."""
    rows = with_defaults(keys.withColumn("left_justfd_plcy_num", F.col("plcy_num")), MASTER_DEFAULTS)
    return audit_insert_columns(rows, ctx, f"{ctx.job}-{entity}").select(*MASTER_OUTPUT)


def staged_is_small(stg: DataFrame) -> bool:
    """One bounded probe of the staging file.  Every batch-sized frame derived
    from it (filters, dedup, unique lookups) has at most as many rows, so the
    answer holds for all of them."""
    return batch_is_small(stg.select(F.lit(1).alias("_one")), ["_one"])


def insert_only_master(stg: DataFrame, master: DataFrame, ctx: RunContext, entity: str = "trade") -> DataFrame:
    """Policy-master rows to append: NULL keys out, one row per key, keys
    already in the target out, audit columns on."""
    rows = master_rows(stg)
    rows, _ = quality.split_null_keys(rows, list(MASTER_KEY))
    rows = dedup_natural_key(rows, list(MASTER_KEY))
    current = master.where(F.col("src_sys") == ctx.source_system)
    new = insert_only(rows, current, list(MASTER_KEY), small=staged_is_small(stg))
    return audit_insert_columns(new, ctx, f"{ctx.job}-{entity}").select(*MASTER_OUTPUT)


# ------------------------------------------------------------- trade facts

FACT_KEY = ("acct_num", "trx_cd")


def trade_fact_rows(stg: DataFrame, ctx: RunContext) -> DataFrame:
    """Trade file rows in the fact-table shape, stamped with the batch."""
    return stg.select(
        "trade_id", "src_sys", "acct_num", "trx_cd", "amount",
        F.col("sc_trx_actn_cd").alias("actn_cd"),
        F.lit(None).cast("bigint").alias("reversed_trade_id"),
        ctx.batch_id_col().alias("btch_id"),
    )


def reversal_load(facts: DataFrame, stg: DataFrame, ctx: RunContext) -> DataFrame:
    """Second pass: the reversing rows for keys cancelled or updated by the
    batch, read against the fact table after the first pass."""
    after_first = facts.unionByName(trade_fact_rows(stg, ctx))
    batch = stg.select(*FACT_KEY, F.col("sc_trx_actn_cd").alias("actn_cd"))
    return reversal_rows(after_first, batch, list(FACT_KEY), ctx, code="actn_cd", amount="amount",
                         id_col="trade_id", link_col="reversed_trade_id", batch_col="btch_id",
                         small=staged_is_small(stg))


# -------------------------------------------------------------- positions

POSITION_KEY = ("acct_num", "trx_cd")


def position_rows(stg: DataFrame, ctx: RunContext) -> DataFrame:
    """Latest batch row per position key, in the position-table shape."""
    latest = latest_per_key(stg, list(POSITION_KEY), [F.col("trade_id").desc()])
    return latest.select(
        F.col("trade_id").alias("position_id"), "src_sys", "acct_num", "trx_cd", "amount",
        F.col("sc_trx_actn_cd").alias("actn_cd"), ctx.batch_id_col().alias("btch_id"),
        F.lit(None).cast("string").alias("mdfd_by"),
    )


def held_update_load(positions: DataFrame, stg: DataFrame, ctx: RunContext):
    """Both passes of a position file.

    Pass 1 inserts the positions of rows that are not updates ('U' held back,
    NULL codes kept).  Pass 2 runs over the held rows against the table after
    pass 1: matched keys get the new amount in place, unmatched ones are
    inserted as 'O'.  Returns (pass-1 inserts, updated rows, 'O' inserts,
    next state).
    """
    small = staged_is_small(stg)
    # batch-sized and read by both passes and every join below: computed once
    rows = reliable_checkpoint(position_rows(stg, ctx))
    first, held = hold_updates(rows, "actn_cd")
    first_new = reliable_checkpoint(insert_only(first, positions, list(POSITION_KEY), small=small))
    after_first = positions.unionByName(first_new)
    updated, lone = held_update_split(held, after_first, list(POSITION_KEY), ["amount", "btch_id"], ctx,
                                      f"{ctx.job}-asset", code="actn_cd", small=small)
    next_state = apply_updates(after_first, updated, list(POSITION_KEY), small=small).unionByName(lone)
    return first_new, updated, lone, next_state


# ------------------------------------------------------------ code checks


def missing_trx_codes(stg: DataFrame, trx_master: DataFrame) -> DataFrame:
    return quality.missing_codes(stg, "trx_cd", trx_master, "trx_cd")


def rows_with_known_codes(stg: DataFrame, trx_master: DataFrame) -> DataFrame:
    """Policy ``exclude``: rows whose code is missing from the master are not loaded.
    A NULL code is not a missing one: its row stays, as in the spec runner."""
    codes, _ = broadcast_if_small(trx_master.select("trx_cd").distinct().withColumn("_known", F.lit(True)))
    marked = stg.join(codes, "trx_cd", "left")
    return marked.where(F.col("_known") | F.col("trx_cd").isNull()).drop("_known")


def fact_with_batch(facts: DataFrame, stg: DataFrame, ctx: RunContext) -> DataFrame:
    return facts.unionByName(trade_fact_rows(stg, ctx))



def summary_load(facts: DataFrame, ctx: RunContext) -> DataFrame:
    """Per-account transaction summary of one batch, read from the fact table
    (a target-side table: the source is the load's own output, selected by
    batch id).  One hash aggregate, partial per task, so a hot account costs
    one row per task in the shuffle."""
    rows = facts.where(F.col("btch_id") == ctx.batch_id_col())
    return rows.groupBy("src_sys", "acct_num").agg(
        F.count(F.lit(1)).alias("trx_cnt"),
        F.count_if(F.col("actn_cd") == "R").alias("reversal_cnt"),
        F.sum("amount").cast("decimal(28,2)").alias("net_amount"),
        F.max("trade_id").alias("last_trade_id"),
    ).withColumn("btch_id", ctx.batch_id_col())
