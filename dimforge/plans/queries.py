"""Registered queries: one per operator family, each ``(spark, sf_dir) -> DataFrame``.

Each builds its fixtures from the test tables (``fixtures.py``), runs the
library operators over the whole tables and returns the result frame.  The
DuckDB form of each lives in ``oracle.py`` under the same key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.context import DEFAULT_CONTEXT as CTX
from dimforge.operators.scd import classify, current_rows, scd2_join
from dimforge.plans import account, fixtures as fx
from dimforge.session import reliable_checkpoint

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- account SCD2


def _account(spark, sf_dir):
    staged = fx.stg_account(spark, sf_dir)
    target = fx.ods_account(spark, sf_dir)
    return staged, target


@query("column_mapping")
def q_column_mapping(spark, sf_dir):
    staged, _ = _account(spark, sf_dir)
    return account.prepare_batch(staged).incoming


@query("current_rows")
def q_current_rows(spark, sf_dir):
    return current_rows(fx.ods_account(spark, sf_dir), account.ACCOUNT_SPEC)


@query("scd2_classify")
def q_scd2_classify(spark, sf_dir):
    staged, target = _account(spark, sf_dir)
    batch = account.prepare_batch(staged)
    return classify(batch.incoming, current_rows(target, account.ACCOUNT_SPEC), account.ACCOUNT_SPEC)


@query("scd2_inserts")
def q_scd2_inserts(spark, sf_dir):
    staged, target = _account(spark, sf_dir)
    _, result = account.load_account(target, staged, CTX)
    return result.inserts


@query("scd2_expire")
def q_scd2_expire(spark, sf_dir):
    staged, target = _account(spark, sf_dir)
    _, result = account.load_account(target, staged, CTX)
    return result.expired


@query("scd2_next_state")
def q_scd2_next_state(spark, sf_dir):
    staged, target = _account(spark, sf_dir)
    _, result = account.load_account(target, staged, CTX)
    return result.next_state()


@query("empty_target_load")
def q_empty_target_load(spark, sf_dir):
    staged = fx.stg_account(spark, sf_dir)
    _, result = account.load_account(account.empty_target(spark), staged, CTX)
    return result.next_state()


@query("surrogate_keys")
def q_surrogate_keys(spark, sf_dir):
    """NEW and CHANGED accounts numbered above the target's high-water mark."""
    from dimforge.operators.keys import high_water_mark, surrogate_keys

    staged, target = _account(spark, sf_dir)
    batch = account.prepare_batch(staged)
    joined = scd2_join(batch.incoming, current_rows(target, account.ACCOUNT_SPEC), account.ACCOUNT_SPEC)
    cands = joined.where(F.col("row_type").isin("NEW", "CHANGED")).select("customer_id")
    return surrogate_keys(cands, "customer_id", "customer_account_sk",
                          start=high_water_mark(target, "customer_account_sk"))


@query("surrogate_keys_orders")
def q_surrogate_keys_orders(spark, sf_dir):
    """Bench-scale numbering: every order by a text key."""
    from dimforge.operators.keys import surrogate_keys

    o = fx.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("O"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("order_nk"))
    return surrogate_keys(o, "order_nk", "order_sk", start=0)


@query("reject_rows")
def q_reject_rows(spark, sf_dir):
    staged, _ = _account(spark, sf_dir)
    return account.prepare_batch(staged).rejections(CTX)


@query("single_active_violations")
def q_single_active_violations(spark, sf_dir):
    """Next state with planted second open versions for every 50th customer."""
    from dimforge.operators.scd import single_active_violations

    staged, target = _account(spark, sf_dir)
    _, result = account.load_account(target, staged, CTX)
    state = result.next_state()
    planted = state.where(F.col("is_current") & (F.substring("customer_id", 2, 12).cast("bigint") % 50 == 0))
    return single_active_violations(state.unionByName(planted), "customer_id", F.col("is_current"))


@query("rerun_is_noop")
def q_rerun_is_noop(spark, sf_dir):
    """The same batch applied to the state it produced leaves it unchanged."""
    from dimforge.operators.scd import already_loaded

    staged, target = _account(spark, sf_dir)
    _, first = account.load_account(target, staged, CTX)
    state = reliable_checkpoint(first.next_state())
    if already_loaded(state, account.ACCOUNT_SPEC, CTX):
        return state
    _, second = account.load_account(state, staged, CTX)
    return second.next_state()


@query("audit_summary")
def q_audit_summary(spark, sf_dir):
    from dimforge.operators.audit import audit_row, outcome_counts, tagged

    staged, target = _account(spark, sf_dir)
    batch, result = account.load_account(target, staged, CTX)
    rows = (tagged(staged, "SOURCE")
            .unionByName(tagged(batch.null_key, "REJECT_NULL_KEY"))
            .unionByName(tagged(batch.bad_revenue, "REJECT_CAST"))
            .unionByName(tagged(result.joined.where(F.col("row_type") != "ABSENT"), F.col("row_type"))))
    counts = outcome_counts(rows, ["SOURCE", "REJECT_NULL_KEY", "REJECT_CAST", "NEW", "CHANGED", "UNCHANGED"])
    return audit_row(counts, CTX, "customer_account", account.SOURCE_TABLE, "n_source",
                     loaded=["n_new", "n_changed"], filtered=["n_unchanged"],
                     rejected=["n_reject_null_key", "n_reject_cast"])


@query("scd2_rollback_columns")
def q_scd2_rollback_columns(spark, sf_dir):
    """Roll the account batch back: the former state minus update stamps."""
    from dimforge.operators.scd import rollback_columns_version

    staged, target = _account(spark, sf_dir)
    _, result = account.load_account(target, staged, CTX)
    return rollback_columns_version(result.next_state(), account.ACCOUNT_SPEC, CTX).drop("dw_update_timestamp")


# ---------------------------------------------------------------- published table


def _published(spark, sf_dir, buckets: int = 16):
    """The account target as a bucketed table in the shared scratch folder, its first batch before CTX's."""
    from dimforge.session import scratch_path

    staged, target = _account(spark, sf_dir)
    table = account.versioned_table(spark, scratch_path(spark, "published"), buckets)
    table.create(CTX.batch_id - 10, target)
    return table, account.prepare_batch(staged).incoming


@query("bucketed_load")
def q_bucketed_load(spark, sf_dir):
    """One batch merged into a published table: only the buckets of its keys are rewritten."""
    from dimforge.operators.scd import load_into

    table, incoming = _published(spark, sf_dir)
    return table.read(load_into(table, incoming, account.ACCOUNT_SPEC, CTX))


@query("rerun_published")
def q_rerun_published(spark, sf_dir):
    """The same batch twice: the second run adds no commit."""
    from dimforge.operators.scd import load_into

    table, incoming = _published(spark, sf_dir)
    first = load_into(table, incoming, account.ACCOUNT_SPEC, CTX)
    again = load_into(table, incoming, account.ACCOUNT_SPEC, CTX)
    return table.read(again).withColumn("n_commits", F.lit(again.number - first.number + 1))


@query("publish_interrupted")
def q_publish_interrupted(spark, sf_dir):
    """A batch dies after its data is written and before its commit; the next batch does not see it."""
    from dataclasses import replace

    from dimforge.operators.scd import load_into, scd2_apply

    table, incoming = _published(spark, sf_dir)
    dead = replace(CTX, batch_id=CTX.batch_id - 5, batch_ts="2024-12-27 06:00:00", batch_date="2024-12-27")
    lost = incoming.withColumn("customer_name", F.concat("customer_name", F.lit(" (lost)")))
    head = table.head()
    touched = table.touched_buckets(lost)
    result = scd2_apply(table.read_open(head, touched), lost, account.ACCOUNT_SPEC, dead, high_water=head.high_water)
    table.stage(dead.batch_id, touched, result.prior_current.unionByName(result.inserts), head.high_water,
                table.read_open(head, touched))  # and no commit
    return table.read(load_into(table, incoming, account.ACCOUNT_SPEC, CTX))


@query("late_batch")
def q_late_batch(spark, sf_dir):
    """A batch older than the newest one is refused and changes nothing."""
    from dataclasses import replace

    from dimforge.operators.scd import load_into
    from dimforge.sources.versioned import LateBatchError

    table, incoming = _published(spark, sf_dir)
    load_into(table, incoming, account.ACCOUNT_SPEC, CTX)
    late = replace(CTX, batch_id=CTX.batch_id - 3, batch_ts="2024-12-29 06:00:00", batch_date="2024-12-29")
    refused = False
    try:
        load_into(table, incoming.withColumn("industry", F.lit("LATE")), account.ACCOUNT_SPEC, late)
    except LateBatchError:
        refused = True
    return table.read().withColumn("refused", F.lit(refused))


@query("rollback_published")
def q_rollback_published(spark, sf_dir):
    """Load a batch, take it back: the former state bit for bit, update times included."""
    from dimforge.operators.scd import load_into

    table, incoming = _published(spark, sf_dir)
    load_into(table, incoming, account.ACCOUNT_SPEC, CTX)
    return table.read(table.rollback(CTX.batch_id))


@query("scd2_rollback_images")
def q_scd2_rollback_images(spark, sf_dir):
    """A load by hash over a target with inactivated keys, undone by before-images: every flag and stamp comes back."""
    from dimforge.operators.scd import rollback_by_images
    from dimforge.operators.scd_hash import superseded
    from dimforge.plans import policy
    from dimforge.plans.trade import staged_is_small

    # every sixth key was inactivated and stamped by an earlier batch
    gone = F.col("plcy_mastr_id") % 6 == 0
    target = fx.ods_plcy_detl(spark, sf_dir)
    target = target.withColumns({
        "actv_indctr": F.when(gone, F.lit("D")).otherwise(F.col("actv_indctr")),
        "mdfd_by": F.when(gone, F.lit("close")).otherwise(F.col("mdfd_by")),
        "mdfd_dt": F.when(gone, F.col("crtd_dt")).otherwise(F.col("mdfd_dt"))}).select(*policy.TARGET_COLUMNS)
    ident = policy.identified(_policy_lkp(spark, sf_dir), target, small=staged_is_small(fx.stg_trade(spark, sf_dir)))
    versions, n = policy.new_versions_counted(ident, target, CTX)
    state = reliable_checkpoint(policy.next_state(target, versions, CTX, n))
    closed = superseded(target.unionByName(versions), policy.SPEC, CTX,
                        f"{CTX.job}-{policy.ENTITY}", touched=versions, touched_rows=n)
    before = reliable_checkpoint(target.join(closed.select(policy.SPEC.sk), policy.SPEC.sk, "left_semi"))
    return rollback_by_images(state, versions, before, policy.SPEC.sk)


# ------------------------------------------------------------ type 1


def _type1(spark, sf_dir):
    from dimforge.operators.upsert import type1_join

    staged, target = _account(spark, sf_dir)
    batch = account.prepare_batch(staged).incoming.select("customer_id", "customer_name", "industry", "revenue_usd")
    tgt = current_rows(target, account.ACCOUNT_SPEC).select(
        "customer_id", "customer_name", "industry", "revenue_usd",
        F.lit(None).cast("string").alias("mdfd_by"), F.lit(None).cast("timestamp_ntz").alias("mdfd_dt"))
    return batch, tgt, type1_join(batch, tgt, "customer_id", ["customer_name", "industry", "revenue_usd"])


@query("type1_route")
def q_type1_route(spark, sf_dir):
    from dimforge.operators.upsert import type1_route

    batch, _, joined = _type1(spark, sf_dir)
    return type1_route(joined, batch.columns)


@query("type1_upsert")
def q_type1_upsert(spark, sf_dir):
    from dimforge.operators.upsert import type1_next_state

    _, tgt, joined = _type1(spark, sf_dir)
    return type1_next_state(joined, tgt.columns, "customer_id", ["customer_name", "industry", "revenue_usd"],
                            CTX, f"{CTX.job}-account")


# ------------------------------------------------------------ trades


@query("default_columns")
def q_default_columns(spark, sf_dir):
    from dimforge.plans import trade

    return trade.master_rows(fx.stg_trade(spark, sf_dir))


@query("audit_columns")
def q_audit_columns(spark, sf_dir):
    from dimforge.operators.keys import dedup_natural_key
    from dimforge.operators.schema import audit_insert_columns
    from dimforge.plans import trade

    rows = dedup_natural_key(trade.master_rows(fx.stg_trade(spark, sf_dir)), list(trade.MASTER_KEY))
    return audit_insert_columns(rows, CTX, f"{CTX.job}-trade")


@query("insert_only_load")
def q_insert_only_load(spark, sf_dir):
    from dimforge.plans import trade

    return trade.insert_only_master(fx.stg_trade(spark, sf_dir), fx.ods_plcy_mastr(spark, sf_dir), CTX)


@query("dedup_natural_key")
def q_dedup_natural_key(spark, sf_dir):
    """One event per (user, event type): the earliest one."""
    from dimforge.operators.keys import dedup_natural_key

    e = fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dedup_natural_key(e, ["user_id", "event_type"], [F.col("ts").asc(), F.col("event_id").asc()])


@query("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    from dimforge.operators.quality import duplicate_keys

    return duplicate_keys(fx.table(spark, sf_dir, "events"), "user_id")


@query("duplicate_keys_sample")
def q_duplicate_keys_sample(spark, sf_dir):
    """The halt message's key sample: the first 20 duplicated keys in order."""
    from dimforge.operators.quality import duplicate_keys

    return duplicate_keys(fx.table(spark, sf_dir, "events"), "user_id").orderBy("user_id").limit(20)


@query("latest_per_key")
def q_latest_per_key(spark, sf_dir):
    from dimforge.plans import policy

    return policy.latest_trade_per_account(fx.stg_trade(spark, sf_dir))


@query("first_trade_lookup")
def q_first_trade_lookup(spark, sf_dir):
    from dimforge.plans import policy

    return policy.first_trade_lookup(fx.stg_trade(spark, sf_dir))


@query("missing_codes")
def q_missing_codes(spark, sf_dir):
    from dimforge.plans import trade

    return trade.missing_trx_codes(fx.stg_trade(spark, sf_dir), fx.trx_mastr(spark))


@query("missing_code_alert")
def q_missing_code_alert(spark, sf_dir):
    from dimforge.operators.quality import missing_code_alert
    from dimforge.plans import trade

    return missing_code_alert(trade.missing_trx_codes(fx.stg_trade(spark, sf_dir), fx.trx_mastr(spark)), "trx_cd")


@query("missing_codes_excluded")
def q_missing_codes_excluded(spark, sf_dir):
    from dimforge.plans import trade

    return trade.rows_with_known_codes(fx.stg_trade(spark, sf_dir), fx.trx_mastr(spark))


@query("reversal_load")
def q_reversal_load(spark, sf_dir):
    from dimforge.plans import trade

    return trade.reversal_load(fx.ods_trx(spark, sf_dir), fx.stg_trade(spark, sf_dir), CTX)


@query("batch_delete")
def q_batch_delete(spark, sf_dir):
    """Facts after this batch's rows were appended, then deleted for a rerun."""
    from dimforge.operators.scd_hash import delete_batch
    from dimforge.plans import trade

    state = trade.fact_with_batch(fx.ods_trx(spark, sf_dir), fx.stg_trade(spark, sf_dir), CTX)
    return delete_batch(state, "btch_id", CTX)


def _held(spark, sf_dir):
    from dimforge.plans import trade

    return trade.held_update_load(fx.ods_position(spark, sf_dir), fx.stg_trade(spark, sf_dir), CTX)


@query("held_updates")
def q_held_updates(spark, sf_dir):
    return _held(spark, sf_dir)[0]


@query("held_update_match")
def q_held_update_match(spark, sf_dir):
    return _held(spark, sf_dir)[1]


@query("held_update_nomatch")
def q_held_update_nomatch(spark, sf_dir):
    return _held(spark, sf_dir)[2]


@query("held_update_next_state")
def q_held_update_next_state(spark, sf_dir):
    return _held(spark, sf_dir)[3]


# ------------------------------------------------------------ policy detail


def _policy_lkp(spark, sf_dir):
    from dimforge.plans import policy

    return policy.enriched(fx.stg_trade(spark, sf_dir), fx.stg_cstmr(spark, sf_dir),
                           fx.ods_plcy_mastr(spark, sf_dir), fx.src_prod_mastr(spark),
                           fx.ref_status(spark), CTX)


@query("blank_to_null")
def q_blank_to_null(spark, sf_dir):
    from dimforge.operators.schema import blank_to_null

    return blank_to_null(fx.stg_cstmr(spark, sf_dir), ["acct_closg_dt", "custdn_firm_mnm"])


@query("derived_status")
def q_derived_status(spark, sf_dir):
    from dimforge.plans import policy

    return policy.customer_lookup(fx.stg_cstmr(spark, sf_dir), CTX).select("acct_num", "plcy_status")


@query("nullsafe_lookup")
def q_nullsafe_lookup(spark, sf_dir):
    from dimforge.operators.lookup import Lookup, enrich
    from dimforge.plans import policy

    cust = policy.customer_lookup(fx.stg_cstmr(spark, sf_dir), CTX).select("acct_num", "plcy_status")
    return enrich(cust, [Lookup(fx.ref_status(spark), on=[("plcy_status", "src_sys_ref_cd")],
                                columns={"ref_id": "plcy_status_id"}, defaults={"plcy_status_id": -99},
                                null_equals="-")])


@query("lookup_enrich")
def q_lookup_enrich(spark, sf_dir):
    return _policy_lkp(spark, sf_dir)


@query("lookup_enrich_lineitem")
def q_lookup_enrich_lineitem(spark, sf_dir):
    """Bench-scale enrichment: every line item with part, supplier and nation
    attributes (-99 / 'N/A' when a reference row is missing)."""
    from dimforge.operators.lookup import Lookup, enrich

    li = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                     "l_extendedprice")
    part = fx.table(spark, sf_dir, "part").where(F.col("p_size") > 5)
    supp = fx.table(spark, sf_dir, "supplier")
    nation = fx.table(spark, sf_dir, "nation")
    return enrich(li, [
        Lookup(part, on=[("l_partkey", "p_partkey")], columns={"p_brand": "p_brand", "p_type": "p_type"},
               defaults={"p_brand": "N/A", "p_type": "N/A"}),
        Lookup(supp, on=[("l_suppkey", "s_suppkey")], columns={"s_name": "s_name", "s_nationkey": "s_nationkey"},
               defaults={"s_nationkey": -99}),
        Lookup(nation, on=[("s_nationkey", "n_nationkey")], columns={"n_name": "supp_nation"},
               defaults={"supp_nation": "N/A"}),
    ])


@query("policy_not_found")
def q_policy_not_found(spark, sf_dir):
    """Accounts whose policy master row is missing (routed to the error log)."""
    from dimforge.plans import policy

    _, unmatched = policy.split_unmatched(_policy_lkp(spark, sf_dir))
    return unmatched.select("src_sys", "acct_num")


def _policy_ident(spark, sf_dir):
    from dimforge.plans import policy

    from dimforge.plans.trade import staged_is_small

    return policy.identified(_policy_lkp(spark, sf_dir), fx.ods_plcy_detl(spark, sf_dir),
                             small=staged_is_small(fx.stg_trade(spark, sf_dir)))


@query("carry_forward")
def q_carry_forward(spark, sf_dir):
    return _policy_ident(spark, sf_dir).select(
        "src_sys", "plcy_mastr_id", "tgt_plcy_detl_id", "plcy_iss_dt", "custdn_firm_nm", "plcy_status_id",
        "first_depst_dt")


@query("row_hash")
def q_row_hash(spark, sf_dir):
    return _policy_ident(spark, sf_dir).select("src_sys", "plcy_mastr_id", "hash_key", "tgt_hash_key")


@query("hash_change_filter")
def q_hash_change_filter(spark, sf_dir):
    from dimforge.operators.scd_hash import changed_or_new
    from dimforge.plans import policy

    return changed_or_new(_policy_ident(spark, sf_dir), policy.SPEC).select(
        "src_sys", "plcy_mastr_id", "tgt_plcy_detl_id", "hash_key")


def _policy_versions(spark, sf_dir):
    from dimforge.plans import policy

    target = fx.ods_plcy_detl(spark, sf_dir)
    versions, n = policy.new_versions_counted(_policy_ident(spark, sf_dir), target, CTX)
    return target, versions, n


@query("scd2_hash_next_state")
def q_scd2_hash_next_state(spark, sf_dir):
    from dimforge.plans import policy

    target, versions, n = _policy_versions(spark, sf_dir)
    return policy.next_state(target, versions, CTX, n)


@query("supersede_expire")
def q_supersede_expire(spark, sf_dir):
    from dimforge.operators.scd_hash import superseded
    from dimforge.plans import policy

    target, versions, n = _policy_versions(spark, sf_dir)
    state = target.select(*policy.TARGET_COLUMNS).unionByName(versions)
    return superseded(state, policy.SPEC, CTX, f"{CTX.job}-{policy.ENTITY}", touched=versions, touched_rows=n)


@query("scd2_rollback")
def q_scd2_rollback(spark, sf_dir):
    """Load then roll back: equals the former state."""
    from dimforge.operators.scd_hash import rollback
    from dimforge.plans import policy

    target, versions, n = _policy_versions(spark, sf_dir)
    return rollback(policy.next_state(target, versions, CTX, n), policy.SPEC, CTX)


@query("full_file_inactivate")
def q_full_file_inactivate(spark, sf_dir):
    from dimforge.plans import policy

    target = fx.ods_plcy_detl(spark, sf_dir)
    ident = _policy_ident(spark, sf_dir)
    matched, _ = policy.split_unmatched(_policy_lkp(spark, sf_dir))
    changes, n = policy.full_file_changes(target, ident, matched.select(*policy.SPEC.keys), CTX)
    return policy.next_state(target, changes, CTX, n)


@query("error_log")
def q_error_log(spark, sf_dir):
    """Error-log rows: accounts without a policy (EC_25) and trades whose
    transaction code is missing from the master (EC_26)."""
    from dimforge.operators.quality import EC_NEW_CODE, EC_NO_MASTER, error_log_rows
    from dimforge.plans import policy

    _, unmatched = policy.split_unmatched(_policy_lkp(spark, sf_dir))
    stg = fx.stg_trade(spark, sf_dir)
    missing = stg.join(fx.trx_mastr(spark).select("trx_cd"), "trx_cd", "left_anti")
    a = error_log_rows(unmatched, CTX, EC_NO_MASTER, "STG_TRADE", "plcy_detl", "acct_num", ["src_sys", "acct_num"])
    b = error_log_rows(missing, CTX, EC_NEW_CODE, "STG_TRADE", "invstmt_fund_trx", "trade_id",
                       ["acct_num", "trx_cd", "sc_trx_actn_cd"])
    return a.unionByName(b)


# ------------------------------------------------------------ rules


def _order_rules():
    from dimforge.operators.quality import Rule

    # Fixed rule codes of the order checks.
    return [
        Rule("PRICE_OUTLIER", F.col("o_totalprice") > 450000),
        Rule("PRIORITY_NOT_SPECIFIED", F.col("o_orderpriority") == "4-NOT SPECIFIED"),
        Rule("ORDER_AFTER_CUTOFF", F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")),
        Rule("OPEN_TOO_LONG", (F.col("o_orderstatus") == "O")
             & (F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))),
    ]


@query("dq_violations")
def q_dq_violations(spark, sf_dir):
    from dimforge.operators.quality import rule_violations

    return rule_violations(fx.table(spark, sf_dir, "orders"), "o_orderkey", _order_rules())


@query("dq_reason_summary")
def q_dq_reason_summary(spark, sf_dir):
    from dimforge.operators.quality import reason_summary, rule_violations

    return reason_summary(rule_violations(fx.table(spark, sf_dir, "orders"), "o_orderkey", _order_rules()))


@query("dq_exclude")
def q_dq_exclude(spark, sf_dir):
    from dimforge.operators.quality import exclude_keys, rule_violations

    o = fx.table(spark, sf_dir, "orders")
    return exclude_keys(o, rule_violations(o, "o_orderkey", _order_rules()), "o_orderkey")


# ------------------------------------------------------------ scans and schema


@query("typed_scan")
def q_typed_scan(spark, sf_dir):
    from dimforge.sources.scans import typed_parquet

    return typed_parquet(spark, f"{sf_dir}/orders.parquet", [
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
        ("o_totalprice", "decimal(18,2)"), ("o_orderdate", "date"), ("o_orderpriority", "string")])


@query("csv_scan")
def q_csv_scan(spark, sf_dir):
    """Customer written as delimited text (with quotes and delimiters inside
    fields) to the shared scratch folder, read back as all-text columns."""
    from dimforge.session import scratch_path
    from dimforge.sources.scans import read_delimited, write_delimited

    c = fx.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("c_acctbal"),
        F.when(F.col("c_custkey") % 11 == 0, F.lit(None)).otherwise(
            F.concat(F.col("c_mktsegment"), F.lit(', "'), F.col("c_name"), F.lit('"'))).alias("c_note"))
    path = scratch_path(spark, "csv_scan")
    write_delimited(c, path)
    return read_delimited(spark, path, ["c_custkey", "c_name", "c_acctbal", "c_note"])


def _supplier_target_schema():
    from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

    return StructType([
        StructField("S_SUPPKEY", LongType()), StructField("S_NAME", StringType()),
        StructField("S_NATIONKEY", IntegerType()), StructField("S_ACCTBAL", DecimalType(18, 2)),
        StructField("S_PHONE", StringType()),
    ])


def _supplier_feed(spark, sf_dir):
    """Supplier rows as a feed would deliver them: shuffled, lower/mixed case,
    an extra column, one missing column, numbers as text."""
    s = fx.table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_acctbal").cast("decimal(18,2)").cast("string").alias("s_AcctBal"),
        F.lit("x").alias("feed_extra"),
        F.col("s_name").alias("S_Name"),
        F.col("s_suppkey").cast("string").alias("s_suppkey"),
        F.col("s_nationkey").alias("s_nationkey"),
    )


@query("schema_align")
def q_schema_align(spark, sf_dir):
    from dimforge.operators.schema import align_to_schema

    return align_to_schema(_supplier_feed(spark, sf_dir), _supplier_target_schema())


@query("append_aligned")
def q_append_aligned(spark, sf_dir):
    """Even suppliers form the table; the odd ones arrive as a feed and are
    appended after alignment; the table is read back."""
    from dimforge.operators.schema import align_to_schema
    from dimforge.session import scratch_path
    from dimforge.sources.sinks import append_aligned

    schema = _supplier_target_schema()
    feed = _supplier_feed(spark, sf_dir)
    path = scratch_path(spark, "append_aligned")
    align_to_schema(feed.where(F.col("s_suppkey").cast("bigint") % 2 == 0), schema).write.parquet(path)
    append_aligned(feed.where(F.col("s_suppkey").cast("bigint") % 2 == 1), path, schema)
    return spark.read.parquet(path)


@query("utc_normalise")
def q_utc_normalise(spark, sf_dir):
    from dimforge.operators.schema import utc_normalise

    e = fx.table(spark, sf_dir, "events").select("event_id", "ts")
    return utc_normalise(e, ["ts"], "Asia/Kolkata")


# ------------------------------------------------------------ dataset specs


@query("job_insert_only")
def q_job_insert_only(spark, sf_dir):
    """The policy-master insert-only load run from its declarative spec."""
    from dimforge.plans import datasets, job

    target = fx.ods_plcy_mastr(spark, sf_dir).where(F.col("src_sys") == CTX.source_system)
    return job.run(spark, datasets.trade_policy_master(sf_dir), CTX, target).rows


@query("job_audit")
def q_job_audit(spark, sf_dir):
    """Audit row of the spec-driven insert-only load."""
    from dimforge.plans import datasets, job

    target = fx.ods_plcy_mastr(spark, sf_dir).where(F.col("src_sys") == CTX.source_system)
    return job.run(spark, datasets.trade_policy_master(sf_dir), CTX, target).audit


@query("job_type1")
def q_job_type1(spark, sf_dir):
    from dimforge.plans import datasets, job

    return job.run(spark, datasets.account_upsert(sf_dir), CTX, datasets.account_upsert_target(spark, sf_dir)).rows


@query("job_versioned_hash")
def q_job_versioned_hash(spark, sf_dir):
    from dimforge.plans import datasets, job, policy

    target = fx.ods_plcy_detl(spark, sf_dir).select(*policy.TARGET_COLUMNS)
    return job.run(spark, datasets.policy_detail(sf_dir), CTX, target).frames["next_state"]


@query("summary_load")
def q_summary_load(spark, sf_dir):
    """Summary of this batch's trades and reversals, from the fact table after both passes."""
    from dimforge.plans import trade

    stg = fx.stg_trade(spark, sf_dir)
    facts = trade.fact_with_batch(fx.ods_trx(spark, sf_dir), stg, CTX)
    facts = facts.unionByName(trade.reversal_load(fx.ods_trx(spark, sf_dir), stg, CTX))
    return trade.summary_load(facts, CTX)


@query("job_versioned_columns")
def q_job_versioned_columns(spark, sf_dir):
    """The account dimension load run from its spec (type 2 by columns)."""
    from dimforge.plans import datasets, job

    return job.run(spark, datasets.account_versioned(sf_dir), CTX, fx.ods_account(spark, sf_dir)).frames["next_state"]


@query("job_versioned_columns_audit")
def q_job_versioned_columns_audit(spark, sf_dir):
    from dimforge.plans import datasets, job

    return job.run(spark, datasets.account_versioned(sf_dir), CTX, fx.ods_account(spark, sf_dir)).audit


@query("job_full_file")
def q_job_full_file(spark, sf_dir):
    """The policy-detail spec run on a full file: keys absent from it are inactivated."""
    from dimforge.plans import datasets, job, policy

    target = fx.ods_plcy_detl(spark, sf_dir).select(*policy.TARGET_COLUMNS)
    return job.run(spark, datasets.policy_detail(sf_dir), CTX, target, file_type="full").frames["next_state"]


@query("job_insert_only_text")
def q_job_insert_only_text(spark, sf_dir):
    """The trade file written as delimited text to the shared scratch folder,
    then loaded insert-only from the text through the spec runner."""
    from dimforge.plans import datasets, job
    from dimforge.session import scratch_path
    from dimforge.sources.scans import write_delimited

    path = scratch_path(spark, "stg_trade_text")
    write_delimited(fx.stg_trade(spark, sf_dir).select(*datasets.TRADE_FILE_COLUMNS), path, delimiter="|")
    spec = datasets.trade_policy_master_from_text(path, sf_dir, delimiter="|")
    target = fx.ods_plcy_mastr(spark, sf_dir).where(F.col("src_sys") == CTX.source_system)
    return job.run(spark, spec, CTX, target).rows


@query("target_batch_count")
def q_target_batch_count(spark, sf_dir):
    """Policy-detail rows this batch wrote, counted on the next state."""
    from dimforge.operators.audit import target_batch_count
    from dimforge.plans import policy

    state = q_scd2_hash_next_state(spark, sf_dir)
    return target_batch_count(state, CTX, f"{CTX.job}-{policy.ENTITY}")


def _codes_excluded_spec(sf_dir):
    from dimforge.plans import datasets, job

    spec = datasets.trade_policy_master(sf_dir)
    spec.code_checks = [job.CodeCheck("trx_cd", fx.trx_mastr, "trx_cd", policy="exclude")]
    return spec


@query("job_codes_excluded")
def q_job_codes_excluded(spark, sf_dir):
    """Policy-master load where trades with a transaction code missing from its
    master are not loaded (``exclude`` policy)."""
    from dimforge.plans import job

    target = fx.ods_plcy_mastr(spark, sf_dir).where(F.col("src_sys") == CTX.source_system)
    return job.run(spark, _codes_excluded_spec(sf_dir), CTX, target).rows


@query("job_codes_excluded_audit")
def q_job_codes_excluded_audit(spark, sf_dir):
    from dimforge.plans import job

    target = fx.ods_plcy_mastr(spark, sf_dir).where(F.col("src_sys") == CTX.source_system)
    return job.run(spark, _codes_excluded_spec(sf_dir), CTX, target).audit


@query("job_error_log")
def q_job_error_log(spark, sf_dir):
    """Error-log rows the spec runner writes for trades whose transaction code
    is missing from its master (the rows still load: ``default_id``)."""
    from dimforge.plans import datasets, job

    spec = datasets.trade_policy_master(sf_dir)
    spec.code_checks = [job.CodeCheck("trx_cd", fx.trx_mastr, "trx_cd", policy="default_id")]
    spec.error_key = "trade_id"
    target = fx.ods_plcy_mastr(spark, sf_dir).where(F.col("src_sys") == CTX.source_system)
    return job.run(spark, spec, CTX, target).errors


@query("job_error_log_unmatched")
def q_job_error_log_unmatched(spark, sf_dir):
    """Error-log rows (EC_25) the spec runner writes for accounts without a policy."""
    from dimforge.plans import datasets, job, policy

    spec = datasets.policy_detail(sf_dir)
    spec.error_key = "acct_num"
    return job.run(spark, spec, CTX, fx.ods_plcy_detl(spark, sf_dir).select(*policy.TARGET_COLUMNS)).errors


@query("job_audit_loss")
def q_job_audit_loss(spark, sf_dir):
    """Audit row of a load whose lookup step loses every seventh policy number: it does not balance."""
    from dimforge.plans import datasets, job

    spec = datasets.trade_policy_master(sf_dir)
    spec.lookup = job.Step("lkp", sql="select src_sys, acct_num as plcy_num from {src} where cast(acct_num as bigint) % 7 <> 0")
    target = fx.ods_plcy_mastr(spark, sf_dir).where(F.col("src_sys") == CTX.source_system)
    return job.run(spark, spec, CTX, target).audit


@query("job_full_file_stopped")
def q_job_full_file_stopped(spark, sf_dir):
    """A full file of which the filter leaves nothing: the load stops and the target stays as it was."""
    from dimforge.plans import datasets, job, policy

    spec = datasets.policy_detail(sf_dir)
    spec.source_filter = job.Step("src", sql="select * from {src_file} where trx_cd = 'no such code'")
    target = fx.ods_plcy_detl(spark, sf_dir).select(*policy.TARGET_COLUMNS)
    res = job.run(spark, spec, CTX, target, file_type="full")
    return res.frames["next_state"].withColumn("stopped", F.lit(res.stopped))
