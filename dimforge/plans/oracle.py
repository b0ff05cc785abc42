"""Oracle SQL (DuckDB dialect) for every registered query.

The fixtures are written once here as CTEs mirroring ``fixtures.py``;
``sql(body, *ctes)`` prepends the CTEs a query needs (dependencies first).
Run date: batch 20250101, batch time 2025-01-01 06:00:00.
"""

from __future__ import annotations

BATCH_TS = "TIMESTAMP '2025-01-01 06:00:00'"
BATCH_TS_MINUS_MS = "(TIMESTAMP '2025-01-01 06:00:00' - INTERVAL 1 MILLISECOND)"
BATCH_DATE = "DATE '2025-01-01'"

CTES: dict[str, str] = {}
DEPS: dict[str, tuple[str, ...]] = {}


def cte(name: str, body: str, deps: tuple[str, ...] = ()) -> None:
    CTES[name] = body
    DEPS[name] = deps


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def sql(body: str, *ctes: str) -> str:
    names = _order(ctes)
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


def _ts(year: int, hour: str = "c_custkey % 24") -> str:
    return f"make_timestamp({year}, c_custkey % 12 + 1, c_custkey % 28 + 1, {hour}, 0, 0)"


cte("stg_account", f"""
select case when c_custkey % 97 = 0 then null else concat('A', cast(c_custkey as varchar)) end as account_id,
       c_name as account_name,
       case when c_custkey % 10 = 3 then null else c_mktsegment end as industry,
       case when c_custkey % 53 = 0 then 'n/a' when c_custkey % 59 = 0 then null
            else cast(cast(c_acctbal as decimal(18,2)) as varchar) end as annual_revenue,
       {_ts(2020)} as created_date,
       {_ts(2024, '0')} as last_modified_date
from customer where c_custkey % 13 <> 5""")

cte("ods_account", f"""
select cast(c_custkey + 1000 as bigint) as customer_account_sk, concat('A', cast(c_custkey as varchar)) as customer_id,
       case when c_custkey % 7 = 0 then concat(c_name, '*') else c_name end as customer_name,
       case when c_custkey % 10 = 4 then null else c_mktsegment end as industry,
       cast(c_acctbal as decimal(18,2)) as revenue_usd,
       {_ts(2020)} as source_created_date, {_ts(2023, '0')} as source_last_modified_date,
       TIMESTAMP '2024-01-01 00:00:00' as effective_start_date, cast(null as timestamp) as effective_end_date,
       true as is_current, TIMESTAMP '2024-01-01 00:00:00' as dw_insert_timestamp,
       TIMESTAMP '2024-01-01 00:00:00' as dw_update_timestamp
from customer where c_custkey % 5 <> 1
union all
select cast(c_custkey + 1000000 as bigint), concat('A', cast(c_custkey as varchar)), concat(c_name, ' (old)'),
       c_mktsegment, cast(null as decimal(18,2)), {_ts(2020)}, {_ts(2020)},
       TIMESTAMP '2023-01-01 00:00:00', TIMESTAMP '2023-12-31 23:59:59.999', false,
       TIMESTAMP '2023-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:00'
from customer where c_custkey % 5 <> 1 and c_custkey % 3 = 0""")

cte("acct_valid", """
select * from stg_account
where account_id is not null and not (annual_revenue is not null and try_cast(annual_revenue as decimal(18,2)) is null)""",
    ("stg_account",))

cte("acct_incoming", """
select account_id as customer_id, account_name as customer_name, industry,
       try_cast(annual_revenue as decimal(18,2)) as revenue_usd,
       created_date as source_created_date, last_modified_date as source_last_modified_date
from acct_valid""", ("acct_valid",))

cte("acct_classified", """
select i.*, t.customer_account_sk as tgt_sk,
       case when t.customer_account_sk is null then 'NEW'
            when i.customer_name is distinct from t.customer_name or i.industry is distinct from t.industry
                 or i.revenue_usd is distinct from t.revenue_usd then 'CHANGED'
            else 'UNCHANGED' end as row_type
from acct_incoming i left join (select * from ods_account where is_current) t on i.customer_id = t.customer_id""",
    ("acct_incoming", "ods_account"))

cte("acct_inserts", f"""
select cast((select max(customer_account_sk) from ods_account) + row_number() over (order by customer_id) as bigint)
           as customer_account_sk,
       customer_id, customer_name, industry, revenue_usd, source_created_date, source_last_modified_date,
       {BATCH_TS} as effective_start_date, cast(null as timestamp) as effective_end_date, true as is_current,
       {BATCH_TS} as dw_insert_timestamp, {BATCH_TS} as dw_update_timestamp
from acct_classified where row_type in ('NEW', 'CHANGED')""", ("acct_classified",))

cte("acct_prior_current", f"""
select t.customer_account_sk, t.customer_id, t.customer_name, t.industry, t.revenue_usd, t.source_created_date,
       t.source_last_modified_date, t.effective_start_date,
       case when c.row_type = 'CHANGED' then {BATCH_TS_MINUS_MS} else t.effective_end_date end as effective_end_date,
       case when c.row_type = 'CHANGED' then false else t.is_current end as is_current,
       t.dw_insert_timestamp,
       case when c.row_type = 'CHANGED' then {BATCH_TS} else t.dw_update_timestamp end as dw_update_timestamp
from (select * from ods_account where is_current) t left join acct_classified c on t.customer_id = c.customer_id""",
    ("ods_account", "acct_classified"))

cte("acct_next_state", """
select * from ods_account where not is_current
union all select * from acct_prior_current
union all select * from acct_inserts""", ("ods_account", "acct_prior_current", "acct_inserts"))


ORACLE: dict[str, str] = {}

ORACLE["scd2_classify"] = sql("select * from acct_classified", "acct_classified")
ORACLE["scd2_inserts"] = sql("select * from acct_inserts", "acct_inserts")
ORACLE["scd2_expire"] = sql("select * from acct_prior_current where not is_current", "acct_prior_current")
ORACLE["scd2_next_state"] = sql("select * from acct_next_state", "acct_next_state")
ORACLE["column_mapping"] = sql("select * from acct_incoming", "acct_incoming")
ORACLE["current_rows"] = sql("select * from ods_account where is_current", "ods_account")
ORACLE["empty_target_load"] = sql(f"""
select cast(row_number() over (order by customer_id) as bigint) as customer_account_sk,
       customer_id, customer_name, industry, revenue_usd, source_created_date, source_last_modified_date,
       {BATCH_TS} as effective_start_date, cast(null as timestamp) as effective_end_date, true as is_current,
       {BATCH_TS} as dw_insert_timestamp, {BATCH_TS} as dw_update_timestamp
from acct_incoming""", "acct_incoming")


# ------------------------------------------------------------------ fixtures 2

BATCH_ID = "cast(20250101 as decimal(19,0))"
JOB = "'ods_load'"

cte("stg_trade", """
select event_id as trade_id, 'CORE' as src_sys, cast(user_id as varchar) as acct_num, event_type as trx_cd,
       case when event_type = 'error' then 'R' when event_id % 11 = 0 then 'C'
            when event_id % 3 = 0 then 'U' else 'O' end as sc_trx_actn_cd,
       cast(value as decimal(18,2)) as amount,
       replace(cast(cast(ts as date) as varchar), '-', '') as created_dt, '20250101' as btch_dt,
       case when event_id % 4 = 0 then 'Y' else 'N' end as frst_trd_acct_cd
from events""")

cte("ods_plcy_mastr", """
select cast(c_custkey + 5000 as bigint) as plcy_mastr_id, 'CORE' as src_sys, cast(c_custkey as varchar) as plcy_num
from customer where c_custkey % 4 <> 0""")

cte("stg_cstmr", """
select cast(c.c_custkey as varchar) as acct_num, n.n_name as state_nm,
       case when c.c_custkey % 9 = 0 then '20241231' when c.c_custkey % 9 = 1 then '20250630'
            when c.c_custkey % 9 = 2 then '' else null end as acct_closg_dt,
       case when c.c_custkey % 6 = 0 then null else '20200115' end as acct_open_dt,
       case when c.c_custkey % 8 = 0 then '' else c.c_mktsegment end as custdn_firm_mnm
from customer c join nation n on c.c_nationkey = n.n_nationkey""")

cte("ref_status", "select * from (values (11, 'A'), (12, 'T')) t(ref_id, src_sys_ref_cd)")
cte("trx_mastr", "select * from (values ('click', 1), ('view', 2), ('error', 3)) t(trx_cd, trx_mastr_id)")
cte("src_prod_mastr", "select * from (values ('INVESTMENTS', 7001), ('INSURANCE', 7002)) t(plan_cd, src_prod_mastr_id)")

cte("ods_plcy_detl", """
select *, md5(upper(concat_ws('', cast(plcy_iss_dt as varchar), '~', cast(plcy_status_id as varchar), '~',
                              custdn_firm_nm))) as hash_key
from (select cast(c_custkey + 9000 as bigint) as plcy_detl_id, cast(c_custkey + 5000 as bigint) as plcy_mastr_id,
             'CORE' as src_sys,
             case when c_custkey % 3 = 0 then DATE '1900-01-01' else DATE '2023-05-01' end as plcy_iss_dt,
             case when c_custkey % 7 = 0 then null else c_mktsegment end as custdn_firm_nm,
             case when c_custkey % 2 = 0 then 11 else 12 end as plcy_status_id,
             case when c_custkey % 5 = 0 then DATE '1900-01-01' when c_custkey % 5 = 1 then cast(null as date)
                  else DATE '2023-06-01' end as first_depst_dt,
             'Y' as actv_indctr, DATE '2024-01-01' as eff_from_dt, DATE '9999-12-31' as eff_to_dt,
             cast(20240101 as decimal(19,0)) as btch_id, 'seed-trade' as crtd_by,
             TIMESTAMP '2024-01-01 00:00:00' as crtd_dt, cast(null as varchar) as mdfd_by,
             cast(null as timestamp) as mdfd_dt
      from customer where c_custkey % 4 <> 0 and c_custkey % 3 <> 1) d""")

cte("ods_position", """
select min(event_id) as position_id, 'CORE' as src_sys, cast(user_id as varchar) as acct_num, event_type as trx_cd,
       cast(max(value) as decimal(18,2)) as amount, 'O' as actn_cd, cast(20241231 as decimal(19,0)) as btch_id,
       cast(null as varchar) as mdfd_by
from events where user_id % 3 = 0 group by user_id, event_type""")

cte("ods_trx", """
select event_id as trade_id, 'CORE' as src_sys, cast(user_id as varchar) as acct_num, event_type as trx_cd,
       cast(value as decimal(18,2)) as amount, case when event_id % 10 = 0 then 'R' else 'O' end as actn_cd,
       cast(null as bigint) as reversed_trade_id, cast(20241231 as decimal(19,0)) as btch_id
from events where event_id % 2 = 0""")

cte("trade_facts_batch", f"""
select trade_id, src_sys, acct_num, trx_cd, amount, sc_trx_actn_cd as actn_cd, cast(null as bigint) as reversed_trade_id,
       {BATCH_ID} as btch_id
from stg_trade""", ("stg_trade",))

cte("latest_trade", """
select * exclude (rn) from (
  select *, row_number() over (partition by acct_num order by created_dt desc nulls last,
         case when sc_trx_actn_cd = 'R' then 1 else 2 end asc nulls first, trade_id desc nulls last) as rn
  from stg_trade) x where rn = 1""", ("stg_trade",))

cte("first_trade", """
select try_strptime(created_dt, '%Y%m%d')::date as trd_dt, acct_num, frst_trd_acct_cd from (
  select *, row_number() over (partition by acct_num order by try_strptime(btch_dt, '%Y%m%d')::date desc nulls last,
         created_dt desc nulls last, trade_id desc nulls last) as rn
  from stg_trade where frst_trd_acct_cd = 'Y') x where rn = 1""", ("stg_trade",))

cte("cust", f"""
select acct_num, state_nm, acct_closg_dt, acct_open_dt, nullif(custdn_firm_mnm, '') as custdn_firm_mnm,
       'INVESTMENTS' as plan_cd,
       case when try_strptime(acct_closg_dt, '%Y%m%d')::date <= {BATCH_DATE} then 'T' else 'A' end as plcy_status
from stg_cstmr""", ("stg_cstmr",))

cte("pol_lkp", """
select s.src_sys, s.acct_num, pm.plcy_mastr_id, coalesce(spm.src_prod_mastr_id, -99) as src_prod_mastr_id,
       try_strptime(s.btch_dt, '%Y%m%d')::date as src_btch_dt, trd.trd_dt as frst_trd_dt,
       case when s.sc_trx_actn_cd in ('O', 'U', 'R') then try_strptime(c.acct_open_dt, '%Y%m%d')::date end
           as cust_plcy_incptn_dt,
       -99 as lob_mastr_id, coalesce(st.ref_id, -99) as plcy_status_id,
       coalesce(c.state_nm, 'N/A') as cust_plcy_iss_state_cd, 'N/A' as resdnt_state_cd,
       try_strptime(c.acct_closg_dt, '%Y%m%d')::date as plcy_trmntn_dt, cast(null as varchar) as plcy_nm,
       c.custdn_firm_mnm as cust_custdn_firm_nm, 'Y' as actv_indctr
from (select *, 'INVESTMENTS' as plan_cd from latest_trade) s
left join (select plcy_num, plcy_mastr_id from ods_plcy_mastr where src_sys = 'CORE') pm on s.acct_num = pm.plcy_num
left join src_prod_mastr spm on s.plan_cd = spm.plan_cd
left join cust c on s.acct_num = c.acct_num
left join first_trade trd on s.acct_num = trd.acct_num
left join ref_status st on coalesce(c.plcy_status, '-') = coalesce(st.src_sys_ref_cd, '-')""",
    ("latest_trade", "ods_plcy_mastr", "src_prod_mastr", "cust", "first_trade", "ref_status"))

cte("pol_ident", """
select *, md5(upper(concat_ws('', cast(plcy_iss_dt as varchar), '~', cast(plcy_status_id as varchar), '~',
                              custdn_firm_nm))) as hash_key
from (select l.*, t.plcy_detl_id as tgt_plcy_detl_id, t.hash_key as tgt_hash_key,
             case when t.plcy_detl_id is null or t.plcy_iss_dt is not distinct from DATE '1900-01-01'
                  then l.src_btch_dt else t.plcy_iss_dt end as plcy_iss_dt,
             case when t.plcy_detl_id is null then l.cust_custdn_firm_nm
                  else coalesce(l.cust_custdn_firm_nm, t.custdn_firm_nm) end as custdn_firm_nm,
             case when t.plcy_detl_id is null or t.first_depst_dt is not distinct from DATE '1900-01-01'
                  then coalesce(l.frst_trd_dt, l.src_btch_dt)
                  else coalesce(l.frst_trd_dt, t.first_depst_dt) end as first_depst_dt
      from (select * from pol_lkp where plcy_mastr_id is not null) l
      left join (select * from ods_plcy_detl where actv_indctr = 'Y') t
        on l.src_sys = t.src_sys and l.plcy_mastr_id = t.plcy_mastr_id) x""", ("pol_lkp", "ods_plcy_detl"))

cte("pol_changed", """
select * from pol_ident where tgt_plcy_detl_id is null or hash_key is distinct from tgt_hash_key""", ("pol_ident",))

POL_COLS = ("plcy_detl_id, plcy_mastr_id, src_sys, plcy_iss_dt, custdn_firm_nm, plcy_status_id, first_depst_dt, "
            "actv_indctr, "
            "eff_from_dt, eff_to_dt, btch_id, crtd_by, crtd_dt, mdfd_by, mdfd_dt, hash_key")


def _stamp(flag: str) -> str:
    return (f"'{flag}' as actv_indctr, {BATCH_DATE} as eff_from_dt, DATE '9999-12-31' as eff_to_dt, "
            f"{BATCH_ID} as btch_id, 'ods_load-trade' as crtd_by, {BATCH_TS} as crtd_dt, "
            "cast(null as varchar) as mdfd_by, cast(null as timestamp) as mdfd_dt")


def _numbered(src: str) -> str:
    return (f"select cast((select max(plcy_detl_id) from ods_plcy_detl) + row_number() over (order by plcy_mastr_id)"
            f" as bigint) as plcy_detl_id, * exclude (plcy_detl_id) from ({src}) z")


cte("pol_versions", _numbered(f"""
select cast(null as bigint) as plcy_detl_id, plcy_mastr_id, src_sys, plcy_iss_dt, custdn_firm_nm, plcy_status_id,
       first_depst_dt, {_stamp('Y')}, hash_key from pol_changed"""), ("pol_changed", "ods_plcy_detl"))


def _superseded_state(state: str) -> str:
    return f"""
select plcy_detl_id, plcy_mastr_id, src_sys, plcy_iss_dt, custdn_firm_nm, plcy_status_id, first_depst_dt,
       case when rno > 1 then 'N' else actv_indctr end as actv_indctr, eff_from_dt,
       case when rno > 1 then {BATCH_DATE} - 1 else eff_to_dt end as eff_to_dt, btch_id, crtd_by, crtd_dt,
       case when rno > 1 then 'ods_load-trade' else mdfd_by end as mdfd_by,
       case when rno > 1 then {BATCH_TS} else mdfd_dt end as mdfd_dt, hash_key
from (select s.*, case when actv_indctr in ('Y', 'D') then row_number() over (
          partition by src_sys, plcy_mastr_id, actv_indctr in ('Y', 'D')
          order by eff_from_dt desc, plcy_detl_id desc) end as rno
      from ({state}) s) r"""


cte("pol_next", _superseded_state(f"select {POL_COLS} from ods_plcy_detl union all select {POL_COLS} from pol_versions"),
    ("ods_plcy_detl", "pol_versions"))

cte("pol_full_changes", _numbered(f"""
select cast(null as bigint) as plcy_detl_id, plcy_mastr_id, src_sys, plcy_iss_dt, custdn_firm_nm, plcy_status_id,
       first_depst_dt, {_stamp('Y')}, hash_key from pol_changed
union all
select cast(null as bigint), t.plcy_mastr_id, t.src_sys, t.plcy_iss_dt, t.custdn_firm_nm, t.plcy_status_id,
       t.first_depst_dt, {_stamp('D')}, t.hash_key
from ods_plcy_detl t
where t.actv_indctr = 'Y' and t.src_sys = 'CORE' and not exists (
  select 1 from pol_lkp l where l.plcy_mastr_id is not null and l.src_sys = t.src_sys
                              and l.plcy_mastr_id = t.plcy_mastr_id)"""), ("pol_changed", "ods_plcy_detl", "pol_lkp"))

cte("positions_batch", f"""
select trade_id as position_id, src_sys, acct_num, trx_cd, amount, sc_trx_actn_cd as actn_cd, {BATCH_ID} as btch_id,
       cast(null as varchar) as mdfd_by
from (select *, row_number() over (partition by acct_num, trx_cd order by trade_id desc) as rn from stg_trade) x
where rn = 1""", ("stg_trade",))

cte("pos_first_new", """
select b.* from positions_batch b
where b.actn_cd is distinct from 'U'
  and not exists (select 1 from ods_position p where p.acct_num = b.acct_num and p.trx_cd = b.trx_cd)""",
    ("positions_batch", "ods_position"))

cte("pos_after_first", "select * from ods_position union all select * from pos_first_new",
    ("ods_position", "pos_first_new"))

cte("pos_updated", """
select a.position_id, a.src_sys, a.acct_num, a.trx_cd, h.amount, a.actn_cd, h.btch_id, 'ods_load-asset' as mdfd_by
from pos_after_first a join (select * from positions_batch where actn_cd = 'U') h
  on a.acct_num = h.acct_num and a.trx_cd = h.trx_cd""", ("pos_after_first", "positions_batch"))

cte("pos_lone", """
select position_id, src_sys, acct_num, trx_cd, amount, 'O' as actn_cd, btch_id, mdfd_by
from positions_batch h where actn_cd = 'U'
  and not exists (select 1 from pos_after_first a where a.acct_num = h.acct_num and a.trx_cd = h.trx_cd)""",
    ("positions_batch", "pos_after_first"))

cte("acct_type1", """
select coalesce(b.customer_id, t.customer_id) as customer_id,
       b.customer_name as b_name, b.industry as b_ind, b.revenue_usd as b_rev,
       t.customer_name as t_name, t.industry as t_ind, t.revenue_usd as t_rev,
       case when b.customer_id is null then null when t.customer_id is null then 'I'
            when md5(upper(concat_ws('', b.customer_name, '~', b.industry, '~', cast(b.revenue_usd as varchar))))
                 is distinct from
                 md5(upper(concat_ws('', t.customer_name, '~', t.industry, '~', cast(t.revenue_usd as varchar))))
            then 'U' else 'N' end as flg
from acct_incoming b full outer join (select * from ods_account where is_current) t on b.customer_id = t.customer_id""",
    ("acct_incoming", "ods_account"))

cte("order_violations", """
select o_orderkey, 'PRICE_OUTLIER' as dq_reason_cd from orders where o_totalprice > 450000
union all select o_orderkey, 'PRIORITY_NOT_SPECIFIED' from orders where o_orderpriority = '4-NOT SPECIFIED'
union all select o_orderkey, 'ORDER_AFTER_CUTOFF' from orders where o_orderdate >= TIMESTAMP '2001-01-01'
union all select o_orderkey, 'OPEN_TOO_LONG' from orders where o_orderstatus = 'O' and o_orderdate < TIMESTAMP '1996-01-01'""")

cte("missing_trx", """
select trx_cd, count(*) as n_rows from stg_trade s
where trx_cd is not null and not exists (select 1 from trx_mastr m where m.trx_cd = s.trx_cd) group by trx_cd""",
    ("stg_trade", "trx_mastr"))

cte("supplier_aligned", """
select cast(s_suppkey as bigint) as S_SUPPKEY, s_name as S_NAME, s_nationkey as S_NATIONKEY,
       cast(s_acctbal as decimal(18,2)) as S_ACCTBAL, cast(null as varchar) as S_PHONE from supplier""")

# ------------------------------------------------------------------ queries 2

ACCT_PAYLOAD = ("json_object('account_id', account_id, 'account_name', account_name, 'industry', industry, "
                "'annual_revenue', annual_revenue, 'created_date', strftime(created_date, '%Y-%m-%d %H:%M:%S'), "
                "'last_modified_date', strftime(last_modified_date, '%Y-%m-%d %H:%M:%S'))")

ORACLE.update({
    "surrogate_keys": sql("""
select customer_id, cast((select max(customer_account_sk) from ods_account) + row_number() over (order by customer_id)
       as bigint) as customer_account_sk
from acct_classified where row_type in ('NEW', 'CHANGED')""", "acct_classified", "ods_account"),
    "surrogate_keys_orders": sql("""
select order_nk, cast(row_number() over (order by order_nk) as bigint) as order_sk
from (select 'O' || lpad(cast(o_orderkey as varchar), 12, '0') as order_nk from orders) o"""),
    "reject_rows": sql(f"""
select 'run-20250101' as batch_run_id, 'STG_ACCOUNTS' as source_table, account_id as source_row_identifier,
       'NULL_NATURAL_KEY' as rejection_reason_code, {BATCH_TS} as rejection_timestamp, {ACCT_PAYLOAD} as raw_source_payload
from stg_account where account_id is null
union all
select 'run-20250101', 'STG_ACCOUNTS', account_id, 'INVALID_REVENUE_CAST', {BATCH_TS}, {ACCT_PAYLOAD}
from stg_account where account_id is not null and annual_revenue is not null
  and try_cast(annual_revenue as decimal(18,2)) is null""", "stg_account"),
    "single_active_violations": sql("""
select customer_id, count(*) as n_current from (
  select * from acct_next_state
  union all
  select * from acct_next_state where is_current and cast(substr(customer_id, 2, 12) as bigint) % 50 = 0) s
where is_current group by customer_id having count(*) > 1""", "acct_next_state"),
    "rerun_is_noop": sql("select * from acct_next_state", "acct_next_state"),
    "audit_summary": sql(f"""
select {BATCH_ID} as btch_id, {JOB} as job_nm, 'CORE' as src_sys, n_source as src_cnt,
       n_new + n_changed as tgt_cnt, n_unchanged as fltr_cnt, n_reject_null_key + n_reject_cast as rej_cnt,
       n_source = n_new + n_changed + n_unchanged + n_reject_null_key + n_reject_cast as balanced,
       {BATCH_TS} as start_ts, 'customer_account' as tgt_tbl_nm, 'STG_ACCOUNTS' as src_file_nm,
       n_reject_null_key, n_reject_cast, n_new, n_changed, n_unchanged
from (select (select count(*) from stg_account) as n_source,
             (select count(*) from stg_account where account_id is null) as n_reject_null_key,
             (select count(*) from stg_account where account_id is not null and annual_revenue is not null
                and try_cast(annual_revenue as decimal(18,2)) is null) as n_reject_cast,
             (select count(*) from acct_classified where row_type = 'NEW') as n_new,
             (select count(*) from acct_classified where row_type = 'CHANGED') as n_changed,
             (select count(*) from acct_classified where row_type = 'UNCHANGED') as n_unchanged) c""",
        "stg_account", "acct_classified"),
    "scd2_rollback_columns": sql("select * exclude (dw_update_timestamp) from ods_account", "ods_account"),
    "type1_route": sql("""
select customer_id, b_name as customer_name, b_ind as industry, b_rev as revenue_usd, flg as insert_update_flg
from acct_type1 where flg in ('I', 'U')""", "acct_type1"),
    "type1_upsert": sql(f"""
select customer_id,
       case when flg in ('I', 'U') then b_name else t_name end as customer_name,
       case when flg in ('I', 'U') then b_ind else t_ind end as industry,
       case when flg in ('I', 'U') then b_rev else t_rev end as revenue_usd,
       case when flg = 'U' then 'ods_load-account' end as mdfd_by,
       case when flg = 'U' then {BATCH_TS} end as mdfd_dt
from acct_type1""", "acct_type1"),
    "default_columns": sql("""
select src_sys, acct_num as plcy_num, acct_num as left_justfd_plcy_num, 'SS' as src_admn_sys, 'N/A' as plcy_comp_cd,
       'N/A' as invstmt_comp_tax_id, -99 as case_mastr_id, 'P' as plcy_sold_status_indctr, '-99' as del_indctr
from stg_trade""", "stg_trade"),
    "audit_columns": sql(f"""
select distinct src_sys, acct_num as plcy_num, acct_num as left_justfd_plcy_num, 'SS' as src_admn_sys,
       'N/A' as plcy_comp_cd, 'N/A' as invstmt_comp_tax_id, -99 as case_mastr_id, 'P' as plcy_sold_status_indctr,
       '-99' as del_indctr, {BATCH_ID} as btch_id, {BATCH_DATE} as crtd_dt, 'ods_load-trade' as crtd_by,
       cast(null as date) as mdfd_dt, cast(null as varchar) as mdfd_by
from stg_trade""", "stg_trade"),
    "insert_only_load": sql(f"""
select 'SS' as src_admn_sys, 'N/A' as plcy_comp_cd, plcy_num, plcy_num as left_justfd_plcy_num, {BATCH_ID} as btch_id,
       {BATCH_DATE} as crtd_dt, cast(null as date) as mdfd_dt, 'ods_load-trade' as crtd_by,
       cast(null as varchar) as mdfd_by, -99 as case_mastr_id, src_sys, 'P' as plcy_sold_status_indctr,
       '-99' as del_indctr, 'N/A' as invstmt_comp_tax_id
from (select distinct src_sys, acct_num as plcy_num from stg_trade where src_sys is not null and acct_num is not null) s
where not exists (select 1 from ods_plcy_mastr m where m.src_sys = 'CORE' and m.src_sys = s.src_sys
                  and m.plcy_num = s.plcy_num)""", "stg_trade", "ods_plcy_mastr"),
    "dedup_natural_key": sql("""
select event_id, user_id, event_type, ts, value from (
  select event_id, user_id, event_type, ts, value,
         row_number() over (partition by user_id, event_type order by ts asc nulls first, event_id asc nulls first) as rn
  from events) x where rn = 1"""),
    "duplicate_keys": sql("select user_id, count(*) as n_rows from events group by user_id having count(*) > 1"),
    "duplicate_keys_sample": sql("""
select user_id, count(*) as n_rows from events group by user_id having count(*) > 1 order by user_id limit 20"""),
    "latest_per_key": sql("select * from latest_trade", "latest_trade"),
    "first_trade_lookup": sql("select * from first_trade", "first_trade"),
    "missing_codes": sql("select * from missing_trx", "missing_trx"),
    "missing_code_alert": sql("""
select cast(coalesce(sum(n_rows), 0) as bigint) as n_rows, count(*) as n_codes
from missing_trx""", "missing_trx"),
    "missing_codes_excluded": sql("select * from stg_trade where trx_cd is null or trx_cd in (select trx_cd from trx_mastr)",
                                  "stg_trade", "trx_mastr"),
    "reversal_load": sql(f"""
select cast(null as bigint) as trade_id, src_sys, acct_num, trx_cd, cast(-amount as decimal(18,2)) as amount,
       'R' as actn_cd, trade_id as reversed_trade_id, {BATCH_ID} as btch_id
from (select *, row_number() over (partition by acct_num, trx_cd order by trade_id desc) as rn
      from (select * from ods_trx union all select * from trade_facts_batch) t
      where actn_cd is distinct from 'R' and btch_id is distinct from {BATCH_ID}
        and exists (select 1 from stg_trade s where s.sc_trx_actn_cd in ('C', 'U')
                    and s.acct_num = t.acct_num and s.trx_cd = t.trx_cd)) x
where rn = 1""", "ods_trx", "trade_facts_batch", "stg_trade"),
    "batch_delete": sql(f"""
select * from (select * from ods_trx union all select * from trade_facts_batch) s
where btch_id is distinct from {BATCH_ID}""", "ods_trx", "trade_facts_batch"),
    "held_updates": sql("select * from pos_first_new", "pos_first_new"),
    "held_update_match": sql("select * from pos_updated", "pos_updated"),
    "held_update_nomatch": sql("select * from pos_lone", "pos_lone"),
    "held_update_next_state": sql("""
select * from pos_after_first a
where not exists (select 1 from pos_updated u where u.acct_num = a.acct_num and u.trx_cd = a.trx_cd)
union all select * from pos_updated
union all select * from pos_lone""", "pos_after_first", "pos_updated", "pos_lone"),
    "blank_to_null": sql("""
select acct_num, state_nm, nullif(acct_closg_dt, '') as acct_closg_dt, acct_open_dt,
       nullif(custdn_firm_mnm, '') as custdn_firm_mnm from stg_cstmr""", "stg_cstmr"),
    "derived_status": sql("select acct_num, plcy_status from cust", "cust"),
    "nullsafe_lookup": sql("""
select c.acct_num, c.plcy_status, coalesce(st.ref_id, -99) as plcy_status_id
from cust c left join ref_status st on coalesce(c.plcy_status, '-') = coalesce(st.src_sys_ref_cd, '-')""",
        "cust", "ref_status"),
    "lookup_enrich": sql("select * from pol_lkp", "pol_lkp"),
    "lookup_enrich_lineitem": sql("""
select l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
       coalesce(p.p_brand, 'N/A') as p_brand, coalesce(p.p_type, 'N/A') as p_type, s.s_name,
       coalesce(s.s_nationkey, -99) as s_nationkey, coalesce(n.n_name, 'N/A') as supp_nation
from lineitem l
left join (select * from part where p_size > 5) p on l.l_partkey = p.p_partkey
left join supplier s on l.l_suppkey = s.s_suppkey
left join nation n on coalesce(s.s_nationkey, -99) = n.n_nationkey"""),
    "policy_not_found": sql("select src_sys, acct_num from pol_lkp where plcy_mastr_id is null", "pol_lkp"),
    "carry_forward": sql("""
select src_sys, plcy_mastr_id, tgt_plcy_detl_id, plcy_iss_dt, custdn_firm_nm, plcy_status_id, first_depst_dt
from pol_ident""",
                         "pol_ident"),
    "row_hash": sql("select src_sys, plcy_mastr_id, hash_key, tgt_hash_key from pol_ident", "pol_ident"),
    "hash_change_filter": sql("select src_sys, plcy_mastr_id, tgt_plcy_detl_id, hash_key from pol_changed",
                              "pol_changed"),
    "scd2_hash_next_state": sql("select * from pol_next", "pol_next"),
    "supersede_expire": sql(f"""
select * from pol_next where actv_indctr = 'N' and eff_to_dt = {BATCH_DATE} - 1 and mdfd_dt = {BATCH_TS}""",
                            "pol_next"),
    "scd2_rollback": sql(f"select {POL_COLS} from ods_plcy_detl", "ods_plcy_detl"),
    "full_file_inactivate": sql(_superseded_state(
        f"select {POL_COLS} from ods_plcy_detl union all select {POL_COLS} from pol_full_changes"),
        "ods_plcy_detl", "pol_full_changes"),
    "error_log": sql(f"""
select 'EC_25' as err_cd, 'CORE' as src_sys, 'STG_TRADE' as file_nm, {BATCH_ID} as btch_id,
       {BATCH_DATE} as btch_dt, {JOB} as job_nm, 'plcy_detl' as tgt_tbl_nm, acct_num as err_key,
       json_object('src_sys', src_sys, 'acct_num', acct_num) as err_payload
from pol_lkp where plcy_mastr_id is null
union all
select 'EC_26', 'CORE', 'STG_TRADE', {BATCH_ID}, {BATCH_DATE}, {JOB}, 'invstmt_fund_trx',
       cast(trade_id as varchar), json_object('acct_num', acct_num, 'trx_cd', trx_cd, 'sc_trx_actn_cd', sc_trx_actn_cd)
from stg_trade s where not exists (select 1 from trx_mastr m where m.trx_cd = s.trx_cd)""",
        "pol_lkp", "stg_trade", "trx_mastr"),
    "dq_violations": sql("select * from order_violations", "order_violations"),
    "dq_reason_summary": sql("select dq_reason_cd, count(*) as n_rows from order_violations group by dq_reason_cd",
                             "order_violations"),
    "dq_exclude": sql("select * from orders where o_orderkey not in (select o_orderkey from order_violations)",
                      "order_violations"),
    "typed_scan": sql("""
select o_orderkey, o_custkey, o_orderstatus, try_cast(o_totalprice as decimal(18,2)) as o_totalprice,
       cast(o_orderdate as date) as o_orderdate, o_orderpriority from orders"""),
    "csv_scan": sql("""
select cast(c_custkey as varchar) as c_custkey, c_name, cast(cast(c_acctbal as decimal(18,2)) as varchar) as c_acctbal,
       case when c_custkey % 11 = 0 then null else concat(c_mktsegment, ', "', c_name, '"') end as c_note
from customer"""),
    "schema_align": sql("select * from supplier_aligned", "supplier_aligned"),
    "append_aligned": sql("select * from supplier_aligned", "supplier_aligned"),
    "utc_normalise": sql("select event_id, ts - INTERVAL 330 MINUTE as ts from events"),
})

cte("job_keys", """
select distinct src_sys, acct_num from stg_trade where src_sys is not null and acct_num is not null""", ("stg_trade",))

ORACLE["job_insert_only"] = ORACLE["insert_only_load"]
ORACLE["job_type1"] = ORACLE["type1_upsert"]
ORACLE["job_versioned_hash"] = ORACLE["scd2_hash_next_state"]
ORACLE["job_audit"] = sql(f"""
select {BATCH_ID} as btch_id, {JOB} as job_nm, 'CORE' as src_sys, n_source as src_cnt, n_loaded as tgt_cnt,
       n_filtered + n_unchanged + n_duplicates as fltr_cnt, n_rejected as rej_cnt,
       n_source = n_loaded + n_filtered + n_unchanged + n_duplicates + n_rejected as balanced,
       {BATCH_TS} as start_ts, 'plcy_mastr' as tgt_tbl_nm, 'STG_TRADE' as src_file_nm,
       n_loaded, n_rejected, n_filtered, n_duplicates, n_unchanged
from (select n_source, n_loaded, n_rejected, n_source - n_filtered_in as n_filtered,
             n_filtered_in - n_rejected - n_deduped as n_duplicates, n_deduped - n_loaded as n_unchanged
      from (select (select count(*) from stg_trade) as n_source,
                   (select count(*) from stg_trade) as n_filtered_in,
                   (select count(*) from stg_trade where src_sys is null or acct_num is null) as n_rejected,
                   (select count(*) from job_keys) as n_deduped,
                   (select count(*) from job_keys k where not exists (
                        select 1 from ods_plcy_mastr m where m.src_sys = 'CORE' and m.src_sys = k.src_sys
                          and m.plcy_num = k.acct_num)) as n_loaded) c) d""", "job_keys", "ods_plcy_mastr")

ORACLE["summary_load"] = sql(f"""
select src_sys, acct_num, count(*) as trx_cnt, count(*) filter (where actn_cd = 'R') as reversal_cnt,
       cast(sum(amount) as decimal(28,2)) as net_amount, max(trade_id) as last_trade_id, {BATCH_ID} as btch_id
from (select * from ods_trx union all select * from trade_facts_batch
      union all ({ORACLE["reversal_load"]})) f
where btch_id = {BATCH_ID}
group by src_sys, acct_num""", "ods_trx", "trade_facts_batch")

ORACLE["job_versioned_columns"] = ORACLE["scd2_next_state"]
ORACLE["job_versioned_columns_audit"] = sql(f"""
select {BATCH_ID} as btch_id, {JOB} as job_nm, 'CORE' as src_sys, n_source as src_cnt, n_loaded as tgt_cnt,
       n_filtered + n_unchanged + n_duplicates as fltr_cnt, n_rejected as rej_cnt,
       n_source = n_loaded + n_filtered + n_unchanged + n_duplicates + n_rejected as balanced,
       {BATCH_TS} as start_ts, 'customer_account' as tgt_tbl_nm, 'STG_ACCOUNTS' as src_file_nm,
       n_loaded, n_rejected, n_filtered, n_duplicates, n_unchanged
from (select n_source, n_loaded, n_rejected, 0::bigint as n_filtered,
             n_source - n_rejected - n_deduped as n_duplicates, n_deduped - n_loaded as n_unchanged
      from (select (select count(*) from stg_account) as n_source,
                   (select count(*) from stg_account where account_id is null
                      or (annual_revenue is not null and try_cast(annual_revenue as decimal(18,2)) is null))
                       as n_rejected,
                   (select count(*) from acct_incoming) as n_deduped,
                   (select count(*) from acct_inserts) as n_loaded) c) d""",
    "stg_account", "acct_incoming", "acct_inserts")
ORACLE["job_full_file"] = ORACLE["full_file_inactivate"]
ORACLE["job_insert_only_text"] = ORACLE["insert_only_load"]
ORACLE["target_batch_count"] = sql(f"""
select count(*) as tgt_cnt from pol_next where btch_id = {BATCH_ID} and crtd_by = 'ods_load-trade'""", "pol_next")

cte("trade_known", """
select * from stg_trade s
where s.trx_cd is null or exists (select 1 from trx_mastr m where m.trx_cd = s.trx_cd)""", ("stg_trade", "trx_mastr"))

cte("known_keys", """
select distinct src_sys, acct_num from trade_known where src_sys is not null and acct_num is not null""",
    ("trade_known",))

ORACLE["job_codes_excluded"] = sql(f"""
select 'SS' as src_admn_sys, 'N/A' as plcy_comp_cd, acct_num as plcy_num, acct_num as left_justfd_plcy_num,
       {BATCH_ID} as btch_id, {BATCH_DATE} as crtd_dt, cast(null as date) as mdfd_dt, 'ods_load-trade' as crtd_by,
       cast(null as varchar) as mdfd_by, -99 as case_mastr_id, src_sys, 'P' as plcy_sold_status_indctr,
       '-99' as del_indctr, 'N/A' as invstmt_comp_tax_id
from known_keys k
where not exists (select 1 from ods_plcy_mastr m where m.src_sys = 'CORE' and m.src_sys = k.src_sys
                  and m.plcy_num = k.acct_num)""", "known_keys", "ods_plcy_mastr")

ORACLE["job_codes_excluded_audit"] = sql(f"""
select {BATCH_ID} as btch_id, {JOB} as job_nm, 'CORE' as src_sys, n_source as src_cnt, n_loaded as tgt_cnt,
       n_filtered + n_unchanged + n_duplicates as fltr_cnt, n_rejected as rej_cnt,
       n_source = n_loaded + n_filtered + n_unchanged + n_duplicates + n_rejected as balanced,
       {BATCH_TS} as start_ts, 'plcy_mastr' as tgt_tbl_nm, 'STG_TRADE' as src_file_nm,
       n_loaded, n_rejected, n_filtered, n_duplicates, n_unchanged
from (select n_source, n_loaded, n_code + n_later as n_rejected, n_source - n_code - n_known as n_filtered,
             n_known - n_later - n_deduped as n_duplicates, n_deduped - n_loaded as n_unchanged
      from (select (select count(*) from stg_trade) as n_source,
                   (select count(*) from stg_trade) - (select count(*) from trade_known) as n_code,
                   (select count(*) from trade_known) as n_known,
                   (select count(*) from trade_known where src_sys is null or acct_num is null) as n_later,
                   (select count(*) from known_keys) as n_deduped,
                   (select count(*) from known_keys k where not exists (
                        select 1 from ods_plcy_mastr m where m.src_sys = 'CORE' and m.src_sys = k.src_sys
                          and m.plcy_num = k.acct_num)) as n_loaded) c) d""",
    "stg_trade", "trade_known", "known_keys", "ods_plcy_mastr")
ORACLE["job_error_log"] = sql(f"""
select 'EC_26' as err_cd, 'CORE' as src_sys, 'STG_TRADE' as file_nm, {BATCH_ID} as btch_id,
       {BATCH_DATE} as btch_dt, {JOB} as job_nm, 'plcy_mastr' as tgt_tbl_nm, cast(trade_id as varchar) as err_key,
       json_object('trx_cd', trx_cd) as err_payload
from stg_trade s
where s.trx_cd is not null and not exists (select 1 from trx_mastr m where m.trx_cd = s.trx_cd)""",
    "stg_trade", "trx_mastr")


# ------------------------------------------------------------------ published table

ORACLE["bucketed_load"] = ORACLE["publish_interrupted"] = ORACLE["scd2_next_state"]
ORACLE["rerun_published"] = sql("select *, 1 as n_commits from acct_next_state", "acct_next_state")
ORACLE["late_batch"] = sql("select *, true as refused from acct_next_state", "acct_next_state")
ORACLE["rollback_published"] = sql("select * from ods_account", "ods_account")
ORACLE["scd2_rollback_images"] = sql(f"""
select {POL_COLS} from (
  select * replace (case when plcy_mastr_id % 6 = 0 then 'D' else actv_indctr end as actv_indctr,
                    case when plcy_mastr_id % 6 = 0 then 'close' else mdfd_by end as mdfd_by,
                    case when plcy_mastr_id % 6 = 0 then crtd_dt else mdfd_dt end as mdfd_dt) from ods_plcy_detl) t""", "ods_plcy_detl")

ORACLE["job_full_file_stopped"] = sql(
    f"select {POL_COLS}, 'no row of the file is left to load' as stopped from ods_plcy_detl", "ods_plcy_detl")
ORACLE["job_error_log_unmatched"] = sql(f"""
select 'EC_25' as err_cd, 'CORE' as src_sys, 'STG_TRADE' as file_nm, {BATCH_ID} as btch_id, {BATCH_DATE} as btch_dt, {JOB} as job_nm,
       'plcy_detl' as tgt_tbl_nm, acct_num as err_key, json_object('src_sys', src_sys, 'plcy_mastr_id', plcy_mastr_id, 'acct_num', acct_num) as err_payload
from pol_lkp where plcy_mastr_id is null""", "pol_lkp")
# every outcome counted by itself; the rows the step loses are in none of them
ORACLE["job_audit_loss"] = sql(f"""
select {BATCH_ID} as btch_id, {JOB} as job_nm, 'CORE' as src_sys, n_source as src_cnt, n_loaded as tgt_cnt,
       n_filtered + n_unchanged + n_duplicates as fltr_cnt, n_rejected as rej_cnt, false as balanced,
       {BATCH_TS} as start_ts, 'plcy_mastr' as tgt_tbl_nm, 'STG_TRADE' as src_file_nm,
       n_loaded, n_rejected, n_filtered, n_duplicates, n_unchanged
from (select (select count(*) from stg_trade) as n_source, 0::bigint as n_rejected, 0::bigint as n_filtered,
             (select count(*) - count(distinct acct_num) from stg_trade where cast(acct_num as bigint) % 7 <> 0) as n_duplicates,
             (select count(*) from job_keys k where cast(acct_num as bigint) % 7 <> 0 and exists (
                select 1 from ods_plcy_mastr m where m.src_sys = 'CORE' and m.src_sys = k.src_sys and m.plcy_num = k.acct_num)) as n_unchanged,
             (select count(*) from job_keys k where cast(acct_num as bigint) % 7 <> 0 and not exists (
                select 1 from ods_plcy_mastr m where m.src_sys = 'CORE' and m.src_sys = k.src_sys and m.plcy_num = k.acct_num)) as n_loaded) c""",
    "job_keys", "ods_plcy_mastr", "stg_trade")
