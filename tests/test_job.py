"""Dataset spec: validation, SQL steps with bound parameters, load types."""

import pytest

from dimforge.context import RunContext
from dimforge.plans import datasets, job
from dimforge.plans import fixtures as fx

CTX = RunContext(batch_id=5, batch_ts="2025-02-02 02:00:00", batch_date="2025-02-02", job="jb", run_id="r")


def test_validate_reports_every_problem():
    spec = job.DatasetSpec(name="x", target_table="t", load_type=3, natural_key=(), surrogate_key=None,
                           sources={"weird": lambda s: None}, lookup=job.Step("lkp"))
    errors = job.validate(spec)
    assert any("load_type" in e for e in errors)
    assert any("natural_key" in e for e in errors)
    assert any("file type" in e for e in errors)
    assert any("exactly one of sql or fn" in e for e in errors)
    with pytest.raises(ValueError):
        job.run(None, spec, CTX, None)


def test_missing_file_type_is_an_error(spark, sf_dir):
    spec = datasets.trade_policy_master(sf_dir)
    with pytest.raises(ValueError, match="no 'event' source"):
        job.run(spark, spec, CTX, fx.ods_plcy_mastr(spark, sf_dir), file_type="event")


def test_sql_steps_bind_parameters_and_balance(spark, sf_dir):
    spec = datasets.trade_policy_master(sf_dir)
    res = job.run(spark, spec, CTX, fx.ods_plcy_mastr(spark, sf_dir))
    row = res.rows.first()
    assert row.crtd_by == "jb-trade" and str(row.crtd_dt) == "2025-02-02" and int(row.btch_id) == 5
    audit = res.audit.first()
    assert audit.balanced and audit.src_cnt == fx.stg_trade(spark, sf_dir).count()


def test_type1_spec_runs_through_operators(spark, sf_dir):
    res = job.run(spark, datasets.account_upsert(sf_dir), CTX, datasets.account_upsert_target(spark, sf_dir))
    flags = {r.insert_update_flg for r in res.frames["routed"].collect()}
    assert flags <= {"I", "U"}
    assert res.rows.where("mdfd_by = 'jb-account'").count() == res.frames["routed"].where("insert_update_flg = 'U'").count()


def test_temp_steps_and_lookup_tables_are_visible_to_later_sql(spark, sf_dir):
    spec = datasets.trade_policy_master(sf_dir)
    spec.lookups = {"codes": lambda s: fx.trx_mastr(s)}
    spec.source_filter = job.Step("src", sql="select src_sys, acct_num, trx_cd from {src_file}")
    spec.temp_steps = [job.Step("known", sql="select s.* from {src} s left semi join {codes} c on s.trx_cd = c.trx_cd", filters="src")]
    spec.lookup = job.Step("lkp", sql=spec.lookup.sql.replace("{src}", "{known}"))
    res = job.run(spark, spec, CTX, fx.ods_plcy_mastr(spark, sf_dir))
    assert res.frames["known"].count() < res.frames["src_file"].count()
    assert res.audit.first().balanced
    spec.temp_steps = [job.Step("early", sql="select * from {not_yet}")]
    with pytest.raises(ValueError, match="not_yet"):
        job.run(spark, spec, CTX, fx.ods_plcy_mastr(spark, sf_dir))


def test_duplicate_policies_on_the_account_load(spark, sf_dir):
    from pyspark.sql import functions as F

    from dimforge.operators.quality import DuplicateKeyError
    from dimforge.plans import account

    staged = fx.stg_account(spark, sf_dir)
    dup = staged.where(F.col("account_id").isNotNull()).limit(3).withColumn(
        "last_modified_date", F.col("last_modified_date") + F.expr("INTERVAL 1 DAY")).withColumn(
        "account_name", F.lit("newer"))
    batch = staged.unionByName(dup)
    with pytest.raises(DuplicateKeyError):
        account.load_account(fx.ods_account(spark, sf_dir), batch, CTX)
    _, result = account.load_account(fx.ods_account(spark, sf_dir), batch, CTX, duplicates="keep_latest")
    cur = result.next_state().where("is_current")
    assert cur.groupBy("customer_id").count().where("count > 1").count() == 0
    assert cur.where(F.col("customer_name") == "newer").count() == 3


def test_code_checks_alert_and_exclude(spark, sf_dir):
    spec = datasets.trade_policy_master(sf_dir)
    target = fx.ods_plcy_mastr(spark, sf_dir)
    spec.code_checks = [job.CodeCheck("trx_cd", fx.trx_mastr, "trx_cd", policy="default_id")]
    kept = job.run(spark, spec, CTX, target)
    alert = kept.frames["alert_trx_cd"].first()
    assert alert.n_codes == 2
    assert sorted(r.trx_cd for r in kept.frames["missing_trx_cd"].collect()) == ["purchase", "signup"]
    assert kept.audit.first().rej_cnt == 0
    spec.code_checks = [job.CodeCheck("trx_cd", fx.trx_mastr, "trx_cd", policy="exclude")]
    excl = job.run(spark, spec, CTX, target).audit.first()
    assert excl.balanced and excl.rej_cnt == alert.n_rows
    spec.code_checks = [job.CodeCheck("trx_cd", fx.trx_mastr, "trx_cd", policy="drop_silently")]
    with pytest.raises(ValueError, match="code-check policy"):
        job.run(spark, spec, CTX, target)


def test_rule_rejects_reach_the_error_log(spark, sf_dir):
    import json

    spec = datasets.account_versioned(sf_dir)
    spec.error_key = "account_id"
    res = job.run(spark, spec, CTX, fx.ods_account(spark, sf_dir))
    errs = res.errors.collect()
    from dimforge.operators.quality import bad_cast_condition

    # rules run before the NULL-key split, so rows with a NULL key count too
    bad = fx.stg_account(spark, sf_dir).where(bad_cast_condition("annual_revenue", "decimal(18,2)")).count()
    assert len(errs) == bad > 0
    assert {r.err_cd for r in errs} == {"EC_28"}
    assert {json.loads(r.err_payload)["dq_reason_cd"] for r in errs} == {"INVALID_REVENUE_CAST"}
    assert res.audit.first().balanced


def test_a_step_that_loses_or_multiplies_rows_unbalances_the_audit(spark, sf_dir):
    from pyspark.sql import functions as F

    target = fx.ods_plcy_mastr(spark, sf_dir)
    for lose in (lambda df: df.where("crc32(plcy_num) % 5 <> 0"), lambda df: df.unionByName(df.where("crc32(plcy_num) % 5 = 0"))):
        spec = datasets.trade_policy_master(sf_dir)
        sql = spec.lookup.sql
        spec.lookup = job.Step("lkp", fn=lambda f, ctx: lose(f["src"].sparkSession.sql(sql, src=f["src"])))
        assert not job.run(spark, spec, CTX, target).audit.first().balanced
    # a selection that drops changed rows before they are stamped
    spec = datasets.policy_detail(sf_dir)
    select = spec.select_fields.fn
    spec.select_fields = job.Step("final", fn=lambda f, ctx: select(f, ctx).where(F.col("plcy_mastr_id") % 2 == 0))
    from dimforge.plans import policy

    target = fx.ods_plcy_detl(spark, sf_dir).select(*policy.TARGET_COLUMNS)
    assert not job.run(spark, spec, CTX, target).audit.first().balanced
    assert job.run(spark, datasets.policy_detail(sf_dir), CTX, target).audit.first().balanced
    assert job.run(spark, datasets.policy_detail(sf_dir), CTX, target, file_type="full").audit.first().balanced
    assert job.run(spark, datasets.account_upsert(sf_dir), CTX, datasets.account_upsert_target(spark, sf_dir)).audit is not None


def test_an_empty_or_fully_filtered_full_file_inactivates_nothing(spark, sf_dir):
    from dimforge.plans import policy

    target = fx.ods_plcy_detl(spark, sf_dir).select(*policy.TARGET_COLUMNS)
    for name, source in (("empty file", lambda s: fx.stg_trade(s, sf_dir).limit(0)), ("no row of the file is left to load", None)):
        spec = datasets.policy_detail(sf_dir)
        if source is None:
            spec.source_filter = job.Step("src", sql="select * from {src_file} where src_sys = 'NOBODY'")
        else:
            spec.sources = {"full": source}
        res = job.run(spark, spec, CTX, target, file_type="full")
        assert res.stopped == name and res.rows.count() == 0 and "inactivated" not in res.frames
        assert res.frames["next_state"].exceptAll(target).isEmpty()
        audit = res.audit.first()
        assert audit.balanced and audit.tgt_cnt == 0 and audit.src_cnt == audit.fltr_cnt
