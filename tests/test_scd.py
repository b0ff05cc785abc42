"""Versioned loads: by columns and by hash; reruns, rollback, full files."""

from datetime import date

from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.operators.scd import Scd2Spec, already_loaded, rollback_columns_version, scd2_apply
from dimforge.operators.scd_hash import (HashScd2Spec, changed_or_new, identify, in_force, inactivation_rows,
                                         open_versions, rollback, supersede, superseded, with_hash)

SPEC = Scd2Spec(key="id", sk="sk", columns=("name", "note"), tracked=("name",))
CTX = RunContext(batch_id=9, batch_ts="2025-03-01 10:00:00", batch_date="2025-03-01", job="t", run_id="r")

TARGET_DDL = ("sk bigint, id string, name string, note string, effective_start_date timestamp_ntz, "
              "effective_end_date timestamp_ntz, is_current boolean, dw_insert_timestamp timestamp_ntz, "
              "dw_update_timestamp timestamp_ntz")


def _target(spark, rows):
    return spark.createDataFrame(rows, TARGET_DDL)


def _ts(s):
    import datetime as dt

    return dt.datetime.fromisoformat(s)


def _state(spark):
    t0 = _ts("2024-01-01 00:00:00")
    return _target(spark, [
        (10, "a", "A", "n1", t0, None, True, t0, t0),
        (11, "b", "B", "n2", t0, None, True, t0, t0),
        (12, "c", "C", None, t0, None, True, t0, t0),
        (5, "a", "A0", None, _ts("2023-01-01 00:00:00"), _ts("2023-12-31 23:59:59"), False, t0, t0),
    ])


def _batch(spark):
    return spark.createDataFrame([("a", "A", "changed note only"), ("b", "B2", None), ("d", "D", None)],
                                 "id string, name string, note string")


def test_classify_and_next_state(spark):
    r = scd2_apply(_state(spark), _batch(spark), SPEC, CTX)
    counts = {row.row_type: row.n for row in r.joined.groupBy("row_type").agg(F.count("*").alias("n")).collect()}
    assert counts == {"UNCHANGED": 1, "CHANGED": 1, "NEW": 1, "ABSENT": 1}
    state = r.next_state()
    cur = {row.id: row for row in state.where("is_current").collect()}
    assert set(cur) == {"a", "b", "c", "d"}
    assert cur["b"].name == "B2" and cur["b"].sk == 13  # high-water 12, ordered b < d
    assert cur["d"].sk == 14
    assert cur["a"].sk == 10  # untracked column change does not version
    closed = state.where("sk = 11").first()
    assert not closed.is_current and closed.effective_end_date == _ts("2025-03-01 09:59:59.999")
    assert closed.dw_insert_timestamp == _ts("2024-01-01 00:00:00")
    assert closed.dw_update_timestamp == _ts("2025-03-01 10:00:00")
    assert state.count() == 6


def test_at_most_one_current_version_and_unique_keys(spark):
    state = scd2_apply(_state(spark), _batch(spark), SPEC, CTX).next_state()
    assert state.where("is_current").groupBy("id").count().where("count > 1").count() == 0
    assert state.select("sk").distinct().count() == state.count()


def test_rerun_is_detected_and_harmless(spark):
    state = scd2_apply(_state(spark), _batch(spark), SPEC, CTX).next_state().checkpoint(eager=True)
    assert already_loaded(state, SPEC, CTX)
    again = scd2_apply(state, _batch(spark), SPEC, CTX).next_state()
    assert sorted(again.collect()) == sorted(state.collect())


def test_empty_batch_and_empty_target(spark):
    empty_batch = _batch(spark).limit(0)
    r = scd2_apply(_state(spark), empty_batch, SPEC, CTX)
    assert sorted(r.next_state().collect()) == sorted(_state(spark).collect())
    r2 = scd2_apply(_target(spark, []), _batch(spark), SPEC, CTX)
    assert sorted(x.sk for x in r2.next_state().collect()) == [1, 2, 3]


def test_rollback_restores_prior_state(spark):
    state = scd2_apply(_state(spark), _batch(spark), SPEC, CTX).next_state()
    back = rollback_columns_version(state, SPEC, CTX).drop("dw_update_timestamp")
    assert sorted(back.collect()) == sorted(_state(spark).drop("dw_update_timestamp").collect())


HSPEC = HashScd2Spec(keys=("sys", "pid"), sk="sk", hashed=("v",))
HDDL = ("sk bigint, sys string, pid bigint, v string, hash_key string, actv_indctr string, eff_from_dt date, "
        "eff_to_dt date, btch_id decimal(19,0), crtd_by string, crtd_dt timestamp_ntz, mdfd_by string, "
        "mdfd_dt timestamp_ntz")


def _hstate(spark, rows):
    from decimal import Decimal

    full = [(sk, "S", pid, v, None, flag, date(2024, 1, 1), date(9999, 12, 31), Decimal(1), "seed", None, None, None)
            for sk, pid, v, flag in rows]
    return spark.createDataFrame(full, HDDL)


def test_supersede_keeps_only_newest_active_and_breaks_ties_by_key(spark):
    st = _hstate(spark, [(1, 100, "x", "Y"), (2, 100, "y", "Y"), (3, 200, "z", "Y"), (4, 300, "q", "N")])
    out = {r.sk: r for r in supersede(st, HSPEC, CTX, "t").collect()}
    assert out[1].actv_indctr == "N" and out[1].eff_to_dt == date(2025, 2, 28)
    assert out[2].actv_indctr == "Y" and out[3].actv_indctr == "Y" and out[4].actv_indctr == "N"
    assert [r.sk for r in superseded(st, HSPEC, CTX, "t").collect()] == [1]


def test_full_file_inactivation_and_return(spark):
    st = _hstate(spark, [(1, 100, "x", "Y"), (2, 200, "y", "D"), (3, 300, "z", "Y")])
    batch_keys = spark.createDataFrame([("S", 300), ("S", 200)], "sys string, pid bigint")
    gone = inactivation_rows(st, batch_keys, HSPEC, CTX, "t").collect()
    assert [(r.pid, r.actv_indctr) for r in gone] == [(100, "D")]  # 200 already 'D' is left alone


def test_inactivated_key_returns_unchanged(spark):
    st = with_hash(_hstate(spark, [(1, 100, "x", "Y"), (2, 200, "y", "D")]), HSPEC)
    batch = spark.createDataFrame([("S", 100, "x"), ("S", 200, "y")], "sys string, pid bigint, v string")
    back = changed_or_new(identify(batch, in_force(st, HSPEC), HSPEC), HSPEC)
    assert [r.pid for r in back.collect()] == [200]
    new = open_versions(back.select(F.lit(3).cast("bigint").alias("sk"), "sys", "pid", "v", "hash_key"), HSPEC, CTX, "t")
    after = supersede(st.unionByName(new.select(*st.columns)), HSPEC, CTX, "t")
    assert {r.sk: r.actv_indctr for r in after.collect()} == {1: "Y", 2: "N", 3: "Y"}


def test_full_file_leaves_other_sources_alone(spark):
    st = _hstate(spark, [(1, 100, "x", "Y"), (2, 200, "y", "Y")])
    other = st.withColumn("sys", F.lit("OTHER"))
    no_keys = spark.createDataFrame([], "sys string, pid bigint")
    gone = inactivation_rows(st.unionByName(other), no_keys, HSPEC, CTX, "t", scope=F.col("sys") == "S").collect()
    assert sorted((r.sys, r.pid) for r in gone) == [("S", 100), ("S", 200)]


def test_hash_rollback_reopens_and_removes(spark):
    st = _hstate(spark, [(1, 100, "x", "Y"), (2, 200, "y", "Y")])
    new = open_versions(spark.createDataFrame([(3, "S", 100, "x2", None)], "sk bigint, sys string, pid bigint, v string, hash_key string"),
                        HSPEC, CTX, "t").select(*st.columns)
    after = supersede(st.unionByName(new), HSPEC, CTX, "t")
    assert after.where("actv_indctr = 'Y'").count() == 2
    back = rollback(after, HSPEC, CTX)
    assert sorted(back.collect()) == sorted(st.collect())
