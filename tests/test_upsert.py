"""Type 1, held updates and reversals on hand-made rows."""

from decimal import Decimal

from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.operators.upsert import (held_update_split, hold_updates, insert_only, reversal_rows,
                                       type1_join, type1_next_state, type1_route)

CTX = RunContext(batch_id=9, batch_ts="2025-03-01 10:00:00", batch_date="2025-03-01", job="t", run_id="r")


def test_type1_flags_and_next_state(spark):
    tgt = spark.createDataFrame([("a", "x", None, None), ("b", "y", None, None), ("c", "z", None, None)],
                                "k string, v string, mdfd_by string, mdfd_dt timestamp_ntz")
    batch = spark.createDataFrame([("a", "X"), ("b", "new"), ("d", "w")], "k string, v string")
    j = type1_join(batch, tgt, "k", ["v"])
    routed = {r.k: r.insert_update_flg for r in type1_route(j, batch.columns).collect()}
    assert routed == {"b": "U", "d": "I"}  # 'X' vs 'x' is no change in hash mode
    nxt = {r.k: r for r in type1_next_state(j, tgt.columns, "k", ["v"], CTX, "t-x").collect()}
    assert set(nxt) == {"a", "b", "c", "d"}
    assert nxt["b"].v == "new" and nxt["b"].mdfd_by == "t-x"
    assert nxt["a"].v == "x" and nxt["a"].mdfd_by is None
    assert nxt["d"].v == "w"


def test_held_updates_matched_lone_and_null_code(spark):
    cur = spark.createDataFrame([("a", Decimal("1.00"), "O", None)], "k string, amount decimal(18,2), code string, mdfd_by string")
    rows = spark.createDataFrame([("a", Decimal("5.00"), "U", None), ("b", Decimal("2.00"), "U", None),
                                  ("c", Decimal("3.00"), None, None)],
                                 "k string, amount decimal(18,2), code string, mdfd_by string")
    first, held = hold_updates(rows, "code")
    assert [r.k for r in first.collect()] == ["c"]
    updated, lone = held_update_split(held, cur, "k", ["amount"], CTX, "t-asset", code="code")
    u = updated.collect()
    assert len(u) == 1 and u[0].amount == Decimal("5.00") and u[0].mdfd_by == "t-asset" and u[0].code == "O"
    assert [(r.k, r.code) for r in lone.collect()] == [("b", "O")]


def test_reversals(spark):
    ddl = "trade_id bigint, k string, amount decimal(18,2), code string, link bigint, btch_id decimal(19,0)"
    tgt = spark.createDataFrame([
        (1, "a", Decimal("10.00"), "O", None, Decimal(8)),
        (2, "a", Decimal("-10.00"), "R", 1, Decimal(8)),   # a reversal is never reversed again
        (3, "b", Decimal("4.00"), "O", None, Decimal(8)),
        (4, "b", Decimal("6.00"), "O", None, Decimal(9)),  # written by this batch: not a candidate
    ], ddl)
    batch = spark.createDataFrame([("a", "C"), ("b", "U"), ("b", "U"), ("zz", "C")], "k string, code string")
    out = {r.k: r for r in reversal_rows(tgt, batch, "k", CTX, code="code", amount="amount", id_col="trade_id",
                                         link_col="link", batch_col="btch_id").collect()}
    assert set(out) == {"a", "b"}  # unknown 'zz' has nothing to reverse; two updates give one reversal
    assert out["a"].link == 1 and out["a"].amount == Decimal("-10.00") and out["a"].code == "R"
    assert out["b"].link == 3 and out["b"].trade_id is None and out["b"].btch_id == Decimal(9)


def test_insert_only_skips_existing_keys(spark):
    b = spark.createDataFrame([("s", "1"), ("s", "2")], "sys string, n string")
    c = spark.createDataFrame([("s", "1", 7)], "sys string, n string, id int")
    assert [r.n for r in insert_only(b, c, ["sys", "n"]).collect()] == ["2"]


def test_broadcast_and_shuffle_paths_agree(spark):
    tgt = spark.createDataFrame([(f"k{i}", f"v{i % 7}", None, None) for i in range(300)],
                                "k string, v string, mdfd_by string, mdfd_dt timestamp_ntz")
    batch = spark.createDataFrame([(f"k{i}", f"v{i % 5}") for i in range(250, 400)], "k string, v string")
    a = sorted(insert_only(batch, tgt, "k", small=True).collect())
    b = sorted(insert_only(batch, tgt, "k", small=False).collect())
    assert a == b and len(a) == 100
    ja = type1_join(batch, tgt, "k", ["v"], small=True)
    jb = type1_join(batch, tgt, "k", ["v"], small=False)
    na = sorted(type1_next_state(ja, tgt.columns, "k", ["v"], CTX, "x").collect())
    nb = sorted(type1_next_state(jb, tgt.columns, "k", ["v"], CTX, "x").collect())
    assert na == nb and len(na) == 400
    plan = insert_only(batch, tgt, "k", small=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
