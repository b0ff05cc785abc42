"""Hand-made edge rows per operator (null combinations, casts, dates, keys)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.functions.columns import changed_any, derived_status, row_hash, safe_cast, safe_date
from dimforge.operators import quality
from dimforge.operators.keys import dedup_natural_key, latest_per_key

CTX = RunContext(batch_id=7, batch_ts="2025-03-01 10:00:00", batch_date="2025-03-01", job="t", run_id="r")
VALUES = [None, "", "a", "A", "b"]


def test_change_matrix_column_mode_is_null_safe_and_case_sensitive(spark):
    rows = [(o, n) for o in VALUES for n in VALUES]
    df = spark.createDataFrame(rows, "old string, new string")
    got = {(r.old, r.new): r.changed for r in df.select("old", "new", changed_any([("new", "old")]).alias("changed")).collect()}
    for o in VALUES:
        for n in VALUES:
            assert got[(o, n)] == (o != n), (o, n)


def test_change_matrix_hash_mode_null_equals_blank_and_ignores_case(spark):
    rows = [(o, n) for o in VALUES for n in VALUES]
    df = spark.createDataFrame(rows, "old string, new string")
    out = df.select("old", "new", (row_hash(["new"]) != row_hash(["old"])).alias("changed")).collect()

    def canon(v):
        return "" if v is None else v.upper()

    for r in out:
        assert r.changed == (canon(r.old) != canon(r.new)), (r.old, r.new)


def test_hash_keeps_positions(spark):
    df = spark.createDataFrame([("ab", None), (None, "ab")], "x string, y string")
    h = [r[0] for r in df.select(row_hash(["x", "y"])).collect()]
    assert h[0] != h[1]


def test_decimal_cast_edges(spark):
    raw = ["1.005", "-1.005", "1e3", " 7 ", "", "n/a", "99999999999999999.99", None]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = [r[0] for r in df.select(safe_cast("s", "decimal(18,2)")).collect()]
    assert got[0] == Decimal("1.01")
    assert got[1] == Decimal("-1.01")
    assert got[2] == Decimal("1000.00")
    assert got[3] == Decimal("7.00")
    assert got[4] is None and got[5] is None
    assert got[6] is None  # overflow
    assert got[7] is None


def test_bad_cast_split_keeps_nulls_and_rejects_garbage(spark):
    df = spark.createDataFrame([("k1", "1.5"), ("k2", None), ("k3", "x")], "k string, raw string")
    ok, bad = quality.split_bad_cast(df, "raw", "decimal(18,2)", "amt")
    assert sorted(r.k for r in ok.collect()) == ["k1", "k2"]
    assert [r.k for r in bad.collect()] == ["k3"]


def test_date_edges(spark):
    raw = ["", "2025130", "20250229", "20250101", None]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = [r[0] for r in df.select(safe_date("s")).collect()]
    assert got[0] is None
    assert got[2] is None
    assert got[3] == dt.date(2025, 1, 1)
    assert got[4] is None


def test_derived_status(spark):
    df = spark.createDataFrame([("20250228",), ("20250301",), ("20250302",), ("",), (None,), ("bad",)], "c string")
    got = [r[0] for r in df.select(derived_status("c", CTX.date())).collect()]
    assert got == ["T", "T", "A", "A", "A", "A"]


def test_null_key_split_on_composite_key(spark):
    df = spark.createDataFrame([("a", "1"), (None, "2"), ("c", None), ("d", "4")], "s string, n string")
    ok, bad = quality.split_null_keys(df, ["s", "n"])
    assert ok.count() == 2 and bad.count() == 2


def test_duplicate_guard_raises_with_sorted_sample(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), ("c",)], "k string")
    with pytest.raises(quality.DuplicateKeyError) as e:
        quality.guard_no_duplicates(df, "k")
    assert e.value.keys == ["a", "b"]
    quality.guard_no_duplicates(df.dropDuplicates(), "k")


def test_dedup_is_deterministic_across_partitionings(spark):
    rows = [(i % 5, f"v{(i * 7) % 13}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, v string, n int")
    a = sorted(dedup_natural_key(df.repartition(1), ["k"]).collect())
    b = sorted(dedup_natural_key(df.repartition(16, "n"), ["k"]).collect())
    assert a == b
    assert len(a) == 5


def test_latest_per_key_with_tie_break(spark):
    df = spark.createDataFrame([("k", "20250101", "O", 1), ("k", "20250101", "R", 2), ("k", "20240101", "R", 3)],
                               "k string, d string, c string, id int")
    r_first = F.when(F.col("c") == "R", 1).otherwise(2)
    got = latest_per_key(df, ["k"], [F.col("d").desc(), r_first.asc(), F.col("id").desc()]).collect()
    assert [r.id for r in got] == [2]


def test_rule_violations_one_row_per_failed_rule(spark):
    df = spark.createDataFrame([(1, -5, None), (2, 5, "x"), (3, -1, "x")], "id int, amt int, tag string")
    rules = [quality.Rule("NEG", F.col("amt") < 0), quality.Rule("NO_TAG", F.col("tag").isNull())]
    got = sorted((r.id, r.dq_reason_cd) for r in quality.rule_violations(df, "id", rules).collect())
    assert got == [(1, "NEG"), (1, "NO_TAG"), (3, "NEG")]
    kept = quality.exclude_keys(df, quality.rule_violations(df, "id", rules), "id")
    assert [r.id for r in kept.collect()] == [2]


def test_missing_codes_and_alert(spark):
    batch = spark.createDataFrame([("x",), ("x",), ("y",), ("a",), (None,)], "code string")
    master = spark.createDataFrame([("a",)], "code string")
    per = quality.missing_codes(batch, "code", master, "code")
    assert sorted((r.code, r.n_rows) for r in per.collect()) == [("x", 2), ("y", 1)]
    alert = quality.missing_code_alert(per, "code").collect()[0]
    assert (alert.n_rows, alert.n_codes) == (3, 2)


def test_dedup_on_key_columns_only(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert sorted(r.k for r in dedup_natural_key(df, ["k"]).collect()) == ["a", "b"]


def test_payload_json_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(quality.payload_json(["x", "y"])).first()[0] == '{"x":"a","y":null}'


def test_carry_forward_rules(spark):
    from dimforge.functions.columns import first_known, first_seen, sticky

    d = dt.date
    rows = [  # tgt_key, tgt_value, new_value, fallback
        (None, d(2020, 1, 1), d(2024, 5, 5), d(2025, 1, 1)),  # no target row
        (1, d(1900, 1, 1), None, d(2025, 1, 1)),              # target holds the unknown date
        (1, None, None, d(2025, 1, 1)),                       # NULL target value
        (1, d(2020, 1, 1), d(2024, 5, 5), d(2025, 1, 1)),     # both present
        (1, d(2020, 1, 1), None, d(2025, 1, 1)),              # only the target
    ]
    df = spark.createDataFrame(rows, "k int, t date, n date, fb date")
    got = df.select(first_known("k", "t", "n", "fb").alias("fk"), first_seen("k", "t", "fb").alias("fs"),
                    sticky("k", "t", "n").alias("st")).collect()
    assert [r.fk for r in got] == [d(2024, 5, 5), d(2025, 1, 1), None, d(2024, 5, 5), d(2020, 1, 1)]
    assert [r.fs for r in got] == [d(2025, 1, 1), d(2025, 1, 1), None, d(2020, 1, 1), d(2020, 1, 1)]
    assert [r.st for r in got] == [d(2024, 5, 5), d(1900, 1, 1), None, d(2024, 5, 5), d(2020, 1, 1)]


def test_rows_with_a_null_code_are_not_excluded(spark):
    from dimforge.plans.trade import rows_with_known_codes

    stg = spark.createDataFrame([(1, "A"), (2, "Z"), (3, None)], "trade_id int, trx_cd string")
    master = spark.createDataFrame([("A",), ("A",), (None,)], "trx_cd string")
    assert sorted(r.trade_id for r in rows_with_known_codes(stg, master).collect()) == [1, 3]
