"""The bucketed table with its commit chain: touched buckets, reruns, dead runs, late batches, rollbacks."""

import os

import pytest
from pyspark.sql import functions as F

from dimforge.operators.scd import Scd2Spec, load_into, rollback_by_images
from dimforge.context import RunContext
from dimforge.sources.versioned import CommitError, LateBatchError, VersionedTable

SPEC = Scd2Spec(key="k", sk="sk", columns=("v",), tracked=("v",))
DDL = ("sk long, k string, v string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, is_current boolean, "
       "dw_insert_timestamp timestamp_ntz, dw_update_timestamp timestamp_ntz")


def ctx(n):
    return RunContext(batch_id=n, batch_ts=f"2025-01-{n:02d} 06:00:00", batch_date=f"2025-01-{n:02d}")


@pytest.fixture
def make(spark, tmp_path):
    def table(buckets=8, name="t"):
        return VersionedTable(spark, f"{tmp_path}/{name}", spark.createDataFrame([], DDL).schema, ["k"], "sk", "is_current", buckets)

    return table


def batch(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def size_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_loads_equal_the_plain_next_state(spark, make):
    from dimforge.operators.scd import scd2_apply

    table = make()
    state = spark.createDataFrame([], DDL)
    for n, pairs in enumerate([[("a", "1"), ("b", "1"), ("c", None)], [("a", "2"), ("b", "1"), ("d", "1")], [("c", "3"), ("a", "3")]], 1):
        load_into(table, batch(spark, pairs), SPEC, ctx(n))
        state = scd2_apply(state, batch(spark, pairs), SPEC, ctx(n)).next_state()
        assert rows(table.read()) == rows(state.select(*table.schema.names))
    assert table.head().batches == (1, 2, 3)


def test_bytes_written_follow_the_batch(spark, make):
    table = make(buckets=64)
    load_into(table, batch(spark, [(f"k{i}", "x" * 20 + str(i)) for i in range(20_000)]), SPEC, ctx(1))
    whole = size_of(f"{table.root}/data/{table.head().open['0']}")
    head = load_into(table, batch(spark, [("k7", "new")]), SPEC, ctx(2))
    mine = {f for f in head.open.values() if f.startswith("2-")}
    assert len(mine) == 1 and sum(f.startswith("2-") for f in head.open.values()) == 1
    assert size_of(f"{table.root}/data/{mine.pop()}") < whole / 20


def test_rerun_dead_run_and_late_batch(spark, make):
    table = make()
    load_into(table, batch(spark, [("a", "1"), ("b", "1")]), SPEC, ctx(1))
    # batch 2 dies before its commit, batch 3 closes the same key
    touched = table.touched_buckets(batch(spark, [("a", "2")]))
    dead = table.read_open(table.head(), touched).withColumn("is_current", F.lit(False))
    table.stage(2, touched, dead, 99, table.read_open(table.head(), touched))
    third = load_into(table, batch(spark, [("a", "3")]), SPEC, ctx(3))
    after = rows(table.read())
    assert [(r[1], r[2], r[5]) for r in after] == [("a", "1", False), ("b", "1", True), ("a", "3", True)]
    assert load_into(table, batch(spark, [("a", "4")]), SPEC, ctx(3)) == third
    with pytest.raises(LateBatchError):
        load_into(table, batch(spark, [("a", "late")]), SPEC, ctx(2))
    assert rows(table.read()) == after and table.head() == third


def test_rollback_restores_the_former_state(spark, make):
    table = make()
    load_into(table, batch(spark, [("a", "1"), ("b", "1")]), SPEC, ctx(1))
    before = rows(table.read())
    load_into(table, batch(spark, [("a", "2"), ("c", "2")]), SPEC, ctx(2))
    with pytest.raises(CommitError):
        table.rollback(1)
    table.rollback(2)
    assert rows(table.read()) == before
    with pytest.raises(CommitError):
        table.rollback(2)  # taken back already
    load_into(table, batch(spark, [("a", "5")]), SPEC, ctx(2))  # the batch may come again
    assert {(r[1], r[2]) for r in rows(table.read()) if r[5]} == {("a", "5"), ("b", "1")}
    sks = [r[0] for r in rows(table.read())]
    assert len(set(sks)) == len(sks)


def test_a_taken_commit_number_is_an_error(spark, make):
    table = make()
    load_into(table, batch(spark, [("a", "1")]), SPEC, ctx(1))
    head = table.head()
    touched = table.touched_buckets(batch(spark, [("a", "1")]))
    staged = table.stage(2, touched, table.read_open(head, touched), 1)
    table.commit(staged)
    with pytest.raises(CommitError):
        table._append(table.head())
    assert table.head().number == head.number + 1


def test_empty_batch_and_null_flags(spark, make):
    table = make()
    assert rows(table.read()) == []
    load_into(table, batch(spark, []), SPEC, ctx(1))
    assert rows(table.read()) == [] and table.head().batches == (1,)
    with pytest.raises(CommitError):
        table.create(2, spark.createDataFrame([], DDL))
    other = make(name="u")
    unknown = [(1, "a", "v", None, None, None, None, None), (2, "b", "v", None, None, True, None, None)]
    other.create(1, spark.createDataFrame(unknown, DDL))
    assert len(rows(other.read())) == 2  # a NULL flag is not open, and not lost


def test_before_images_bring_back_inactivated_rows(spark):
    ddl = "sk long, k string, flag string, mdfd_by string"
    former = [(1, "a", "D", "x"), (2, "b", "Y", None), (3, "c", "N", "old")]
    state = [(1, "a", "N", "load"), (2, "b", "Y", None), (3, "c", "N", "old"), (4, "a", "Y", None)]
    got = rollback_by_images(spark.createDataFrame(state, ddl), spark.createDataFrame([(4,)], "sk long"),
                             spark.createDataFrame(former[:1], ddl), "sk")
    assert rows(got) == sorted(former, key=str)
