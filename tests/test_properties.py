"""Invariants of the versioned load over random states and batches.

(a) at most one open version per key, (b) a key's versions do not overlap,
(c) applying the same batch twice equals applying it once, (d) new
surrogate keys are unique and above the old maximum, (e) the stage counts
add up to the batch, (f) rolling the batch back gives the former state.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.operators.scd import Scd2Spec, rollback_columns_version, scd2_apply

SPEC = Scd2Spec(key="id", sk="sk", columns=("name",), tracked=("name",))
CTX = RunContext(batch_id=3, batch_ts="2025-05-05 05:05:05", batch_date="2025-05-05", job="p", run_id="r")
DDL = ("sk bigint, id string, name string, effective_start_date timestamp_ntz, effective_end_date timestamp_ntz, "
       "is_current boolean, dw_insert_timestamp timestamp_ntz, dw_update_timestamp timestamp_ntz")
T0 = dt.datetime(2024, 1, 1)

keys = st.sampled_from([f"k{i}" for i in range(12)])
names = st.sampled_from([None, "", "x", "X", "y"])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(current=st.dictionaries(keys, names, max_size=10), batch=st.dictionaries(keys, names, max_size=10))
def test_versioned_load_invariants(spark, current, batch):
    rows = [(i + 1, k, v, T0, None, True, T0, T0) for i, (k, v) in enumerate(sorted(current.items()))]
    state = spark.createDataFrame(rows, DDL)
    inc = spark.createDataFrame(sorted(batch.items()), "id string, name string")
    old_max = len(rows)

    result = scd2_apply(state, inc, SPEC, CTX)
    nxt = result.next_state().checkpoint(eager=True)
    got = nxt.collect()

    open_per_key = {}
    for r in got:
        if r.is_current:
            open_per_key[r.id] = open_per_key.get(r.id, 0) + 1
    assert all(v == 1 for v in open_per_key.values())  # (a)
    assert set(open_per_key) == set(current) | set(batch)
    for k in set(current) | set(batch):  # (b)
        spans = sorted((r.effective_start_date, r.effective_end_date or dt.datetime.max) for r in got if r.id == k)
        for (s1, e1), (s2, _) in zip(spans, spans[1:]):
            assert e1 < s2
    new_sks = [r.sk for r in got if r.sk > old_max]  # (d)
    assert len(new_sks) == len(set(new_sks))
    assert all(r.sk <= old_max for r in got if r.effective_start_date == T0)

    counts = {r.row_type: r.n for r in result.joined.groupBy("row_type").agg(F.count("*").alias("n")).collect()}
    assert sum(v for k, v in counts.items() if k != "ABSENT") == len(batch)  # (e)
    assert counts.get("NEW", 0) + counts.get("CHANGED", 0) == len(new_sks)

    twice = scd2_apply(nxt, inc, SPEC, CTX).next_state()  # (c)
    assert sorted(twice.collect()) == sorted(got)

    back = rollback_columns_version(nxt, SPEC, CTX).drop("dw_update_timestamp")  # (f)
    assert sorted(back.collect()) == sorted(state.drop("dw_update_timestamp").collect())
