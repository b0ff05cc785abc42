"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run once to warm up, then three times; the median wall time of
"build the frame + evaluate it fully" (a ``noop`` write, so nothing is
collected to the driver) is reported.  A second group times the reference's
algorithm shapes against ours on the same input (comparison forms).
Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "scd2_next_state",
    "surrogate_keys_orders",
    "insert_only_load",
    "lookup_enrich_lineitem",
    "latest_per_key",
    "scd2_hash_next_state",
    "type1_upsert",
    "dq_violations",
    "reversal_load",
    "held_update_next_state",
    "audit_summary",
    "typed_scan",
]


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int = 3) -> float:
    fn()
    runs = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def comparisons(spark, sf_dir: str) -> dict[str, float]:
    """Reference shapes vs ours on identical prepared inputs; only the step
    that differs is timed."""
    from pyspark.sql import functions as F

    from dimforge.operators.keys import dedup_natural_key, surrogate_keys, surrogate_keys_single_partition
    from dimforge.operators.scd import current_rows, scd2_join
    from dimforge.operators.upsert import insert_only
    from dimforge.plans import account, fixtures as fx, trade

    out: dict[str, float] = {}
    li = fx.table(spark, sf_dir, "lineitem").select(
        F.format_string("L%012d-%02d", F.col("l_orderkey"), F.col("l_linenumber")).alias("nk"))
    out["numbering_single_partition_window"] = timed(lambda: _run(surrogate_keys_single_partition(li, "nk", "sk")))
    out["numbering_by_range"] = timed(lambda: _run(surrogate_keys(li, "nk", "sk")))

    rows = dedup_natural_key(trade.master_rows(fx.stg_trade(spark, sf_dir)), list(trade.MASTER_KEY))
    cur = fx.ods_plcy_mastr(spark, sf_dir)

    def left_join_is_null():
        j = rows.alias("l").join(cur.alias("t"), (F.col("l.src_sys") == F.col("t.src_sys"))
                                 & (F.col("l.plcy_num") == F.col("t.plcy_num")), "left")
        _run(j.where(F.col("t.plcy_mastr_id").isNull()).select("l.*"))

    out["insert_only_left_join_is_null"] = timed(left_join_is_null)
    out["insert_only_left_anti"] = timed(lambda: _run(insert_only(rows, cur, list(trade.MASTER_KEY), small=False)))
    out["insert_only_broadcast_batch"] = timed(
        lambda: _run(insert_only(rows, cur, list(trade.MASTER_KEY), small=True)))

    batch = account.prepare_batch(fx.stg_account(spark, sf_dir)).incoming
    joined = scd2_join(batch, current_rows(fx.ods_account(spark, sf_dir), account.ACCOUNT_SPEC), account.ACCOUNT_SPEC)

    def one_action_per_count():
        for t in ("NEW", "CHANGED", "UNCHANGED"):
            joined.where(F.col("row_type") == t).count()

    out["counts_one_action_each"] = timed(one_action_per_count)
    out["counts_one_aggregation"] = timed(lambda: joined.groupBy("row_type").count().collect())
    return out


def main() -> None:
    from dimforge.plans.queries import QUERIES
    from dimforge.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, app="dimforge-bench")
    per_query = {}
    for name in HEADLINE:
        per_query[name] = timed(lambda n=name: _run(QUERIES[n](spark, sf_dir)))
    comp = comparisons(spark, sf_dir) if os.environ.get("BENCH_COMPARE", "1") == "1" else {}
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(per_query.values()), 3),
        "unit": "sec",
        "queries": per_query,
        "comparisons": comp,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
