"""Audit counts: all stage counts of a load in one aggregation.

Rows of every stage are tagged with their outcome and unioned; one global
aggregate with ``count_if`` per outcome gives the whole audit row in one job
(partial aggregation per task, one row per task in the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.context import RunContext


def tagged(df: DataFrame, outcome) -> DataFrame:
    """Only the outcome column, so the union is narrow."""
    out = F.lit(outcome) if isinstance(outcome, str) else outcome
    return df.select(out.alias("outcome"))


def outcome_counts(tagged_rows: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    return tagged_rows.agg(*[F.count_if(F.col("outcome") == o).cast("bigint").alias(f"n_{o.lower()}")
                             for o in outcomes])


def weighed_counts(parts: Sequence[tuple[str, DataFrame, Column | None]], outcomes: Sequence[str]) -> DataFrame:
    """One row with ``n_<outcome>``: the summed weights (1 where None) of each outcome's frames.

    Every frame gives one partial sum per task and one row, in one job for all.
    """
    one = None
    for outcome, df, weight in parts:
        w = F.lit(1) if weight is None else weight
        n = df.agg(F.coalesce(F.sum(w.cast("bigint")), F.lit(0)).alias("n")).select(F.lit(outcome).alias("outcome"), "n")
        one = n if one is None else one.unionByName(n)
    return one.agg(*[F.coalesce(F.sum(F.when(F.col("outcome") == o, F.col("n"))), F.lit(0)).cast("bigint").alias(f"n_{o}")
                     for o in outcomes])


def audit_row(counts: DataFrame, ctx: RunContext, target_table: str, file_name: str, source: str,
              loaded: Sequence[str], filtered: Sequence[str], rejected: Sequence[str]) -> DataFrame:
    """One audit row: source, loaded, filtered, rejected counts, and whether
    they balance (source = loaded + filtered + rejected)."""
    def total(names):
        expr = F.lit(0).cast("bigint")
        for n in names:
            expr = expr + F.col(n)
        return expr

    return counts.select(
        ctx.batch_id_col().alias("btch_id"),
        F.lit(ctx.job).alias("job_nm"),
        F.lit(ctx.source_system).alias("src_sys"),
        F.col(source).alias("src_cnt"),
        total(loaded).alias("tgt_cnt"),
        total(filtered).alias("fltr_cnt"),
        total(rejected).alias("rej_cnt"),
        (F.col(source) == total(loaded) + total(filtered) + total(rejected)).alias("balanced"),
        ctx.ts().alias("start_ts"),
        F.lit(target_table).alias("tgt_tbl_nm"),
        F.lit(file_name).alias("src_file_nm"),
        *[F.col(c) for c in counts.columns if c != source],
    )


def target_batch_count(target: DataFrame, ctx: RunContext, created_by: str, batch_col: str = "btch_id",
                       created_by_col: str = "crtd_by") -> DataFrame:
    """Rows of this batch written by this job, counted on the table itself
    (the cross-check of the load's own count).  Both filters reach the scan."""
    return target.where((F.col(batch_col) == ctx.batch_id_col()) & (F.col(created_by_col) == F.lit(created_by))) \
        .agg(F.count(F.lit(1)).alias("tgt_cnt"))
