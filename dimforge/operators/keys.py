"""Keys: surrogate numbering, natural-key dedup, latest row per key.

Surrogate keys
--------------
The result equals ``row_number() OVER (ORDER BY key) + start`` but never pulls the rows into one
partition.  Rows are range-partitioned and sorted on all key parts, each takes its place
in its partition, and that is frozen by a checkpoint.  The number of rows in the partitions before is
a running sum over one count per partition.  Spark chooses the ranges and their number; an
executor loss re-reads the checkpoint, so the numbers stay.  Keys must be unique
(dedup first); rows of equal keys are numbered in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.session import reliable_checkpoint

_AT, _PART, _BEFORE = "_sk_at", "_sk_part", "_sk_before"


def surrogate_keys(df: DataFrame, key: str | Sequence[str], sk: str, start: int = 0) -> DataFrame:
    """``df`` with ``sk`` = ``start`` + global rank by ``key`` (a column or several).

    One shuffle by range and one checkpoint of the rows to number.
    """
    order = [F.col(key)] if isinstance(key, str) else [F.col(k) for k in key]
    # partition number in the upper 31 bits, place in the partition in the lower 33
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_AT, F.monotonically_increasing_id())
    frozen = reliable_checkpoint(placed).withColumn(_PART, F.shiftright(_AT, 33))
    running = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = frozen.groupBy(_PART).agg(F.count(F.lit(1)).alias("n")).select(
        _PART, F.coalesce(F.sum("n").over(running), F.lit(0)).alias(_BEFORE))
    place = F.col(_AT) - F.shiftleft(_PART, 33)
    return (frozen.join(F.broadcast(offsets), _PART)
            .withColumn(sk, (F.lit(start) + F.col(_BEFORE) + place + 1).cast("bigint")).drop(_AT, _PART, _BEFORE))


def surrogate_keys_single_partition(df: DataFrame, key: str, sk: str, start: int = 0) -> DataFrame:
    """The one-window form (all rows in one task).  Kept only as the comparison
    baseline in the bench; do not use it on large inputs."""
    return df.withColumn(sk, F.lit(start).cast("bigint") + F.row_number().over(Window.orderBy(key)).cast("bigint"))


def high_water_frame(target: DataFrame, sk: str) -> DataFrame:
    """One-row frame with the largest surrogate key (0 when empty), for
    combining with other scalars in a single job."""
    return target.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint").alias("hwm"))


def count_and_high_water(rows: DataFrame, target: DataFrame, sk: str) -> tuple[int, int]:
    """(rows to number, target high-water mark) in one job."""
    a = rows.agg(F.count(F.lit(1)).cast("bigint").alias("v")).withColumn("part", F.lit("n"))
    b = high_water_frame(target, sk).select(F.col("hwm").alias("v"), F.lit("hwm").alias("part"))
    got = {r["part"]: int(r["v"]) for r in a.unionByName(b).collect()}
    return got["n"], got["hwm"]


def high_water_mark(target: DataFrame, sk: str) -> int:
    """Largest surrogate key in the target, 0 when empty (one scalar comes back)."""
    row = target.agg(F.coalesce(F.max(sk), F.lit(0)).cast("bigint").alias("m")).collect()[0]
    return int(row["m"])


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key under ``order`` (give descending columns for "latest").

    ``row_number() = 1`` is planned with a partial ``WindowGroupLimit`` before
    the shuffle, so a hot key is cut to one row per map task before it moves.
    Add a unique column at the end of ``order`` to make the pick deterministic.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_natural_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] | None = None) -> DataFrame:
    """One row per natural key.  Without ``order`` the pick is the smallest row
    by all non-key columns (a total order, so the result does not depend on
    partitioning, unlike ``dropDuplicates``)."""
    if order is None:
        # rows that consist of the key alone are all equal: any order will do
        order = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys] or [F.col(c) for c in keys]
    return latest_per_key(df, keys, order)
