"""Versioned (SCD Type 2) loads.

By columns (``Scd2Spec``): each incoming row is NEW (no current version),
CHANGED (a tracked column differs, NULL-safe) or UNCHANGED.  NEW and CHANGED
rows become current versions with fresh surrogate keys; the current version of
a CHANGED key is closed at batch time minus 1 ms.  Keys absent from the batch
stay current.

Plan shape: **one** full outer join of the current partition with the batch
on the natural key.  Every output (classification, closed versions, kept
current rows, inserts, counts) is a projection of that joined frame, so the
current partition is shuffled once, not once per merge step.

By hash (``HashScd2Spec``): rows whose hash differs from the current version's
(or that have none) are appended as open versions [batch date, 9999-12-31];
then every active version of a key except the newest is closed at batch
date - 1 with flag 'N' (``supersede``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.functions.columns import changed_any
from dimforge.operators.keys import surrogate_keys
from dimforge.session import reliable_checkpoint

NEW, CHANGED, UNCHANGED, ABSENT = "NEW", "CHANGED", "UNCHANGED", "ABSENT"


@dataclass(frozen=True)
class Scd2Spec:
    key: str
    sk: str
    columns: tuple[str, ...]  # business columns carried by a version, in order (key excluded)
    tracked: tuple[str, ...]  # columns whose change opens a new version
    start: str = "effective_start_date"
    end: str = "effective_end_date"
    current: str = "is_current"
    inserted_at: str = "dw_insert_timestamp"
    updated_at: str = "dw_update_timestamp"

    def target_columns(self) -> list[str]:
        return [self.sk, self.key, *self.columns, self.start, self.end, self.current,
                self.inserted_at, self.updated_at]


def current_rows(target: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Open versions.  On a target written ``partitionBy(current)`` the filter
    prunes to one partition."""
    return target.where(F.col(spec.current))


def history_rows(target: DataFrame, spec: Scd2Spec) -> DataFrame:
    return target.where(~F.col(spec.current))


def _tgt(c: str) -> str:
    return f"_tgt_{c}"


def scd2_join(incoming: DataFrame, current: DataFrame, spec: Scd2Spec, broadcast_batch: bool = False) -> DataFrame:
    """Full outer join of the batch with the current versions, with ``row_type``.

    Incoming columns keep their names; every target column is prefixed
    ``_tgt_``.  ``row_type`` is NEW / CHANGED / UNCHANGED for batch rows and
    ABSENT for current keys missing from the batch.

    Two plans give the same rows:

    * default: a full outer join; both sides are shuffled on the key.
    * ``broadcast_batch`` (only for a batch whose size was proven small): the
      current versions stream past the broadcast batch (left join, no shuffle
      of the current partition); the keys found are few, so the batch rows
      without a current version come from an anti join of two small frames.
    """
    cur = current.select(
        F.col(spec.key).alias("_k"),
        *[F.col(c).alias(_tgt(c)) for c in spec.target_columns()],
    )
    inc = incoming.select(spec.key, *spec.columns).withColumn("_in", F.lit(True))
    if broadcast_batch:
        b = F.broadcast(inc)
        kept = cur.join(b, cur["_k"] == b[spec.key], "left")
        found = cur.select("_k").join(F.broadcast(inc.select(F.col(spec.key).alias("_bk"))),
                                      F.col("_k") == F.col("_bk"), "left_semi")
        new = inc.join(found, inc[spec.key] == found["_k"], "left_anti")
        j = kept.unionByName(new, allowMissingColumns=True)
    else:
        j = inc.join(cur, inc[spec.key] == cur["_k"], "full_outer")
    changed = changed_any((F.col(c), F.col(_tgt(c))) for c in spec.tracked)
    row_type = (
        F.when(F.col("_in").isNull(), F.lit(ABSENT))
        .when(F.col(_tgt(spec.sk)).isNull(), F.lit(NEW))
        .when(changed, F.lit(CHANGED))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.withColumn("row_type", row_type).drop("_k", "_in")


def classify(incoming: DataFrame, current: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Batch rows with ``row_type`` and the matched target surrogate key."""
    j = scd2_join(incoming, current, spec)
    return j.where(F.col("row_type") != ABSENT).select(
        spec.key, *spec.columns, F.col(_tgt(spec.sk)).alias("tgt_sk"), "row_type"
    )


def class_counts(joined: DataFrame) -> DataFrame:
    """NEW / CHANGED / UNCHANGED / ABSENT counts in one aggregation (one job)."""
    return joined.groupBy("row_type").agg(F.count(F.lit(1)).alias("n_rows"))


def insert_candidates(joined: DataFrame, spec: Scd2Spec) -> DataFrame:
    return joined.where(F.col("row_type").isin(NEW, CHANGED)).select(spec.key, *spec.columns)


def stamp_inserts(numbered: DataFrame, spec: Scd2Spec, ctx: RunContext) -> DataFrame:
    """Open versions for numbered insert rows: start = batch time, end NULL."""
    return numbered.select(
        F.col(spec.sk).cast("bigint").alias(spec.sk),
        spec.key,
        *spec.columns,
        ctx.ts().alias(spec.start),
        F.lit(None).cast("timestamp_ntz").alias(spec.end),
        F.lit(True).alias(spec.current),
        ctx.ts().alias(spec.inserted_at),
        ctx.ts().alias(spec.updated_at),
    )


def current_after(joined: DataFrame, spec: Scd2Spec, ctx: RunContext) -> DataFrame:
    """Every prior current version after the batch: CHANGED ones closed at batch
    time - 1 ms (insert time kept, update time refreshed), the rest untouched."""
    is_closed = F.col("row_type") == CHANGED
    cols = []
    for c in spec.target_columns():
        src = F.col(_tgt(c))
        if c == spec.end:
            src = F.when(is_closed, ctx.ts_minus_ms()).otherwise(src)
        elif c == spec.current:
            src = F.when(is_closed, F.lit(False)).otherwise(src)
        elif c == spec.updated_at:
            src = F.when(is_closed, ctx.ts()).otherwise(src)
        cols.append(src.alias(c))
    return joined.where(F.col(_tgt(spec.sk)).isNotNull()).select(*cols)


def expired(joined: DataFrame, spec: Scd2Spec, ctx: RunContext) -> DataFrame:
    """Only the versions this batch closes."""
    return current_after(joined, spec, ctx).where(~F.col(spec.current))


@dataclass
class Scd2Result:
    joined: DataFrame  # checkpointed full outer join with row_type
    inserts: DataFrame  # new open versions with surrogate keys
    prior_current: DataFrame  # former current versions, closed where CHANGED
    history: DataFrame  # untouched closed versions of the target
    high_water: int
    notes: dict = field(default_factory=dict)

    @property
    def expired(self) -> DataFrame:
        return self.prior_current.where(~F.col(self.notes["current"]))

    def next_current(self) -> DataFrame:
        """Partition ``current = true`` after the load."""
        return self.prior_current.where(F.col(self.notes["current"])).unionByName(self.inserts)

    def next_state(self) -> DataFrame:
        """The whole table after the load."""
        return self.history.unionByName(self.prior_current).unionByName(self.inserts)


def load_stats(joined: DataFrame, target: DataFrame, spec: Scd2Spec) -> dict[str, int]:
    """Every scalar the load needs, in one job: rows to insert, batch keys
    seen more than once, and the target's surrogate-key high-water mark."""
    from dimforge.operators.keys import high_water_frame

    per_key = (joined.where(F.col("row_type") != ABSENT).groupBy(spec.key)
               .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("row_type").isin(NEW, CHANGED)).alias("ins")))
    batch = per_key.agg(F.coalesce(F.sum("ins"), F.lit(0)).cast("bigint").alias("v1"),
                        F.count_if(F.col("n") > 1).cast("bigint").alias("v2")).withColumn("part", F.lit("batch"))
    tgt = high_water_frame(target, spec.sk).select(F.col("hwm").alias("v1"), F.lit(0).cast("bigint").alias("v2"),
                                                   F.lit("target").alias("part"))
    got = {r["part"]: r for r in batch.unionByName(tgt).collect()}
    return {"inserts": int(got["batch"]["v1"]), "duplicate_keys": int(got["batch"]["v2"]),
            "high_water": int(got["target"]["v1"])}


def scd2_apply(target: DataFrame, incoming: DataFrame, spec: Scd2Spec, ctx: RunContext,
               checkpoint: bool = True,
               before_numbering=None, max_broadcast_batch_rows: int = 200_000,
               duplicates: str = "halt", high_water: int | None = None) -> Scd2Result:
    """Compute the next state of a versioned table for one batch.

    Runs bounded actions: a probe of the batch size (at most
    ``max_broadcast_batch_rows`` rows broadcast the batch, see ``scd2_join``),
    a reliable checkpoint of the joined frame (cuts lineage; survives executor
    loss, written to ``spark.checkpoint.dir``), one job for all scalars
    (``load_stats``) and the checkpoint of the numbered rows.
    ``duplicates="halt"`` raises ``DuplicateKeyError`` on a repeated batch key.  Returns lazy
    frames over the checkpoint.  ``incoming`` must be unique on ``spec.key``;
    ``before_numbering(joined)`` runs guards on the checkpointed join (cheaper
    than re-reading the batch lineage).  ``high_water`` is the table's largest
    surrogate key where the caller knows it; otherwise it is read from ``target``.
    """
    from dimforge.operators.lookup import broadcast_if_small

    cur = current_rows(target, spec)
    _, small = broadcast_if_small(incoming.select(spec.key), max_broadcast_batch_rows)
    joined = scd2_join(incoming, cur, spec, broadcast_batch=small)
    if checkpoint:
        joined = reliable_checkpoint(joined)
    stats = load_stats(joined, target if high_water is None else target.limit(0), spec)
    if duplicates not in ("halt", "keep"):
        raise ValueError(f"unknown duplicates policy {duplicates!r}")
    if stats["duplicate_keys"] and duplicates == "halt":
        from dimforge.operators.quality import guard_no_duplicates

        guard_no_duplicates(joined.where(F.col("row_type") != ABSENT), spec.key)
    if before_numbering is not None:
        before_numbering(joined)
    hwm = stats["high_water"] if high_water is None else high_water
    cands = insert_candidates(joined, spec)
    inserts = stamp_inserts(surrogate_keys(cands, spec.key, spec.sk, start=hwm), spec, ctx)
    return Scd2Result(
        joined=joined,
        inserts=inserts,
        prior_current=current_after(joined, spec, ctx),
        history=history_rows(target, spec),
        high_water=hwm,
        notes={"current": spec.current, "inserts": stats["inserts"]},
    )


def already_loaded(target: DataFrame, spec: Scd2Spec, ctx: RunContext) -> bool:
    """Idempotency guard: the target already holds current versions started at
    this batch time (one-row probe)."""
    hit = target.where(F.col(spec.current) & (F.col(spec.start) == ctx.ts())).limit(1)
    return not hit.isEmpty()


def single_active_violations(state: DataFrame, key: str | Sequence[str], current: Column) -> DataFrame:
    """Keys with more than one open version (must be empty before publishing)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        state.where(current)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_current"))
        .where(F.col("n_current") > 1)
    )


def rollback_columns_version(state: DataFrame, spec: Scd2Spec, ctx: RunContext) -> DataFrame:
    """Undo one batch of a by-columns versioned load.

    Rows the batch inserted (start = batch time) are removed; versions it
    closed (end = batch time - 1 ms) are reopened.
    """
    kept = state.where(~F.col(spec.start).eqNullSafe(ctx.ts()))
    closed_by_batch = F.col(spec.end).eqNullSafe(ctx.ts_minus_ms()) & ~F.col(spec.current)
    return kept.select(*[
        (F.when(closed_by_batch, F.lit(None).cast("timestamp_ntz")).otherwise(F.col(c)).alias(c) if c == spec.end
         else F.when(closed_by_batch, F.lit(True)).otherwise(F.col(c)).alias(c) if c == spec.current
         else F.col(c))
        for c in state.columns
    ])


def load_into(table, incoming: DataFrame, spec: Scd2Spec, ctx: RunContext):
    """Load one batch into a ``VersionedTable``: only the buckets that hold its keys are read and rewritten.

    A rerun writes nothing, a late batch raises; returns the commit in force.
    """
    if not table.accepts(ctx.batch_id):
        return table.head()
    head = table.head()
    incoming = reliable_checkpoint(incoming)  # read twice: for its buckets, then for the load
    touched = table.touched_buckets(incoming)
    before = table.read_open(head, touched)
    result = scd2_apply(before, incoming, spec, ctx, high_water=head.high_water if head else 0)
    after = result.prior_current.unionByName(result.inserts)
    return table.commit(table.stage(ctx.batch_id, touched, after, result.high_water + result.notes["inserts"], before))


def rollback_by_images(state: DataFrame, inserted: DataFrame, before: DataFrame, sk: str) -> DataFrame:
    """Undo one batch on a frame: its new versions go, the versions it changed are put back as they were.

    ``inserted(sk)`` are the versions the batch wrote and ``before`` the former rows of those it
    changed, kept by the load; stamps and flags come back exactly, inactivated versions included.
    Both hold one row per row of the batch at most.
    """
    gone = inserted.select(sk).union(before.select(sk))
    return state.join(gone, sk, "left_anti").unionByName(before.select(*state.columns)).select(*state.columns)
