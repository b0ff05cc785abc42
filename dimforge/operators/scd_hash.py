"""Versioned loads compared by row hash, with an active-flag convention.

A version is active when its flag is 'Y' or 'D' (inactivated), closed with
'N'.  Open versions end at 9999-12-31; a closed version ends the day before
the batch date of its successor.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.functions.columns import row_hash

# Fixed values of the flag convention.
ACTIVE = "Y"
CLOSED = "N"
INACTIVE = "D"
OPEN_END = "9999-12-31"


@dataclass(frozen=True)
class HashScd2Spec:
    keys: tuple[str, ...]
    sk: str
    hashed: tuple[str, ...]  # in hash order
    hash_col: str = "hash_key"
    flag: str = "actv_indctr"
    eff_from: str = "eff_from_dt"
    eff_to: str = "eff_to_dt"
    batch_col: str = "btch_id"


def with_hash(df: DataFrame, spec: HashScd2Spec) -> DataFrame:
    return df.withColumn(spec.hash_col, row_hash(list(spec.hashed)))


def active(target: DataFrame, spec: HashScd2Spec) -> DataFrame:
    return target.where(F.col(spec.flag).isin(ACTIVE, INACTIVE))


def in_force(target: DataFrame, spec: HashScd2Spec) -> DataFrame:
    """Versions a batch is compared with: flag 'Y'.  An inactivated ('D') key
    has none, so its return opens a version even with unchanged values."""
    return target.where(F.col(spec.flag) == ACTIVE)


def identify(batch: DataFrame, current: DataFrame, spec: HashScd2Spec,
             carry: Callable[[DataFrame], dict[str, Column]] | None = None, small: bool | None = None
             ) -> DataFrame:
    """Left join the batch to the version of its key in force and hash it.

    Adds ``tgt_<sk>``, ``tgt_<flag>``, ``tgt_<hash>`` and every target column as
    ``tgt_<col>``; ``carry(joined)`` may return column overrides computed from
    both sides (carry-forward rules) before the hash is taken.  A batch proven
    small first restricts the target to its keys (broadcast semi join).
    """
    from dimforge.operators.joins import batch_is_small, with_match

    keys = list(spec.keys)
    if batch_is_small(batch, keys) if small is None else small:
        # only the batch's keys are read from the target: it streams past the
        # broadcast batch keys instead of being shuffled
        current = with_match(current, batch, keys, True)
    t = current.select(*[F.col(k).alias(f"_jk_{k}") for k in keys],
                       *[F.col(c).alias(f"tgt_{c}") for c in current.columns])
    cond = None
    for k in keys:
        c = batch[k] == t[f"_jk_{k}"]
        cond = c if cond is None else (cond & c)
    j = batch.join(t, cond, "left").drop(*[f"_jk_{k}" for k in keys])
    if carry is not None:
        j = j.withColumns(carry(j))
    return with_hash(j, spec)


def changed_or_new(identified: DataFrame, spec: HashScd2Spec) -> DataFrame:
    """No active version, or a hash that differs (NULL-safe: a NULL stored hash
    counts as different)."""
    return identified.where(
        F.col(f"tgt_{spec.sk}").isNull() | ~F.col(spec.hash_col).eqNullSafe(F.col(f"tgt_{spec.hash_col}"))
    )


def open_versions(rows: DataFrame, spec: HashScd2Spec, ctx: RunContext, created_by: str,
                  flag: str = ACTIVE) -> DataFrame:
    """Stamp rows as open versions starting at the batch date."""
    return rows.withColumns({
        spec.eff_from: ctx.date(),
        spec.eff_to: F.lit(OPEN_END).cast("date"),
        spec.flag: F.lit(flag),
        spec.batch_col: ctx.batch_id_col(),
        "crtd_by": F.lit(created_by),
        "crtd_dt": ctx.ts(),
        "mdfd_by": F.lit(None).cast("string"),
        "mdfd_dt": F.lit(None).cast("timestamp_ntz"),
    })


def supersede(state: DataFrame, spec: HashScd2Spec, ctx: RunContext, modified_by: str,
              touched: DataFrame | None = None, max_broadcast_rows: int = 2_000_000,
              touched_rows: int | None = None) -> DataFrame:
    """Close every active version of a key except the newest.

    Newest = largest (eff_from, sk).  Computed as a per-key max (partial
    aggregation, so a hot key costs one row per map task) joined back on the
    key; the join's hot side is split by AQE's skew handling.  Closed rows end
    at batch date - 1 with flag 'N'.  Returns the whole state.

    ``touched``: the keys this batch wrote.  Only their versions are looked
    at, so a load costs work in proportion to the batch, not to the table;
    when the touched keys are proven few (bounded probe) they are broadcast
    and the table streams through without a shuffle (``touched_rows``, a
    count the caller already has, replaces the probe).  Without ``touched``
    every key is examined (a repair pass over the whole table).
    """
    from dimforge.operators.lookup import broadcast_if_small

    keys = list(spec.keys)
    order = F.struct(F.col(spec.eff_from), F.col(spec.sk))
    act = active(state, spec)
    small = False
    if touched is not None:
        tk = touched.select(*keys).distinct()
        if touched_rows is None:  # prove the bound with a probe
            tk, small = broadcast_if_small(tk, max_broadcast_rows)
        elif touched_rows <= max_broadcast_rows:  # caller counted the touched rows
            tk, small = F.broadcast(tk), True
        act = act.join(tk, keys, "left_semi")
    newest = (act.groupBy(*keys).agg(F.max(order).alias("_newest"))
              .select(*[F.col(k).alias(f"_nk_{k}") for k in keys], "_newest"))
    if small:
        newest = F.broadcast(newest)  # at most one row per touched key
    cond = None
    for k in keys:
        c = state[k].eqNullSafe(newest[f"_nk_{k}"])
        cond = c if cond is None else (cond & c)
    j = state.join(newest, cond, "left")
    old = F.col(spec.flag).isin(ACTIVE, INACTIVE) & F.col("_newest").isNotNull() & (order < F.col("_newest"))
    out = j.withColumns({
        spec.eff_to: F.when(old, ctx.date_minus_day()).otherwise(F.col(spec.eff_to)),
        spec.flag: F.when(old, F.lit(CLOSED)).otherwise(F.col(spec.flag)),
        "mdfd_by": F.when(old, F.lit(modified_by)).otherwise(F.col("mdfd_by")),
        "mdfd_dt": F.when(old, ctx.ts()).otherwise(F.col("mdfd_dt")),
    })
    return out.select(*state.columns)


def superseded(state: DataFrame, spec: HashScd2Spec, ctx: RunContext, modified_by: str,
               touched: DataFrame | None = None, touched_rows: int | None = None) -> DataFrame:
    """Only the versions ``supersede`` closes in this batch."""
    after = supersede(state, spec, ctx, modified_by, touched, touched_rows=touched_rows)
    return after.where((F.col(spec.flag) == CLOSED) & F.col(spec.eff_to).eqNullSafe(ctx.date_minus_day())
                       & F.col("mdfd_dt").eqNullSafe(ctx.ts()))


def inactivation_rows(current: DataFrame, batch_keys: DataFrame, spec: HashScd2Spec, ctx: RunContext,
                      created_by: str, scope: Column | None = None) -> DataFrame:
    """Full file: active keys missing from the batch get an inactivation
    version (same attributes, flag 'D', from the batch date).  Keys already
    'D' are left alone, and so are rows outside ``scope``, the part of the
    table the file speaks for (such as its source system)."""
    keys = list(spec.keys)
    mine = in_force(current, spec) if scope is None else in_force(current, spec).where(scope)
    gone = mine.join(batch_keys.select(*keys).distinct(), keys, "left_anti")
    return open_versions(gone, spec, ctx, created_by, flag=INACTIVE)


def rollback(state: DataFrame, spec: HashScd2Spec, ctx: RunContext) -> DataFrame:
    """Undo one batch: drop the versions it wrote (batch id), reopen the
    versions it closed (end = batch date - 1, modified at batch time)."""
    kept = state.where(~F.col(spec.batch_col).eqNullSafe(ctx.batch_id_col()))
    closed_by = ((F.col(spec.flag) == CLOSED) & F.col(spec.eff_to).eqNullSafe(ctx.date_minus_day())
                 & F.col("mdfd_dt").eqNullSafe(ctx.ts()))
    return kept.withColumns({
        spec.eff_to: F.when(closed_by, F.lit(OPEN_END).cast("date")).otherwise(F.col(spec.eff_to)),
        spec.flag: F.when(closed_by, F.lit(ACTIVE)).otherwise(F.col(spec.flag)),
        "mdfd_by": F.when(closed_by, F.lit(None).cast("string")).otherwise(F.col("mdfd_by")),
        "mdfd_dt": F.when(closed_by, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("mdfd_dt")),
    })


def delete_batch(state: DataFrame, batch_col: str, ctx: RunContext) -> DataFrame:
    """State without the rows of this batch (rows with a NULL batch id stay)."""
    return state.where(~F.col(batch_col).eqNullSafe(ctx.batch_id_col()))

