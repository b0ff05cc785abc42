"""Insert-only, update-in-place (type 1), held updates and reversals.

All are next-state computations: they return the rows to append and the
rows as they look after an update; nothing is written here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.functions.columns import row_hash
from dimforge.operators.joins import batch_is_small, with_match, without_match
from dimforge.operators.keys import latest_per_key


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def insert_only(batch: DataFrame, current: DataFrame, key: str | Sequence[str], small: bool | None = None
                ) -> DataFrame:
    """Batch rows whose key is not in the target (``left_anti``).

    Written as left join + ``IS NULL`` the optimizer keeps an outer join plus a
    filter; the anti join emits nothing for matched keys.  NULL key parts never
    match, so reject NULL keys before this step.  A batch proven small
    (``small``, probed when None) is broadcast and the target is not shuffled
    (``joins.without_match``).
    """
    keys = _keys(key)
    if small is None:
        small = batch_is_small(batch, keys)
    return without_match(batch, current, keys, small)


# ------------------------------------------------------------------ type 1


def type1_join(batch: DataFrame, target: DataFrame, key: str | Sequence[str], tracked: Sequence[str],
               small: bool | None = None) -> DataFrame:
    """One full outer join of batch and target with an ``insert_update_flg``:
    'I' key absent from the target, 'U' hash of tracked columns differs,
    'N' unchanged, NULL for target rows the batch does not touch.

    The hash is ``row_hash`` (NULL equals '', case-blind), computed on both sides.
    A batch proven small is broadcast and the target streams (no shuffle of
    the table); otherwise a full outer join shuffles both sides.
    """
    keys = _keys(key)
    b = batch.withColumn("_hash", row_hash(list(tracked))).withColumn("_in", F.lit(True))
    t = target.select(*keys, *[F.col(c).alias(f"_tgt_{c}") for c in target.columns if c not in keys])
    t = t.withColumn("_tgt_hash", row_hash([f"_tgt_{c}" for c in tracked])).withColumn("_tgt_in", F.lit(True))
    if small is None:
        small = batch_is_small(batch, keys)
    if small:
        # the target streams past the broadcast batch; new keys from two small frames
        kept = t.join(F.broadcast(b), keys, "left")
        j = kept.unionByName(without_match(b, target, keys, True), allowMissingColumns=True)
    else:
        j = b.join(t, keys, "full_outer")
    flag = (F.when(F.col("_in").isNull(), F.lit(None).cast("string"))
            .when(F.col("_tgt_in").isNull(), F.lit("I"))
            .when(~F.col("_hash").eqNullSafe(F.col("_tgt_hash")), F.lit("U"))
            .otherwise(F.lit("N")))
    return j.withColumn("insert_update_flg", flag)


def type1_route(joined: DataFrame, batch_columns: Sequence[str]) -> DataFrame:
    """Batch rows flagged 'I' or 'U' (unchanged rows are dropped)."""
    return joined.where(F.col("insert_update_flg").isin("I", "U")).select(*batch_columns, "insert_update_flg")


def type1_next_state(joined: DataFrame, target_columns: Sequence[str], key: str | Sequence[str],
                     updated: Sequence[str], ctx: RunContext, modified_by: str,
                     mdfd_by: str = "mdfd_by", mdfd_dt: str = "mdfd_dt") -> DataFrame:
    """Target after the load: 'U' rows take the batch values of ``updated`` and
    fresh modified-by/at; 'I' rows are appended; other rows are untouched."""
    keys = _keys(key)
    is_u = F.col("insert_update_flg") == "U"
    is_i = F.col("insert_update_flg") == "I"
    cols: list[Column] = []
    for c in target_columns:
        if c in keys:
            cols.append(F.col(c))
        elif c in updated:
            cols.append(F.when(is_u | is_i, F.col(c)).otherwise(F.col(f"_tgt_{c}")).alias(c))
        elif c == mdfd_by:
            cols.append(F.when(is_u, F.lit(modified_by)).when(is_i, F.lit(None).cast("string"))
                        .otherwise(F.col(f"_tgt_{c}")).alias(c))
        elif c == mdfd_dt:
            cols.append(F.when(is_u, ctx.ts()).when(is_i, F.lit(None).cast("timestamp_ntz"))
                        .otherwise(F.col(f"_tgt_{c}")).alias(c))
        else:
            cols.append(F.col(f"_tgt_{c}").alias(c))
    return joined.select(*cols)


# ----------------------------------------------------------- held updates


def hold_updates(batch: DataFrame, code: str, held: str = "U") -> tuple[DataFrame, DataFrame]:
    """(first pass rows, held rows).  NULL codes stay in the first pass."""
    is_held = F.col(code).eqNullSafe(F.lit(held))
    return batch.where(~is_held), batch.where(is_held)


def held_update_split(held: DataFrame, current: DataFrame, key: str | Sequence[str], measures: Sequence[str],
                      ctx: RunContext, modified_by: str, code: str, insert_code: str = "O",
                      small: bool | None = None) -> tuple[DataFrame, DataFrame]:
    """Second pass over held rows against the target after the first pass.

    Returns (updated target rows, rows to insert).  A held row matching a
    current target row replaces its ``measures`` and sets ``mdfd_by``; a held
    row without a match is inserted with action ``insert_code``.
    ``held`` must be unique on the key (dedup first).  ``small``: the caller's
    proof that ``held`` is small (probed when None).
    """
    keys = _keys(key)
    if small is None:
        small = batch_is_small(held, keys)
    h = held.select(*keys, *[F.col(m).alias(f"_new_{m}") for m in measures])
    matched = current.join(F.broadcast(h) if small else h, keys, "inner")
    updated = matched.select(*[
        (F.col(f"_new_{c}").alias(c) if c in measures
         else F.lit(modified_by).alias(c) if c == "mdfd_by"
         else F.col(c))
        for c in current.columns
    ])
    inserts = without_match(held, current, keys, small).withColumn(code, F.lit(insert_code))
    return updated, inserts


def apply_updates(target: DataFrame, updated: DataFrame, key: str | Sequence[str], small: bool | None = None
                  ) -> DataFrame:
    """Target with rows replaced by ``updated`` on the key (one anti join + union).
    The replaced keys are batch-sized: broadcast when proven small, so the
    target streams through."""
    keys = _keys(key)
    upd = updated.select(*keys)
    if small is None:
        small = batch_is_small(upd, keys)
    if small:
        upd = F.broadcast(upd)
    return target.join(upd, keys, "left_anti").unionByName(updated)


# --------------------------------------------------------------- reversals


def reversal_rows(target: DataFrame, batch: DataFrame, key: str | Sequence[str], ctx: RunContext, *,
                  code: str, amount: str, id_col: str, link_col: str, batch_col: str,
                  trigger_codes: Sequence[str] = ("C", "U"), reversal_code: str = "R",
                  small: bool | None = None) -> DataFrame:
    """One reversing row per key the batch cancels or updates.

    For each key with a ``trigger_codes`` row in the batch, the latest target
    row (highest ``id_col``) that is not itself a reversal and was not written
    by this batch is negated: amount * -1, code ``reversal_code``, ``link_col``
    = the reversed row's id, ``id_col`` left NULL (assigned by the sink),
    stamped with this batch.
    """
    keys = _keys(key)
    hit = batch.where(F.col(code).isin(list(trigger_codes))).select(*keys)
    candidates = with_match(target.where(
        ~F.col(code).eqNullSafe(F.lit(reversal_code)) & ~F.col(batch_col).eqNullSafe(ctx.batch_id_col())
    ), hit, keys, batch_is_small(hit, keys) if small is None else small)
    latest = latest_per_key(candidates, keys, [F.col(id_col).desc()])
    return latest.select(*[
        (F.lit(None).cast(target.schema[c].dataType).alias(c) if c == id_col
         else (-F.col(amount)).cast(target.schema[c].dataType).alias(c) if c == amount
         else F.lit(reversal_code).alias(c) if c == code
         else F.col(id_col).cast(target.schema[c].dataType).alias(c) if c == link_col
         else ctx.batch_id_col().alias(c) if c == batch_col
         else F.col(c))
        for c in target.columns
    ])
