"""Declarative dataset loads: a spec of steps chained into one plan.

A ``DatasetSpec`` names the source per file type, optional source filter,
lookup tables, intermediate steps, the lookup (enrichment) step and the
final projection; the load type picks the change logic:

* 0 insert-only: rows whose natural key is not in the target;
* 1 upsert in place: 'I' / 'U' by row hash, next state of the target;
* 2 versioned: by hash (changed or new rows as open versions, older active
  versions of the touched keys closed; a ``full`` file also inactivates the
  keys it lacks) or by columns (``scd2_apply``).

Rows failing a ``reject_rules`` check are set aside (``frames['rejected_rows']``)
and counted as rejected, like rows with a NULL natural key.

A step is either a function ``(frames, ctx) -> DataFrame`` or Spark SQL.  SQL
refers to earlier frames as ``{name}`` (passed to ``spark.sql`` as DataFrame
arguments, so no global temp views are created) and to run values as bound
parameters ``:batch_id``, ``:batch_date``, ``:batch_ts``, ``:job``,
``:source_system`` -- never by string formatting.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.context import RunContext
from dimforge.operators import quality
from dimforge.operators.audit import audit_row, weighed_counts
from dimforge.operators.joins import batch_is_small, with_match
from dimforge.operators.lookup import broadcast_if_small
from dimforge.operators.keys import count_and_high_water, dedup_natural_key, surrogate_keys
from dimforge.operators.scd import UNCHANGED, Scd2Spec, scd2_apply
from dimforge.operators.scd_hash import (HashScd2Spec, changed_or_new, identify, in_force, inactivation_rows,
                                         open_versions, supersede)
from dimforge.operators.upsert import type1_join, type1_next_state, type1_route
from dimforge.session import reliable_checkpoint

StepFn = Callable[[Mapping[str, DataFrame], RunContext], DataFrame]
FILE_TYPES = ("event", "time", "maint", "full")


@dataclass(frozen=True)
class Step:
    name: str
    sql: str | None = None
    fn: StepFn | None = None
    filters: str | None = None  # frame whose rows this step may drop on purpose; other losses unbalance the audit

    def run(self, spark: SparkSession, frames: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
        if self.fn is not None:
            return self.fn(frames, ctx)
        params = {"batch_id": ctx.batch_id, "batch_date": ctx.batch_date, "batch_ts": ctx.batch_ts,
                  "job": ctx.job, "source_system": ctx.source_system}
        wanted = set(re.findall(r"\{([A-Za-z_][A-Za-z0-9_]*)\}", self.sql))
        unknown = sorted(wanted - set(frames))
        if unknown:
            raise ValueError(f"step {self.name!r} refers to frames not built yet: {unknown}")
        used = {k: frames[k] for k in wanted}
        named = {k: v for k, v in params.items() if f":{k}" in self.sql}
        return spark.sql(self.sql, args=named, **used)


@dataclass(frozen=True)
class CodeCheck:
    """Codes of ``column`` must exist in a master table.  Missing codes give
    per-code rows and an alert row; under ``exclude`` the rows carrying them
    are not loaded (counted as rejected), under ``default_id`` they load."""

    column: str
    master: Callable[[SparkSession], DataFrame]
    master_column: str
    policy: str = "default_id"


@dataclass
class DatasetSpec:
    name: str
    target_table: str
    load_type: int
    natural_key: tuple[str, ...]
    surrogate_key: str | None
    sources: dict[str, Callable[[SparkSession], DataFrame]]  # file type -> reader
    lookup: Step  # produces the enriched rows ('lkp')
    select_fields: Step | None = None  # final projection over 'sink'
    source_filter: Step | None = None  # produces 'src' from 'src_file'
    lookups: dict[str, Callable[[SparkSession], DataFrame]] = field(default_factory=dict)
    temp_steps: Sequence[Step] = ()
    tracked: tuple[str, ...] = ()  # type 1: columns compared by hash
    hash_spec: HashScd2Spec | None = None  # type 2 by hash
    scd2_columns: Scd2Spec | None = None  # type 2 by columns (instead of hash_spec)
    carry: Callable | None = None  # type 2: carry-forward column rules
    file_scope: Callable[[RunContext], Column] | None = None  # type 2 by hash: target rows a full file speaks for
    reject_rules: Sequence[quality.Rule] = ()  # rows of 'src' failing any rule are rejected
    code_checks: Sequence[CodeCheck] = ()  # run on the staged file, before the source filter
    error_key: str | None = None  # staged column identifying a row in error-log entries
    entity: str = "load"
    duplicates: str = "keep_first"  # or 'halt'
    dedup_order: Sequence | None = None


def validate(spec: DatasetSpec) -> list[str]:
    """Problems that would fail mid-run, reported before any Spark work."""
    errors = []
    if spec.load_type not in (0, 1, 2):
        errors.append(f"load_type must be 0, 1 or 2, got {spec.load_type!r}")
    if not spec.natural_key:
        errors.append("natural_key is required")
    if not spec.sources:
        errors.append("at least one source is required")
    for ft in spec.sources:
        if ft not in FILE_TYPES:
            errors.append(f"unknown file type {ft!r}")
    if spec.load_type == 1 and not spec.tracked:
        errors.append("type 1 needs tracked columns")
    if spec.load_type == 2 and (spec.hash_spec is None) == (spec.scd2_columns is None):
        errors.append("type 2 needs exactly one of hash_spec or scd2_columns")
    if spec.load_type == 2 and not spec.surrogate_key:
        errors.append("type 2 needs a surrogate_key")
    for c in spec.code_checks:
        if c.policy not in ("default_id", "exclude"):
            errors.append(f"unknown code-check policy {c.policy!r}")
    if spec.duplicates not in ("keep_first", "halt"):
        errors.append(f"unknown duplicates policy {spec.duplicates!r}")
    for k, step in enumerate(spec.temp_steps):
        if step.filters and step.filters not in ("src", "src_file", *[t.name for t in spec.temp_steps[:k]], *spec.lookups):
            errors.append(f"step {step.name!r} filters a frame that is not built before it: {step.filters!r}")
    for s in (spec.lookup, spec.select_fields, spec.source_filter, *spec.temp_steps):
        if s is not None and (s.sql is None) == (s.fn is None):
            errors.append(f"step {s.name!r} needs exactly one of sql or fn")
    return errors


@dataclass
class LoadResult:
    rows: DataFrame  # rows to append (types 0, 2) or the next state (type 1)
    audit: DataFrame  # one audit row
    frames: dict[str, DataFrame]
    errors: DataFrame | None = None  # error-log rows (needs ``error_key``)
    stopped: str | None = None  # why nothing was loaded: an empty or a fully filtered file


def run(spark: SparkSession, spec: DatasetSpec, ctx: RunContext, target: DataFrame,
        file_type: str = "time") -> LoadResult:
    """Build the load's plan.  Actions: one probe of the staging frame (its
    size bounds every batch-sized join), a checkpoint of the looked-up rows (every later
    step and count reads it), the dedup guard (policy ``halt``),
    the checked lookup probes and, for type 2, the checkpoint and numbering.

    A file without rows, or of which the filter and the rejects leave none, stops the load before
    anything is inactivated: no rows, the target as it was, ``stopped`` and an audit row.

    The audit counts every outcome by itself (rows rejected, dropped by a step that says so, repeated, found
    unchanged, loaded), none as what is left of the others, so ``balanced`` is false when a step loses
    or multiplies rows.
    """
    errors = validate(spec)
    if errors:
        raise ValueError("; ".join(errors))
    if file_type not in spec.sources:
        raise ValueError(f"dataset {spec.name!r} has no {file_type!r} source")
    frames: dict[str, DataFrame] = {"src_file": spec.sources[file_type](spark), "curr": target}
    staged = frames["src_file"]
    code_rejects = staged.limit(0)
    errors: list[DataFrame] = []
    for chk in spec.code_checks:
        # one pass: each row tagged known / missing by a left join with the master's codes
        codes, _ = broadcast_if_small(chk.master(spark).select(F.col(chk.master_column).alias(chk.column))
                                      .distinct().withColumn("_known", F.lit(True)))
        marked = frames["src_file"].join(codes, chk.column, "left")
        missing = F.col("_known").isNull() & F.col(chk.column).isNotNull()  # NULL codes are not missing
        per_code = marked.where(missing).groupBy(chk.column).agg(F.count(F.lit(1)).alias("n_rows"))
        frames[f"missing_{chk.column}"] = per_code
        frames[f"alert_{chk.column}"] = quality.missing_code_alert(per_code, chk.column)
        if spec.error_key:
            code = quality.EC_UNEXPECTED_CODE if chk.policy == "exclude" else quality.EC_NEW_CODE
            errors.append(quality.error_log_rows(marked.where(missing), ctx, code, spec.name, spec.target_table,
                                                 spec.error_key, [chk.column]))
        if chk.policy == "exclude":
            code_rejects = code_rejects.unionByName(marked.where(missing).drop("_known"))
            frames["src_file"] = marked.where(~missing).drop("_known")
    frames["src"] = spec.source_filter.run(spark, frames, ctx) if spec.source_filter else frames["src_file"]
    filtered_in = frames["src"]
    rule_rejects = filtered_in.limit(0)
    if spec.reject_rules:
        failed = None
        for r in spec.reject_rules:
            failed = r.failed if failed is None else (failed | r.failed)
        failed = F.coalesce(failed, F.lit(False))
        rule_rejects = filtered_in.where(failed)
        frames["src"] = filtered_in.where(~failed)
        if spec.error_key and spec.error_key in filtered_in.columns:
            failures = quality.rule_violations(rule_rejects, spec.error_key, spec.reject_rules)
            errors.append(quality.error_log_rows(failures, ctx, quality.EC_RULE_FAILED, spec.name,
                                                 spec.target_table, spec.error_key, ["dq_reason_cd"]))
    frames["rejected_rows"] = rule_rejects
    for name, reader in spec.lookups.items():
        frames[name] = reader(spark)
    for step in spec.temp_steps:
        frames[step.name] = step.run(spark, frames, ctx)
    keys = list(spec.natural_key)
    unchanged = None
    lkp = reliable_checkpoint(spec.lookup.run(spark, frames, ctx))
    frames["looked_up"] = lkp
    # one bounded probe of the staging frame bounds every batch-sized frame below
    small = batch_is_small(frames["src_file"].select(F.lit(1).alias("_one")), ["_one"])
    lkp, null_keys = quality.split_null_keys(lkp, keys)  # NULL keys are rejects, not duplicates
    if spec.duplicates == "halt":
        quality.guard_no_duplicates(lkp, keys)
    frames["null_keys"] = null_keys
    if spec.error_key and spec.error_key in lkp.columns:
        # a row whose natural key no lookup found
        errors.append(quality.error_log_rows(null_keys, ctx, quality.EC_NO_MASTER, spec.name, spec.target_table,
                                             spec.error_key, [*keys, *[c for c in (spec.error_key,) if c not in keys]]))
    keyed = lkp
    lkp = dedup_natural_key(lkp, keys, spec.dedup_order)
    frames["lkp"] = lkp

    stopped = None
    if keyed.isEmpty():
        stopped = "empty file" if staged.isEmpty() else "no row of the file is left to load"
        rows = target if spec.load_type == 1 else target.limit(0)
        loaded = unchanged = keyed
        frames["next_state"] = target
    elif spec.load_type == 0:
        known = reliable_checkpoint(with_match(target.select(*keys), lkp, keys, small).distinct())  # keys of the batch
        sink = lkp.join(known, keys, "left_anti")
        unchanged = lkp.join(known, keys, "left_semi")
        frames["sink"] = sink
        rows = spec.select_fields.run(spark, frames, ctx) if spec.select_fields else sink
        loaded = rows
    elif spec.load_type == 1:
        joined = type1_join(lkp, target, keys, list(spec.tracked), small=small)
        frames["routed"] = type1_route(joined, lkp.columns)
        unchanged = joined.where(F.col("insert_update_flg") == "N")
        rows = type1_next_state(joined, target.columns, keys, list(spec.tracked), ctx, f"{ctx.job}-{spec.entity}")
        loaded = frames["routed"]
    elif spec.scd2_columns is not None:
        result = scd2_apply(target, lkp, spec.scd2_columns, ctx, duplicates="keep" if spec.duplicates != "halt"
                            else "halt")
        rows = result.inserts
        unchanged = result.joined.where(F.col("row_type") == UNCHANGED)
        frames["next_state"] = result.next_state()
        frames["expired"] = result.expired
        loaded = rows
    else:
        hs = spec.hash_spec
        ident = reliable_checkpoint(identify(lkp, in_force(target, hs), hs, carry=spec.carry, small=small))
        frames["sink"] = changed_or_new(ident, hs)
        unchanged = ident.where(F.col(f"tgt_{hs.sk}").isNotNull() & F.col(hs.hash_col).eqNullSafe(F.col(f"tgt_{hs.hash_col}")))
        sel = spec.select_fields.run(spark, frames, ctx) if spec.select_fields else frames["sink"]
        stamped = open_versions(sel, hs, ctx, f"{ctx.job}-{spec.entity}")
        loaded = sel
        if file_type == "full":
            # a full file: active keys missing from it get an inactivation version
            gone = inactivation_rows(target, lkp.select(*keys), hs, ctx, f"{ctx.job}-{spec.entity}",
                                     scope=spec.file_scope(ctx) if spec.file_scope else None)
            frames["inactivated"] = gone
            stamped = stamped.unionByName(gone.select(*stamped.columns))
        stamped = reliable_checkpoint(stamped)
        n, hwm = count_and_high_water(stamped, target, spec.surrogate_key)
        rows = surrogate_keys(stamped, hs.keys[::-1], spec.surrogate_key, start=hwm)
        rows = rows.select(*target.columns)
        frames["next_state"] = supersede(target.unionByName(rows), hs, ctx, f"{ctx.job}-{spec.entity}",
                                         touched=rows, touched_rows=n)

    # code rejects leave before the source filter, rule and NULL-key rejects after it
    minus = F.lit(-1)
    counts = weighed_counts([
        ("source", staged, None), ("rejected", code_rejects, None), ("rejected", rule_rejects, None), ("rejected", null_keys, None),
        ("filtered", frames["src_file"], None), ("filtered", filtered_in, minus),
        *[part for step in spec.temp_steps if step.filters for part in
          (("filtered", frames[step.filters], None), ("filtered", frames[step.name], minus))],
        ("duplicates", keyed.groupBy(*keys).count(), F.col("count") - 1),
        ("unchanged", unchanged, None), ("loaded", loaded, None)],
        ["source", "loaded", "rejected", "filtered", "duplicates", "unchanged"])
    audit = audit_row(counts, ctx, spec.target_table, spec.name, "n_source", loaded=["n_loaded"],
                      filtered=["n_filtered", "n_unchanged", "n_duplicates"], rejected=["n_rejected"])
    error_log = None
    for e in errors:
        error_log = e if error_log is None else error_log.unionByName(e)
    return LoadResult(rows=rows, audit=audit, frames=frames, errors=error_log, stopped=stopped)
