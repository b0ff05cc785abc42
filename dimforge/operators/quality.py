"""Data-quality splits, checks, rejection and error-log rows, alerts.

Every split is two filters over the same input, so callers that use both
halves should persist (or checkpoint) the input once.  Counting functions
return one small DataFrame instead of running one action per count.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.context import RunContext

# Rejection reason codes and error-log codes (no master row
# for the account, code missing from its master, unexpected code, failed rule).
NULL_NATURAL_KEY = "NULL_NATURAL_KEY"
INVALID_REVENUE_CAST = "INVALID_REVENUE_CAST"
EC_NO_MASTER = "EC_25"
EC_NEW_CODE = "EC_26"
EC_UNEXPECTED_CODE = "EC_27"
EC_RULE_FAILED = "EC_28"


class DuplicateKeyError(ValueError):
    """A batch holds the same natural key more than once (policy ``halt``)."""

    def __init__(self, keys: list, message: str):
        super().__init__(message)
        self.keys = keys


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def null_key_condition(key: str | Sequence[str]) -> Column:
    cond = None
    for k in _keys(key):
        c = F.col(k).isNull()
        cond = c if cond is None else (cond | c)
    return cond


def split_null_keys(df: DataFrame, key: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): a row is rejected when any part of its key is NULL."""
    bad = null_key_condition(key)
    return df.where(~bad), df.where(bad)


def bad_cast_condition(raw: str, data_type: str) -> Column:
    return F.col(raw).isNotNull() & F.col(raw).try_cast(data_type).isNull()


def split_bad_cast(df: DataFrame, raw: str, data_type: str, out: str) -> tuple[DataFrame, DataFrame]:
    """(valid with ``out`` = cast value, rejected): rejected when the source is
    not NULL but the cast gives NULL."""
    bad = bad_cast_condition(raw, data_type)
    return df.where(~bad).withColumn(out, F.col(raw).try_cast(data_type)), df.where(bad)


def payload_json(columns: Sequence[str], ts_format: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """JSON object of the given columns; NULL fields are kept as ``null`` and
    timestamps are rendered with an explicit format."""
    fields = []
    for c in columns:
        fields.append(F.col(c).alias(c))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false", "timestampNTZFormat": ts_format,
                                         "timestampFormat": ts_format})


def rejection_rows(df: DataFrame, ctx: RunContext, source_table: str, key: str, reason: str,
                   payload_columns: Sequence[str]) -> DataFrame:
    """Dead-letter rows: run id, source table, row id, reason, time, JSON payload."""
    return df.select(
        F.lit(ctx.run_id).alias("batch_run_id"),
        F.lit(source_table).alias("source_table"),
        F.col(key).cast("string").alias("source_row_identifier"),
        F.lit(reason).alias("rejection_reason_code"),
        ctx.ts().alias("rejection_timestamp"),
        payload_json(payload_columns).alias("raw_source_payload"),
    )


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts (partial + final
    hash aggregate, so a hot key costs one row per map task in the shuffle)."""
    return df.groupBy(*_keys(key)).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def guard_no_duplicates(df: DataFrame, key: str | Sequence[str], sample: int = 20) -> None:
    """Guard: raise ``DuplicateKeyError`` naming up to ``sample`` keys (sorted)."""
    keys = _keys(key)
    dups = duplicate_keys(df, keys)
    found = dups.orderBy(*keys).limit(sample).collect()
    if found:
        listed = [tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]] for r in found]
        raise DuplicateKeyError(listed, f"duplicate natural keys in batch (up to {sample}): {listed}")


def missing_codes(batch: DataFrame, code: str, master: DataFrame, master_code: str) -> DataFrame:
    """Codes present in the batch but not in the master, with row counts.

    Anti join first (the master side is the small one), then a hash aggregate
    on the code: one output row per missing code, never a list in one row.
    """
    from dimforge.operators.lookup import broadcast_if_small

    codes, _ = broadcast_if_small(master.select(F.col(master_code).alias(code)).distinct())
    missing = batch.join(codes, code, "left_anti")
    return missing.where(F.col(code).isNotNull()).groupBy(code).agg(F.count(F.lit(1)).alias("n_rows"))


def missing_code_alert(per_code: DataFrame, code: str) -> DataFrame:
    """One alert row: number of rows and number of codes.

    The codes themselves are the rows of ``missing_codes``, all of them.
    """
    return per_code.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"), F.count(F.lit(1)).alias("n_codes"))


@dataclass(frozen=True)
class Rule:
    """A named check; ``failed`` is true for rows that break it."""

    code: str
    failed: Column


def rule_violations(df: DataFrame, key: str | Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """One row per (row, failed rule): key columns plus ``dq_reason_cd``.

    All rules are evaluated in one pass: an array of the failing codes per row,
    exploded (rows passing every rule produce nothing).
    """
    codes = F.array_compact(F.array(*[F.when(r.failed, F.lit(r.code)) for r in rules]))
    return df.select(*_keys(key), F.explode(codes).alias("dq_reason_cd"))


def reason_summary(violations: DataFrame) -> DataFrame:
    return violations.groupBy("dq_reason_cd").agg(F.count(F.lit(1)).alias("n_rows"))


def exclude_keys(df: DataFrame, bad: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows whose key is not among the failing keys (anti join on distinct keys)."""
    from dimforge.operators.lookup import broadcast_if_small

    keys = _keys(key)
    bad_keys, _ = broadcast_if_small(bad.select(*keys).distinct())
    return df.join(bad_keys, keys, "left_anti")


def error_log_rows(df: DataFrame, ctx: RunContext, error_code: str, file_name: str, target_table: str,
                   key: str, payload_columns: Sequence[str]) -> DataFrame:
    """Error-log rows: code, source system, file, batch id/date, job, target,
    failing key and a JSON payload of the offending row."""
    return df.select(
        F.lit(error_code).alias("err_cd"),
        F.lit(ctx.source_system).alias("src_sys"),
        F.lit(file_name).alias("file_nm"),
        ctx.batch_id_col().alias("btch_id"),
        ctx.date().alias("btch_dt"),
        F.lit(ctx.job).alias("job_nm"),
        F.lit(target_table).alias("tgt_tbl_nm"),
        F.col(key).cast("string").alias("err_key"),
        payload_json(payload_columns).alias("err_payload"),
    )
