"""Scalar column builders used by the load operators.

All of them compile to built-in Catalyst expressions, so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed values of the loaded tables: the "unknown, overwrite me" date and the
# field separator placed between hashed columns.
UNKNOWN_DATE = "1900-01-01"
HASH_SEPARATOR = "~"


def col_of(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnLike, data_type: str) -> Column:
    """Cast external text without failing the job: bad input gives NULL.

    Plain ``cast`` throws under ANSI mode (the 4.x default); ``try_cast`` is the
    NULL-on-failure form both the rejection split and the oracle rely on.
    """
    return col_of(c).try_cast(data_type)


def safe_date(c: ColumnLike, fmt: str = "yyyyMMdd") -> Column:
    """Parse a date string; '' and malformed strings give NULL."""
    return F.try_to_date(col_of(c), fmt)


def blank_to_null(c: ColumnLike) -> Column:
    """'' becomes NULL, everything else passes through."""
    return F.nullif(col_of(c), F.lit(""))


def derived_status(close_date: ColumnLike, batch_date: Column, fmt: str = "yyyyMMdd") -> Column:
    """'T' when the close date is on or before the batch date, else 'A'.

    A NULL, empty or unparsable close date gives 'A'.
    """
    closed = safe_date(close_date, fmt) <= batch_date
    return F.when(closed, F.lit("T")).otherwise(F.lit("A"))


def when_codes(code: ColumnLike, codes: Sequence[str], value: Column) -> Column:
    """``value`` for rows whose code is in ``codes``, NULL otherwise."""
    return F.when(col_of(code).isin(list(codes)), value)


def changed_any(pairs: Iterable[tuple[ColumnLike, ColumnLike]]) -> Column:
    """True when any (new, old) pair differs, NULL-safe (NULL to value is a change)."""
    cond = None
    for new, old in pairs:
        diff = ~col_of(new).eqNullSafe(col_of(old))
        cond = diff if cond is None else (cond | diff)
    if cond is None:
        return F.lit(False)
    return cond


def row_hash(columns: Sequence[ColumnLike], separator: str = HASH_SEPARATOR) -> Column:
    """md5 of the upper-cased columns joined with a separator between them.

    ``concat_ws`` skips NULLs, so NULL and '' hash alike, and upper-casing makes
    the comparison case-blind; the separators keep positions apart.  Values are
    rendered with Spark's string cast: dates as yyyy-MM-dd, decimals in plain
    notation.  Doubles should be cast to decimal by the caller (their text form
    differs between engines).
    """
    parts: list[Column] = []
    for i, c in enumerate(columns):
        if i:
            parts.append(F.lit(separator))
        parts.append(col_of(c).cast("string"))
    return F.md5(F.upper(F.concat_ws("", *parts)))


def first_seen(tgt_key: ColumnLike, tgt_value: ColumnLike, new_value: ColumnLike,
               unknown: str = UNKNOWN_DATE) -> Column:
    """Keep the target's value once set; the new value when no target row or the
    target holds the 'unknown' date."""
    tv = col_of(tgt_value)
    take_new = col_of(tgt_key).isNull() | tv.eqNullSafe(F.lit(unknown).cast("date"))
    return F.when(take_new, col_of(new_value)).otherwise(tv)


def first_known(tgt_key: ColumnLike, tgt_value: ColumnLike, new_value: ColumnLike,
                fallback: ColumnLike, unknown: str = UNKNOWN_DATE) -> Column:
    """Like ``first_seen`` but a present new value always wins.

    No target row (or 'unknown' target date): ``coalesce(new, fallback)``;
    otherwise ``coalesce(new, target)``.
    """
    tv = col_of(tgt_value)
    take_new = col_of(tgt_key).isNull() | tv.eqNullSafe(F.lit(unknown).cast("date"))
    return F.when(take_new, F.coalesce(col_of(new_value), col_of(fallback))).otherwise(
        F.coalesce(col_of(new_value), tv)
    )


def sticky(tgt_key: ColumnLike, tgt_value: ColumnLike, new_value: ColumnLike) -> Column:
    """New value if not NULL, else the value the current version holds."""
    return F.when(col_of(tgt_key).isNull(), col_of(new_value)).otherwise(
        F.coalesce(col_of(new_value), col_of(tgt_value))
    )
