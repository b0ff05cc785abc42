"""Projection and schema operators: mapping, defaults, alignment, audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimforge.context import RunContext
from dimforge.functions.columns import blank_to_null as _blank


def rename(df: DataFrame, mapping: Sequence[tuple[str, str]]) -> DataFrame:
    """Project and rename: ``[(source, target), ...]`` in output order."""
    return df.select(*[F.col(s).alias(t) for s, t in mapping])


def with_defaults(df: DataFrame, defaults: Sequence[tuple[str, object, str]]) -> DataFrame:
    """Add constant columns ``(name, value, type)``; ``value`` None gives a typed
    NULL (an untyped NULL column cannot be written by most sinks)."""
    return df.withColumns({name: F.lit(value).cast(dtype) for name, value, dtype in defaults})


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: _blank(c) for c in columns})


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def align_to_schema(df: DataFrame, schema: StructType, strict_extra: bool = False) -> DataFrame:
    """Match a frame to a target schema by case-insensitive name.

    Present columns are cast with ``try_cast`` (bad values become NULL, never
    an error mid-write), missing ones are added as typed NULLs, extras are
    dropped (or rejected with ``strict_extra``).  Pairing is by name, so one
    missing column never shifts the others.
    """
    by_upper = {c.upper(): c for c in df.columns}
    wanted = {f.name.upper() for f in schema.fields}
    if strict_extra:
        extra = sorted(set(by_upper) - wanted)
        if extra:
            raise ValueError(f"columns not in target schema: {extra}")
    cols: list[Column] = []
    for f in schema.fields:
        src = by_upper.get(f.name.upper())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            cols.append(F.col(src).alias(f.name))
        else:
            cols.append(F.col(src).try_cast(f.dataType).alias(f.name))
    return df.select(*cols)


def audit_insert_columns(df: DataFrame, ctx: RunContext, created_by: str,
                         names: Mapping[str, str] | None = None) -> DataFrame:
    """Batch id (decimal(19,0)), created date/by, NULL modified date/by."""
    n = {"btch_id": "btch_id", "crtd_dt": "crtd_dt", "crtd_by": "crtd_by", "mdfd_dt": "mdfd_dt",
         "mdfd_by": "mdfd_by"}
    if names:
        n.update(names)
    return df.withColumns({
        n["btch_id"]: ctx.batch_id_col(),
        n["crtd_dt"]: ctx.date(),
        n["crtd_by"]: F.lit(created_by),
        n["mdfd_dt"]: F.lit(None).cast("date"),
        n["mdfd_by"]: F.lit(None).cast("string"),
    })


def utc_normalise(df: DataFrame, columns: Sequence[str], source_tz: str) -> DataFrame:
    """Wall-clock timestamps recorded in ``source_tz`` to UTC wall clock
    (``timestamp_ntz`` in and out, independent of the session time zone)."""
    return df.withColumns({
        c: F.convert_timezone(F.lit(source_tz), F.lit("UTC"), F.col(c).cast("timestamp_ntz")) for c in columns
    })
