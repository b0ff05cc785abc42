"""Lookup enrichment: left joins to reference tables with defaults.

Each lookup must be unique on its join key (``Lookup.unique_by`` makes it
so), otherwise a join multiplies batch rows.  Broadcast policy per lookup:

* ``checked`` (default): a count (each task sends one row) proves the table has at most ``max_rows`` rows, and only then is it
  broadcast; a bigger table joins by shuffle, where AQE's skew-join split
  protects against a hot batch key.
* ``auto``: no hint; AQE decides from runtime sizes.
* ``always``: for tables bounded by construction (a code list).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.operators.keys import latest_per_key

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Broadcast hint only after proving ``rows <= max_rows`` (a count: one row per task is shuffled)."""
    n = df.count()
    if n <= max_rows:
        return F.broadcast(df), True
    return df, False


@dataclass
class Lookup:
    table: DataFrame
    on: Sequence[tuple[str, str]]  # (batch column, lookup column) pairs
    columns: dict[str, str]  # lookup column -> output name
    defaults: dict[str, object] = field(default_factory=dict)  # output name -> value when unmatched
    null_equals: str | None = None  # compare coalesce(key, this) on both sides
    unique_by: Sequence[Column | str] | None = None  # order to pick one row per key
    broadcast: str = "checked"
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS


def probe_sizes(frames: dict[int, tuple[DataFrame, int]]) -> dict[int, int]:
    """Row counts of several frames in one job (partial counts per task)."""
    if not frames:
        return {}
    parts = [df.select(F.lit(i).alias("_i")) for i, (df, _) in frames.items()]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    found = {r["_i"]: r["n"] for r in union.groupBy("_i").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {i: found.get(i, 0) for i in frames}


def _prepared(lk: Lookup, idx: int, small: bool | None = None) -> tuple[DataFrame, list[tuple[str, str]]]:
    t = lk.table
    rkeys = [r for _, r in lk.on]
    if lk.unique_by is not None:
        t = latest_per_key(t, rkeys, lk.unique_by)
    renamed = {r: f"_lk{idx}_{r}" for r in rkeys}
    sel = [F.col(r).alias(renamed[r]) for r in rkeys]
    sel += [F.col(c).alias(out) for c, out in lk.columns.items() if c not in rkeys or out != c]
    t = t.select(*sel)
    if lk.broadcast == "always":
        t = F.broadcast(t)
    elif lk.broadcast == "checked":
        if small is None:
            t, _ = broadcast_if_small(t, lk.max_rows)
        elif small:
            t = F.broadcast(t)
    elif lk.broadcast != "auto":
        raise ValueError(f"unknown broadcast policy {lk.broadcast!r}")
    return t, [(left, renamed[r]) for left, r in lk.on]


def _lookup_rows(lk: Lookup) -> DataFrame:
    """The lookup's raw rows for the size probe: an upper bound of what is
    joined (dedup only removes rows), and no shuffle is needed to count it."""
    return lk.table.select(F.lit(1).alias("_one"))


def enrich(batch: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Chain of left joins; unmatched rows get each lookup's defaults.

    A later lookup may join on a column an earlier one added.  The sizes of
    all ``checked`` lookups are probed together in one bounded job.
    """
    out = batch
    checked = {i: (_lookup_rows(lk), lk.max_rows) for i, lk in enumerate(lookups) if lk.broadcast == "checked"}
    sizes = probe_sizes(checked)
    for i, lk in enumerate(lookups):
        small = sizes[i] <= lk.max_rows if i in sizes else None
        t, pairs = _prepared(lk, i, small)
        cond = None
        for left, right in pairs:
            if lk.null_equals is not None:
                c = F.coalesce(out[left], F.lit(lk.null_equals)) == F.coalesce(t[right], F.lit(lk.null_equals))
            else:
                c = out[left] == t[right]
            cond = c if cond is None else (cond & c)
        out = out.join(t, cond, "left").drop(*[right for _, right in pairs])
        if lk.defaults:
            out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in lk.defaults.items()})
    return out
