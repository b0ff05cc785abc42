"""Joining a batch to a table without shuffling the table.

A load joins a batch (one file, one day) to a table that may be thousands of
times larger.  When a bounded probe proves the batch small, the table
streams past the broadcast batch and is never shuffled:

* ``found_keys``: the batch keys present in the table (table semi-joined to
  the broadcast batch keys; at most one row per batch key);
* ``without_match``: batch rows whose key is absent, an anti join of two
  small frames (batch and found keys);
* ``table_left_join``: every table row with its batch row, if any.

Beyond the bound the callers fall back to ordinary shuffle joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.operators.lookup import broadcast_if_small

DEFAULT_BATCH_ROWS = 200_000


def batch_is_small(batch: DataFrame, keys: Sequence[str], max_rows: int = DEFAULT_BATCH_ROWS) -> bool:
    """Bounded probe: at most ``max_rows`` batch rows."""
    return broadcast_if_small(batch.select(*keys), max_rows)[1]


def found_keys(table: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct batch keys that occur in the table (table streams, batch keys broadcast)."""
    bk = F.broadcast(batch.select(*keys).distinct())
    return table.select(*keys).join(bk, list(keys), "left_semi").distinct()


def without_match(batch: DataFrame, table: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Batch rows whose key is not in the table (``left_anti``)."""
    if small:
        return batch.join(found_keys(table, batch, keys), list(keys), "left_anti")
    return batch.join(table.select(*keys), list(keys), "left_anti")


def with_match(table: DataFrame, batch: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """Table rows whose key is in the batch (``left_semi``)."""
    b = batch.select(*keys).distinct()
    return table.join(F.broadcast(b) if small else b, list(keys), "left_semi")
