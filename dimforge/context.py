"""Per-run values handed to every operator that stamps rows.

The batch id, batch time and batch date are inputs, never ``current_timestamp``:
a rerun of the same batch must produce the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    batch_id: int
    batch_ts: str  # 'YYYY-MM-DD HH:MM:SS[.ffffff]', wall time of the load (UTC by convention)
    batch_date: str  # 'YYYY-MM-DD'
    job: str = "ods_load"
    source_system: str = "CORE"
    run_id: str = "run-0"

    def ts(self) -> Column:
        """Batch time as ``timestamp_ntz`` (independent of the session time zone)."""
        return F.lit(self.batch_ts).cast("timestamp_ntz")

    def ts_minus_ms(self) -> Column:
        """End of a version closed by this batch: batch time minus one millisecond."""
        return (self.ts() - F.expr("INTERVAL 1 MILLISECOND")).cast("timestamp_ntz")

    def date(self) -> Column:
        return F.lit(self.batch_date).cast("date")

    def date_minus_day(self) -> Column:
        return F.date_sub(self.date(), 1)

    def batch_id_col(self) -> Column:
        return F.lit(str(self.batch_id)).cast("decimal(19,0)")

    @property
    def batch_yyyymmdd(self) -> str:
        return self.batch_date.replace("-", "")


# The run used by the registered queries, the tests and the bench.
DEFAULT_CONTEXT = RunContext(
    batch_id=20250101,
    batch_ts="2025-01-01 06:00:00",
    batch_date="2025-01-01",
    job="ods_load",
    source_system="CORE",
    run_id="run-20250101",
)
