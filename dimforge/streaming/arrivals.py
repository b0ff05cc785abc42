"""Staging files arriving in a folder, each loaded as one batch.

A file-source stream (schema given, ``maxFilesPerTrigger``) hands every
micro-batch to ``foreachBatch``, which runs an ordinary batch load.  The
stream's checkpoint records which files were handed over; the run context is
derived from the micro-batch id, so a micro-batch replayed after a failure
gets the same batch id and time, recomputes the same rows and overwrites the
same per-batch folders (``publish_versioned``): the load is idempotent.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dimforge.context import RunContext


def run_on_arrivals(spark: SparkSession, source_path: str, schema: StructType, checkpoint_location: str,
                    handle_batch: Callable[[DataFrame, int], None], fmt: str = "parquet",
                    files_per_batch: int = 1, available_now: bool = True, options: dict | None = None
                    ) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    writer = (reader.load(source_path).writeStream.foreachBatch(handle_batch)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def context_for(base: RunContext, epoch_id: int) -> RunContext:
    """Batch id and time of a micro-batch: deterministic in the epoch id."""
    ts = dt.datetime.fromisoformat(base.batch_ts) + dt.timedelta(seconds=epoch_id)
    return replace(base, batch_id=base.batch_id + epoch_id, batch_ts=ts.isoformat(sep=" "),
                   batch_date=ts.date().isoformat(), run_id=f"{base.run_id}-{epoch_id}")


def account_loader(spark: SparkSession, target_root: str, base: RunContext) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: versioned account load, checked, then published."""
    from dimforge.plans import account
    from dimforge.sources.sinks import publish_versioned, read_versioned

    def handle(batch_df: DataFrame, epoch_id: int) -> None:
        ctx = context_for(base, epoch_id)
        target = read_versioned(spark, target_root, account.TARGET_SCHEMA)
        _, result = account.load_account(target, batch_df, ctx)
        account.check_next_state(result)
        publish_versioned(target_root, ctx.batch_id, result.next_current(), result.expired)

    return handle
