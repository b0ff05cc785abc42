"""Writers: aligned append, rejections, and the versioned-table publish.

A versioned table lives in two folders under its root:

* ``current/v=<batch_id>/`` one full snapshot of the open versions per batch,
  written to a new folder, never over the one being read;
* ``history/closed_by=<batch_id>/`` closed versions, append-only.

Publishing a batch writes the rows it closed, then the new snapshot.  A snapshot
is complete when its ``_SUCCESS`` marker exists.  Readers take the highest complete
snapshot and the history closed up to that batch, so a crash between the two writes
leaves the previous state in force.  A batch whose snapshot is complete is not
published again: a rerun, which finds nothing to close, cannot erase its history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimforge.operators.schema import align_to_schema


def append_aligned(df: DataFrame, path: str, schema: StructType) -> None:
    """Align by name to the target schema, then append."""
    align_to_schema(df, schema).write.mode("append").parquet(path)


def write_rejections(rejections: DataFrame, path: str) -> None:
    rejections.write.mode("append").parquet(path)


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Batch ids of the complete snapshots (one folder listing, no data read)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/current")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    marker = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and fs.exists(marker(path, f"{n}/_SUCCESS")))


def read_versioned(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """Whole table: the newest complete snapshot of open versions plus the history up to its batch."""
    from dimforge.sources.scans import path_exists

    root = root.rstrip("/")
    versions = snapshot_versions(spark, root)
    if not versions:
        return spark.createDataFrame([], schema)
    current = spark.read.parquet(f"{root}/current/v={versions[-1]}")
    frames = [align_to_schema(current, schema)]
    if path_exists(spark, f"{root}/history"):
        closed = spark.read.parquet(f"{root}/history").where(F.col("closed_by") <= versions[-1])
        frames.append(align_to_schema(closed.drop("closed_by"), schema))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def publish_versioned(root: str, batch_id: int, next_current: DataFrame, closed: DataFrame) -> None:
    """Write the rows this batch closed, then the new snapshot of open versions.

    History first: if the job dies between the two writes the old snapshot is
    still in force, readers skip the newer history, and the rerun rewrites the same
    history folder (``overwrite`` of that batch's folder only).  Nothing is written
    when the batch's snapshot is complete already."""
    root = root.rstrip("/")
    if batch_id in snapshot_versions(next_current.sparkSession, root):
        return
    closed.write.mode("overwrite").parquet(f"{root}/history/closed_by={batch_id}")
    next_current.write.mode("overwrite").parquet(f"{root}/current/v={batch_id}")

