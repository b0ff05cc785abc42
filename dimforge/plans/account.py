"""Customer-account dimension: staging accounts to a versioned dimension.

Steps: typed scan -> NULL-key rejects -> duplicate guard -> revenue cast
rejects -> column mapping -> SCD2 by tracked columns -> checks -> publish.
The functions here build the plan; ``load_account`` runs it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from dimforge.context import RunContext
from dimforge.operators import quality
from dimforge.operators.schema import rename
from dimforge.operators.scd import Scd2Result, Scd2Spec, scd2_apply, single_active_violations

SOURCE_TABLE = "STG_ACCOUNTS"
# The columns of the staged file and of the dimension, as the file's sender and the
# dimension's readers know them: (staged, dimension, type, tracked).
CARRIED = (
    ("account_id", "customer_id", StringType(), False),
    ("account_name", "customer_name", StringType(), True),
    ("industry", "industry", StringType(), True),
    ("annual_revenue", "revenue_usd", DecimalType(18, 2), True),
    ("created_date", "source_created_date", TimestampNTZType(), False),
    ("last_modified_date", "source_last_modified_date", TimestampNTZType(), False),
)
_KEY = CARRIED[0][1]

STAGING_COLUMNS = tuple(staged for staged, *_ in CARRIED)
# the revenue is cast to its own name before the mapping
MAPPING = tuple((column if staged == "annual_revenue" else staged, column) for staged, column, *_ in CARRIED)

ACCOUNT_SPEC = Scd2Spec(
    key=_KEY, sk="customer_account_sk",
    columns=tuple(column for _, column, *_ in CARRIED if column != _KEY),
    tracked=tuple(column for _, column, _, tracked in CARRIED if tracked),
)

_TYPES = {column: kind for _, column, kind, _ in CARRIED} | {
    ACCOUNT_SPEC.sk: LongType(), ACCOUNT_SPEC.current: BooleanType(),
    **{c: TimestampNTZType() for c in (ACCOUNT_SPEC.start, ACCOUNT_SPEC.end, ACCOUNT_SPEC.inserted_at, ACCOUNT_SPEC.updated_at)}}
TARGET_SCHEMA = StructType([
    StructField(c, _TYPES[c], c in ACCOUNT_SPEC.columns or c == ACCOUNT_SPEC.end) for c in ACCOUNT_SPEC.target_columns()])


@dataclass
class AccountBatch:
    incoming: DataFrame
    null_key: DataFrame
    bad_revenue: DataFrame

    def rejections(self, ctx: RunContext) -> DataFrame:
        return quality.rejection_rows(self.null_key, ctx, SOURCE_TABLE, "account_id", quality.NULL_NATURAL_KEY,
                                      STAGING_COLUMNS).unionByName(
            quality.rejection_rows(self.bad_revenue, ctx, SOURCE_TABLE, "account_id",
                                   quality.INVALID_REVENUE_CAST, STAGING_COLUMNS))


def prepare_batch(staged: DataFrame) -> AccountBatch:
    """Split rejects off and map the rest to dimension column names (lazy)."""
    valid, null_key = quality.split_null_keys(staged, "account_id")
    valid, bad_revenue = quality.split_bad_cast(valid, "annual_revenue", "decimal(18,2)", "revenue_usd")
    return AccountBatch(rename(valid, MAPPING), null_key, bad_revenue)


def empty_target(spark) -> DataFrame:
    return spark.createDataFrame([], TARGET_SCHEMA)


def load_account(target: DataFrame, staged: DataFrame, ctx: RunContext, duplicates: str = "halt") -> tuple[AccountBatch, Scd2Result]:
    """Run the account load up to (not including) publishing.

    ``duplicates``: ``halt`` raises on a repeated account id, ``keep_latest``
    keeps the row with the newest ``last_modified_date``.
    """
    from dimforge.operators.keys import dedup_natural_key

    batch = prepare_batch(staged)
    if duplicates == "halt":
        pass  # checked by scd2_apply on the checkpointed join, not by re-reading the batch
    elif duplicates == "keep_latest":
        batch.incoming = dedup_natural_key(
            batch.incoming, [ACCOUNT_SPEC.key],
            [F.col("source_last_modified_date").desc_nulls_last(), F.col("customer_name").asc_nulls_last()])
    else:
        raise ValueError(f"unknown duplicates policy {duplicates!r}")
    # keys are unique after keep_latest; halt lets scd2_apply check the checkpointed join
    result = scd2_apply(target, batch.incoming, ACCOUNT_SPEC, ctx,
                        duplicates="halt" if duplicates == "halt" else "keep")
    return batch, result


def versioned_table(spark, root: str, buckets: int = 64):
    """The account dimension as a bucketed table with a commit chain."""
    from dimforge.sources.versioned import VersionedTable

    return VersionedTable(spark, root, TARGET_SCHEMA, [ACCOUNT_SPEC.key], ACCOUNT_SPEC.sk, ACCOUNT_SPEC.current, buckets)


def check_next_state(result: Scd2Result) -> None:
    """Guard run before publishing: at most one open version per key."""
    bad = single_active_violations(result.next_current(), ACCOUNT_SPEC.key, F.lit(True)).limit(20).collect()
    if bad:
        raise RuntimeError(f"single active version violated for: {[r[ACCOUNT_SPEC.key] for r in bad]}")
