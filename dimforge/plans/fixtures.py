"""Staging batches and current targets derived from the test tables.

Each fixture is a deterministic function of the given tables, so its size
grows with the scale factor.  ``stg_*`` are batches, ``ods_*`` current
targets; the batch date is the one of ``DEFAULT_CONTEXT``.  The same
definitions exist as SQL in ``dimforge.plans.oracle`` for the DuckDB check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.functions.columns import row_hash


_TABLES: dict[tuple, DataFrame] = {}
_BUILT: dict[tuple, DataFrame] = {}


def _session_key(spark: SparkSession) -> tuple:
    """Identity of a live session: a new context (after ``stop``) never reuses
    frames of an old one, even if Python reuses the object id."""
    return (spark.sparkContext.applicationId, id(spark))


def _once(fn):
    """Build a fixture frame once per session and scale: it is a pure function
    of read-only tables, so the plan object is reused (no data is cached)."""
    import functools

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, *args):
        key = (fn.__name__, _session_key(spark), *args)
        if key not in _BUILT:
            _BUILT[key] = fn(spark, *args)
        return _BUILT[key]

    return wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given (read-only) test table; one reader per session and path, so
    the file listing and footer read happen once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (_session_key(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _mod(c: str, m: int) -> Column:
    return F.col(c) % F.lit(m)


def _ts(year: int, month: Column, day: Column, hour: Column) -> Column:
    return F.make_timestamp_ntz(F.lit(year), month.cast("int"), day.cast("int"), hour.cast("int"),
                                F.lit(0), F.lit(0))


def _acct_id(c: str = "c_custkey") -> Column:
    return F.concat(F.lit("A"), F.col(c).cast("string"))


@_once
def stg_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account staging batch: NULL keys, failed revenue casts, NULL industries."""
    c = table(spark, sf_dir, "customer")
    k = "c_custkey"
    return c.where(_mod(k, 13) != 5).select(
        F.when(_mod(k, 97) == 0, F.lit(None).cast("string")).otherwise(_acct_id()).alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.when(_mod(k, 10) == 3, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("industry"),
        F.when(_mod(k, 53) == 0, F.lit("n/a"))
        .when(_mod(k, 59) == 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_acctbal").cast("decimal(18,2)").cast("string")).alias("annual_revenue"),
        _ts(2020, _mod(k, 12) + 1, _mod(k, 28) + 1, _mod(k, 24)).alias("created_date"),
        _ts(2024, _mod(k, 12) + 1, _mod(k, 28) + 1, F.lit(0)).alias("last_modified_date"),
    )


@_once
def ods_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account dimension: current versions plus closed history versions."""
    c = table(spark, sf_dir, "customer").where(_mod("c_custkey", 5) != 1)
    k = "c_custkey"
    src_created = _ts(2020, _mod(k, 12) + 1, _mod(k, 28) + 1, _mod(k, 24))
    src_modified = _ts(2023, _mod(k, 12) + 1, _mod(k, 28) + 1, F.lit(0))
    loaded = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    current = c.select(
        (F.col(k) + 1000).cast("bigint").alias("customer_account_sk"),
        _acct_id().alias("customer_id"),
        F.when(_mod(k, 7) == 0, F.concat(F.col("c_name"), F.lit("*"))).otherwise(F.col("c_name")).alias("customer_name"),
        F.when(_mod(k, 10) == 4, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("industry"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("revenue_usd"),
        src_created.alias("source_created_date"),
        src_modified.alias("source_last_modified_date"),
        loaded.alias("effective_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        loaded.alias("dw_insert_timestamp"),
        loaded.alias("dw_update_timestamp"),
    )
    first = F.lit("2023-01-01 00:00:00").cast("timestamp_ntz")
    history = c.where(_mod(k, 3) == 0).select(
        (F.col(k) + 1_000_000).cast("bigint").alias("customer_account_sk"),
        _acct_id().alias("customer_id"),
        F.concat(F.col("c_name"), F.lit(" (old)")).alias("customer_name"),
        F.col("c_mktsegment").alias("industry"),
        F.lit(None).cast("decimal(18,2)").alias("revenue_usd"),
        src_created.alias("source_created_date"),
        src_created.alias("source_last_modified_date"),
        first.alias("effective_start_date"),
        F.lit("2023-12-31 23:59:59.999").cast("timestamp_ntz").alias("effective_end_date"),
        F.lit(False).alias("is_current"),
        first.alias("dw_insert_timestamp"),
        loaded.alias("dw_update_timestamp"),
    )
    return current.unionByName(history)


@_once
def stg_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trade staging file (all text columns except amount), from events."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("trade_id"),
        F.lit("CORE").alias("src_sys"),
        F.col("user_id").cast("string").alias("acct_num"),
        F.col("event_type").alias("trx_cd"),
        F.when(F.col("event_type") == "error", F.lit("R"))
        .when(_mod("event_id", 11) == 0, F.lit("C"))
        .when(_mod("event_id", 3) == 0, F.lit("U"))
        .otherwise(F.lit("O")).alias("sc_trx_actn_cd"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.replace(F.col("ts").cast("date").cast("string"), F.lit("-"), F.lit("")).alias("created_dt"),
        F.lit("20250101").alias("btch_dt"),
        F.when(_mod("event_id", 4) == 0, F.lit("Y")).otherwise(F.lit("N")).alias("frst_trd_acct_cd"),
    )


@_once
def ods_plcy_mastr(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where(_mod("c_custkey", 4) != 0)
    return c.select(
        (F.col("c_custkey") + 5000).cast("bigint").alias("plcy_mastr_id"),
        F.lit("CORE").alias("src_sys"),
        F.col("c_custkey").cast("string").alias("plcy_num"),
    )


@_once
def stg_cstmr(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").alias("c")
    n = table(spark, sf_dir, "nation").alias("n")
    k = F.col("c.c_custkey")
    return c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey")).select(
        k.cast("string").alias("acct_num"),
        F.col("n.n_name").alias("state_nm"),
        F.when(k % 9 == 0, F.lit("20241231")).when(k % 9 == 1, F.lit("20250630"))
        .when(k % 9 == 2, F.lit("")).otherwise(F.lit(None).cast("string")).alias("acct_closg_dt"),
        F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.lit("20200115")).alias("acct_open_dt"),
        F.when(k % 8 == 0, F.lit("")).otherwise(F.col("c.c_mktsegment")).alias("custdn_firm_mnm"),
    )


@_once
def ref_status(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(11, "A"), (12, "T")], "ref_id int, src_sys_ref_cd string")


@_once
def trx_mastr(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("click", 1), ("view", 2), ("error", 3)], "trx_cd string, trx_mastr_id int")


@_once
def src_prod_mastr(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("INVESTMENTS", 7001), ("INSURANCE", 7002)], "plan_cd string, src_prod_mastr_id int")


@_once
def ods_plcy_detl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy detail, one active version per policy, three hashed columns."""
    c = table(spark, sf_dir, "customer").where((_mod("c_custkey", 4) != 0) & (_mod("c_custkey", 3) != 1))
    k = "c_custkey"
    return c.select(
        (F.col(k) + 9000).cast("bigint").alias("plcy_detl_id"),
        (F.col(k) + 5000).cast("bigint").alias("plcy_mastr_id"),
        F.lit("CORE").alias("src_sys"),
        F.when(_mod(k, 3) == 0, F.lit("1900-01-01").cast("date")).otherwise(F.lit("2023-05-01").cast("date")).alias("plcy_iss_dt"),
        F.when(_mod(k, 7) == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("custdn_firm_nm"),
        F.when(_mod(k, 2) == 0, F.lit(11)).otherwise(F.lit(12)).alias("plcy_status_id"),
        F.when(_mod(k, 5) == 0, F.lit("1900-01-01").cast("date")).when(_mod(k, 5) == 1, F.lit(None).cast("date"))
        .otherwise(F.lit("2023-06-01").cast("date")).alias("first_depst_dt"),
        F.lit("Y").alias("actv_indctr"),
        F.lit("2024-01-01").cast("date").alias("eff_from_dt"),
        F.lit("9999-12-31").cast("date").alias("eff_to_dt"),
        F.lit("20240101").cast("decimal(19,0)").alias("btch_id"),
        F.lit("seed-trade").alias("crtd_by"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("crtd_dt"),
        F.lit(None).cast("string").alias("mdfd_by"),
        F.lit(None).cast("timestamp_ntz").alias("mdfd_dt"),
    ).withColumn("hash_key", row_hash(["plcy_iss_dt", "plcy_status_id", "custdn_firm_nm"]))


@_once
def ods_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current asset positions per (acct_num, trx_cd) for a third of the accounts."""
    e = table(spark, sf_dir, "events").where(_mod("user_id", 3) == 0)
    return e.groupBy(
        F.col("user_id").cast("string").alias("acct_num"), F.col("event_type").alias("trx_cd")
    ).agg(
        F.max(F.col("value")).cast("decimal(18,2)").alias("amount"),
        F.min("event_id").alias("position_id"),
    ).select(
        "position_id", F.lit("CORE").alias("src_sys"), "acct_num", "trx_cd", "amount",
        F.lit("O").alias("actn_cd"), F.lit("20241231").cast("decimal(19,0)").alias("btch_id"),
        F.lit(None).cast("string").alias("mdfd_by"),
    )


@_once
def ods_trx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades loaded by earlier batches (every even event)."""
    e = table(spark, sf_dir, "events").where(_mod("event_id", 2) == 0)
    return e.select(
        F.col("event_id").alias("trade_id"),
        F.lit("CORE").alias("src_sys"),
        F.col("user_id").cast("string").alias("acct_num"),
        F.col("event_type").alias("trx_cd"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
        F.when(_mod("event_id", 10) == 0, F.lit("R")).otherwise(F.lit("O")).alias("actn_cd"),
        F.lit(None).cast("bigint").alias("reversed_trade_id"),
        F.lit("20241231").cast("decimal(19,0)").alias("btch_id"),
    )
