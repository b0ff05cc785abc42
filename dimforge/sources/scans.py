"""Typed scans: parquet, delimited text, JDBC, and a target that may not exist yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def typed_parquet(spark: SparkSession, path: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Read parquet keeping only ``columns`` [(name, type)], each ``try_cast``.

    Only the named columns reach the scan's ReadSchema; filters applied later
    are pushed into the parquet reader by the optimizer.
    """
    df = spark.read.parquet(path)
    return df.select(*[
        (F.col(c) if df.schema[c].dataType.simpleString() == t else F.col(c).try_cast(t)).alias(c)
        for c, t in columns
    ])


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], delimiter: str = ",",
                   header: bool = True) -> DataFrame:
    """Delimited text with a header; every column is text.

    Quote ``"`` with a doubled quote as escape; an empty field reads as NULL
    (Spark's default), the explicit all-string schema avoids an inference pass.
    """
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return (spark.read.schema(schema)
            .option("header", str(header).lower())
            .option("sep", delimiter)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .csv(path))


def write_delimited(df: DataFrame, path: str, delimiter: str = ",") -> None:
    (df.write.mode("overwrite").option("header", "true").option("sep", delimiter)
     .option("quote", '"').option("escape", '"').csv(path))


def jdbc_options(url: str, table_or_query: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options for a table name or a parenthesised subquery with alias."""
    opts = {"url": url, "dbtable": table_or_query, "fetchsize": str(fetch_size)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def jdbc_scan(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """One-connection JDBC read (small lookups)."""
    return spark.read.format("jdbc").options(**options).load()


def partition_bounds_query(table_or_query: str, column: str) -> str:
    return f"(select min({column}) as lo, max({column}) as hi from {table_or_query} b) bounds"


def jdbc_partitioned_options(options: dict[str, str], column: str, lower: int, upper: int,
                             partitions: int) -> dict[str, str]:
    """Options that split a JDBC read into ``partitions`` ranges of ``column``."""
    if upper < lower:
        raise ValueError("upper bound below lower bound")
    parts = max(1, min(partitions, upper - lower + 1))
    out = dict(options)
    out.update({"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
                "numPartitions": str(parts)})
    return out


def jdbc_partitioned_scan(spark: SparkSession, options: dict[str, str], column: str,
                          partitions: int) -> DataFrame:
    """JDBC read split on a numeric key: bounds come from one min/max query."""
    bounds = jdbc_scan(spark, {**options, "dbtable": partition_bounds_query(options["dbtable"], column)}).collect()[0]
    if bounds["lo"] is None:
        return jdbc_scan(spark, options)
    return jdbc_scan(spark, jdbc_partitioned_options(options, column, int(bounds["lo"]), int(bounds["hi"]),
                                                     partitions))


def path_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` holds a readable dataset (a missing path raises
    PATH_NOT_FOUND; any other error is not swallowed)."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return False
        raise


def target_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The target table, or an empty frame of its schema when it does not exist."""
    if path_exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)
