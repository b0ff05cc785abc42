"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.session import scratch_path

# White space of the word rule: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_at = path
    if (mine := _noting.get()) is not None:
        mine.append(back)
    return back


_noting: ContextVar[list | None] = ContextVar("tables written by the running step", default=None)


@contextmanager
def noted_tables():
    """The list of the tables that ``materialise`` writes inside the block, for a later ``discard``."""
    mine: list[DataFrame] = []
    token = _noting.set(mine)
    try:
        yield mine
    finally:
        _noting.reset(token)


def discard(*tables: DataFrame | None) -> None:
    """Delete the files of tables written by ``materialise`` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_written_at", None)
        if path:
            jvm = df.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` bears it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column that tells its rows apart, the same in every evaluation.

    Rows of a file scan are told by a hash of their file and their place in it, so no copy
    is written.  Any other frame is written once with numbered rows.
    """
    try:
        return docs.select("*", F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).alias(name))
    except AnalysisException:
        numbered = F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("at"))
        return materialise(docs.select("*", numbered.alias(name)), "keyed-rows")


def n_words(text):
    """Number of words of a text column (NULL: 0), without building an array."""
    # every word start is a non-space after a space (or the text's start)
    trimmed = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES)))
    squeezed = F.regexp_replace(trimmed, " +", " ")
    return F.when(F.length(trimmed) == 0, F.lit(0).cast("long")).otherwise(
        F.length(squeezed).cast("long") - F.length(F.translate(squeezed, " ", "")) + 1)


def word_array(text):
    """Words of a text column in order (NULL or blank: empty array)."""
    spaced = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES)))
    return F.when(F.length(spaced) == 0, F.array().cast("array<string>")).otherwise(F.split(spaced, " +"))


def bucket_of(col, modulus: int):
    """``crc32(col as text) mod modulus``: the fixed split of labelled rows."""
    return F.crc32(col.cast("string")) % F.lit(modulus)


def membership_bits(ids: DataFrame, bits: int):
    """Bitmap of ``2**bits`` slots with the top bits of every 64-bit id of a one-column frame.

    At most ``2**(bits - 6)`` words reach the driver, whatever the number of ids.
    """
    import numpy as np

    slot = F.shiftrightunsigned(ids.columns[0], 64 - bits)
    words = (ids.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
             .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")))
    found = words.toArrow()  # one job; a row iterator would run one job per partition
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def let(value, body):
    """``body(value)`` with ``value`` computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


# Rows per Arrow batch.  Texts can be long, so a batch of the default 10,000 rows
# can hold gigabytes.
BATCH_ROWS = 500


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to BATCH_ROWS unless it is lower already."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
