"""URL filter: a blocked Bloom filter in front of an exact hash join.

A rule is (host, path, verdict).  It fits its host and all subdomains when the url's
path starts with the rule's path; the longest fitting rule wins.  A url's possible keys
are its host suffixes combined with its path prefixes of every listed length.

The filter has ``2**BLOCK_BITS`` blocks at most, of eight 64-bit words; a key sets one
bit per word of one block.  A block is a row, so probing is a broadcast hash join on
the block number whose size is fixed (under 8 MB).  Keys that pass join the rules on
the key itself, which removes the false positives.  Work is done once per distinct
(host, path).  Everything is built-in column functions.

Defined results: a NULL url or one without ``://`` has empty host and path and no rule;
unlisted urls get ``default``; repeated rows stay rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 16
LANES = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Canonical host and path of a url column."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*+", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*+([^?#]*+)", 1)


def _block(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BLOCK_BITS)


def _bit(key: Column, lane: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(9)), 6 * lane).bitwiseAND(F.lit(63)).cast("int")


def bloom_blocks(keys: DataFrame) -> DataFrame:
    """(block, w0..w7): the filter of a one-column frame ``key``, one row per used block."""
    marks = keys.select(_block(F.col("key")).alias("block"), *[_bit(F.col("key"), i).alias(f"b{i}") for i in range(LANES)])
    return marks.groupBy("block").agg(*[F.expr(f"bit_or(shiftleft(1L, b{i}))").alias(f"w{i}") for i in range(LANES)])


def may_contain(key: Column) -> Column:
    """Whether all bits of a key are set in its block's words."""
    return reduce(lambda a, b: a & b, [F.getbit(F.col(f"w{i}"), _bit(key, i)) == 1 for i in range(LANES)])


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages(page_id, url)``."""
    listed = rules.select(F.concat("host", "path").alias("key"), F.length("host").alias("h"), F.length("path").alias("p"), "verdict")
    lengths = [r.p for r in listed.select("p").distinct().collect()]  # distinct path lengths of the list
    host, path = host_and_path(F.col("url"))
    split = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)] or [F.lit(None).cast("string")]),
                        lambda x: x.isNotNull())
    probes = (split.select("host", "path").filter("host <> ''").distinct().withColumn("suffix", F.explode(suffixes))
              .withColumn("prefix", F.explode(prefixes)).select("host", "path", F.concat("suffix", "prefix").alias("key")))
    blocks = bloom_blocks(listed.select("key"))  # at most 2**BLOCK_BITS rows
    hits = (probes.withColumn("block", _block(F.col("key"))).join(F.broadcast(blocks), "block")
            .filter(may_contain(F.col("key"))).select("host", "path", "key"))
    exact = hits.join(listed, "key")
    best = exact.groupBy("host", "path").agg(F.max(F.struct((F.col("h") + F.col("p")).alias("size"), "h", "key", "verdict")).alias("best"))
    judged = best.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), F.col("best.key").alias("rule"), F.col("best.verdict").alias("verdict"))
    return (split.join(judged, (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
