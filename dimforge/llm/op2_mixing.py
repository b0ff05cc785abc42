"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies, ``target /
source size``.  Its whole part is taken for sure; the fraction is a probability.
Pivotal rounding lets two fractional probabilities fight: mass moves at random
until one of them is 0 or 1, and the other goes on to the next fight.  Each
expectation is kept, and the number taken hardly varies.

The fights form a reduction tree.  Documents of a source are dealt by a hash into
blocks of about ``BLOCK``; inside a block they meet from the largest to the smallest,
so mass moves between documents of like size and a small one is left.  A block settles all of its documents but
one, and those residuals meet in the blocks of the next level until one is left
per source.  The last one is settled by its own draw.

Every random number is a hash of the id, the row's place in its file and a seed, so reruns over the same
files agree, and rows that repeat an id or have none are dealt and drawn like any other.  Everything is
built-in column functions; the tables of sources hold one row per source.

Defined results: NULL or blank text has size 0; NULL is a source of its own, the
last; a source of size 0 has target 0; repeated rows are separate documents; extra
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.common import free_name, materialise, n_words, with_row_key

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 512
EPS = 1e-9


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, target) from ``sizes(source, size)``: one row per source.

    Weights repeat 5, 2, 1 over the sources by code point, NULL last.  Targets share
    the total by weight, none above MOST times its source's size: with sources in the
    order of cap per weight, the first ones are capped until the level fits the rest.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = (per.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0)))
           .withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
           .withColumn("level", (F.col("total") - F.col("capped")) / (F.col("weights") - F.col("used")))
           # the first source, in this order, whose cap holds the level sets it for all
           .withColumn("fits", F.col("level") * F.col("weight") <= F.col("cap")))
    per = per.withColumn("at", F.min(F.when(F.col("fits"), F.struct("used", "level"))).over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("at.level") * F.col("weight"))
    return per.select("source", "source_size", "n_docs", F.coalesce(target, F.lit(0.0)).cast("double").alias("target"))


def _draw(*parts) -> Column:
    """A uniform number in [0, 1) from a hash of the arguments."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _fight(block: Column, level: int, seed: int) -> Column:
    """Settle a block of units: struct(done array, rest unit).

    The unit that carries mass meets the next one.  With a + b < 1 one of them takes
    all mass and the other drops to 0; otherwise one becomes 1 and the other keeps
    a + b - 1.
    """
    unit = lambda u, p: F.struct(u["size"].alias("size"), u["id"].alias("id"), u["row"].alias("row"), p.alias("p"))
    first = F.element_at(block, 1)

    def meet(state, b):
        a = state["rest"]
        total = a["p"] + b["p"]
        u = _draw(a["id"], b["id"], a["row"], b["row"], F.lit(seed), F.lit(level))
        small = total < 1 - EPS
        # the chance that b ends as the one that carries on
        share = F.when(small, b["p"] / F.greatest(total, F.lit(EPS))).otherwise((1 - b["p"]) / F.greatest(2 - total, F.lit(EPS)))
        b_goes = u < share
        settled = F.when(small, 0.0).otherwise(1.0)
        left = F.when(small, total).otherwise(F.greatest(total - 1, F.lit(0.0)))
        stays = F.when(b_goes, unit(a, settled)).otherwise(unit(b, settled))
        return F.struct(F.concat(state["done"], F.array(stays)).alias("done"),
                        F.when(b_goes, unit(b, left)).otherwise(unit(a, left)).alias("rest"))

    none = F.filter(block, lambda u: F.lit(False))
    return F.aggregate(F.slice(block, 2, F.size(block)), F.struct(none.alias("done"), first.alias("rest")), meet)


def pivotal_rounding(units: DataFrame, most: int, seed: int) -> DataFrame:
    """(grp, id, size, row, taken 0/1) from ``units(grp, id, size, row, p, n)``; ``n`` counts the group's units.

    ``row`` tells units apart, ``id`` need not.
    ``most`` is the largest group's number of units; it sets the depth of the tree.
    """
    levels = max(1, math.ceil(math.log(max(most, 2), BLOCK)))
    settled, current = None, units
    for level in range(levels + 1):
        # the last level has one block per group
        blocks = F.ceil(F.col("n") / F.lit(float(BLOCK ** (level + 1)))).cast("long") if level < levels else F.lit(1).cast("long")
        dealt = current.select("grp", "n", F.pmod(F.xxhash64("id", "row", F.lit(seed)), blocks).alias("block"),
                               F.struct("size", "id", "row", "p").alias("unit"))
        packed = dealt.groupBy("grp", "n", "block").agg(F.collect_list("unit").alias("all"))
        fought = materialise(packed.select("grp", "n", _fight(F.sort_array("all", asc=False), level, seed).alias("r")), "mix-level")
        done = fought.select("grp", F.explode("r.done").alias("u")).select("grp", "u.id", "u.size", "u.row", F.col("u.p").alias("taken"))
        settled = done if settled is None else settled.union(done)
        current = fought.select("grp", "n", "r.rest.*").select("grp", "id", "size", "row", "p", "n")
        if level < levels and BLOCK ** (level + 1) >= most:
            break
    last = current.select("grp", "id", "size", "row", (_draw("id", "row", F.lit(seed), F.lit(-1)) < F.col("p") - EPS).cast("double").alias("taken"))
    return settled.union(last)


def _mix_rows(docs: DataFrame, seed: int) -> DataFrame:
    """(row, doc_id, source, size, source_size, target, copies) for every row of ``docs(row, doc_id, text, source)``."""
    sizes = materialise(docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                    n_words(F.col("text")).alias("size")), "mix-sizes")
    targets = materialise(source_targets(sizes), "mix-targets")
    most = targets.agg(F.max("n_docs")).first()[0]
    grp = F.struct(F.col("source").alias("source"), "source_size", "target")
    # one row per source: a few thousand at most, so the join needs no shuffle of the documents
    known = targets.select(F.col("source").alias("of"), "source_size", "target", "n_docs",
                           F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("of")))
    units = rows.select(grp.alias("grp"), F.col("doc_id").alias("id"), "size", "row",
                        (F.col("rate") - F.floor("rate")).alias("p"), F.col("n_docs").alias("n"))
    if not most:
        return units.select("row", F.col("id").alias("doc_id"), "grp.*", "size", F.lit(0).cast("long").alias("copies"))
    out = pivotal_rounding(units, most, seed)
    rate = F.when(F.col("grp.source_size") > 0, F.col("grp.target") / F.col("grp.source_size")).otherwise(0.0)
    return out.select("row", F.col("id").alias("doc_id"), "grp.*", "size", (F.floor(rate) + F.round("taken")).cast("long").alias("copies"))


def mix(docs: DataFrame, seed: int = 2) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs(doc_id, text, source)``."""
    row = free_name(docs, "mix_row")
    mixed = _mix_rows(with_row_key(docs, row).select(F.col(row).alias("row"), "doc_id", "text", "source"), seed)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, seed: int = 2) -> DataFrame:
    """Rows of ``docs`` that the mix takes, with size, source_size, target, copies and taken.

    Each row has its own copies, also if it repeats a doc_id or has none.  Columns of ``docs`` that
    bear one of the added names are replaced.
    """
    added = ("size", "source_size", "target", "copies", "taken")
    row = free_name(docs, "mix_row")
    keyed = with_row_key(docs, row)
    mixed = _mix_rows(keyed.select(F.col(row).alias("row"), "doc_id", "text", "source"), seed).filter("copies > 0").select(
        F.col("row").alias(row), *added[:4], (F.col("copies") * F.col("size")).alias("taken"))
    return keyed.drop(*added).join(mixed, row).select(*[c for c in docs.columns if c not in added], *added)
