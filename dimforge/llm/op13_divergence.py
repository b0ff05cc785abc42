"""Divergence audit of the sources of each language, priced on hash-consed segment trees.

Every (lang, source) group gives each kept term of its language a smoothed share
``p`` in billionths; two groups differ at a term by ``(p - q)^2 / (p + q)``, floored.

1. One pass over the texts counts terms per task and group; the counts are summed by
   (lang, source, term).  Terms in at least MIN_DOCS documents of the language stay.
2. A language's terms are dealt by a hash into segments of about SEGMENT terms.  A
   group's counts in a segment are the leaves of a segment tree, the frequent terms
   first.  Trees are hash-consed from the leaves up: equal count subtrees, of any
   group and at any place, are one node.
3. Two groups are compared by walking both trees together, one level at a time.  A
   pair of nodes that was met before on that level is not walked again, so each
   distinct pair of nodes is priced once.  The segments' prices are summed per pair.
4. Sources of a language are cut into blocks of BLOCK, and a task holds one segment
   of two blocks, so neither many terms nor many sources meet in one task.

The shares at a term need the sums over all terms, so they are taken from the two
groups' totals at the leaves; all arithmetic is whole numbers.

Defined results: NULL text, lang and source are ''; repeated rows are separate
documents; a group without terms has the smoothed share of zero counts everywhere; a
language without kept terms has price 0 for every pair; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.common import bounded_batches, materialise

MIN_DOCS = 10
UNIT = 1_000_000_000
TOP_TERMS = 10
SEGMENT = 2048
BLOCK = 64
HELD_TERMS = 400_000  # distinct (group, term) entries a task holds before it hands them on

# Bytes of a term stay (A-Z as a-z), all others are blanks.  Bytes from 0x80 on belong to terms, so
# terms of the UTF-8 bytes are the terms of the characters.
_TERM_BYTES = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Terms of a text in order, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents per group; term '' marks the group itself."""
    def run(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def hand_on():
            for (lang, source), (n, in_docs) in held.items():
                words = [b"", *n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words), pa.string()), pa.array([source] * len(words), pa.string()),
                     pa.array(words, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
                     pa.array([0, *(in_docs[w] for w in n)], pa.int64())], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
                n, in_docs = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                found = Counter(terms(text))
                n.update(found)
                in_docs.update(found.keys())
                size += len(n) - before
                if size >= HELD_TERMS:
                    yield from hand_on()
                    held, size = {}, 0
        yield from hand_on()

    bounded_batches(docs.sparkSession)
    blank = F.lit("")
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("lang", "source", "text")))
    partial = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, total, lead) of the kept terms and of the groups themselves (term '', n 0).

    ``total`` is the language's count of the term; ``lead`` is 1 on one row of each (lang, term).
    """
    of_term = Window.partitionBy("lang", "term")
    counted = (term_counts(docs).withColumn("in_docs", F.sum("docs").over(of_term)).withColumn("total", F.sum("n").over(of_term))
               .withColumn("lead", (F.row_number().over(of_term.orderBy("source")) == 1).cast("long")))
    own = F.col("term") == ""
    return materialise(counted.filter(own | (F.col("in_docs") >= min_docs)).select(
        "lang", "source", "term", "n", "total", F.when(own, 0).otherwise(F.col("lead")).cast("long").alias("lead")), "divergence-counts")


def group_totals(counts: DataFrame) -> DataFrame:
    """(lang, source, size, lang_size, v, place, sources), one row per group: totals over the kept terms."""
    of_lang = Window.partitionBy("lang")
    per = counts.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.sum("lead").alias("v"))
    return materialise(per.select(
        "lang", "source", "size", F.sum("size").over(of_lang).alias("lang_size"), F.sum("v").over(of_lang).alias("v"),
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("place"), F.count("*").over(of_lang).alias("sources")), "divergence-groups")


def _share(n: str, size: str) -> Column:
    return F.expr(f"1 + (cast({UNIT} as decimal(38, 0)) * ({n} + 2)) div ({size} + 2 * v)")


class Trees:
    """Segment trees of several count rows over one order of terms, equal subtrees shared.

    ``counts`` is (rows, terms); it is filled up to a power of two with -1, which costs nothing.
    """

    def __init__(self, counts: np.ndarray):
        rows, n = counts.shape
        width = 1 << max(n - 1, 0).bit_length()
        leaves = np.full((rows, width), -1, np.int64)
        leaves[:, :n] = counts
        self.values, ids = np.unique(leaves, return_inverse=True)
        ids = ids.reshape(leaves.shape)
        self.children = []  # per level: left and right child of every node
        known = len(self.values)
        while ids.shape[1] > 1:
            pairs, ids2 = np.unique(ids[:, 0::2] * known + ids[:, 1::2], return_inverse=True)
            self.children.append((pairs // known, pairs % known))
            ids, known = ids2.reshape(rows, -1), len(pairs)
        self.roots = ids[:, 0]

    def price(self, a: int, b: int, leaf_price) -> int:
        """Sum of ``leaf_price(count of a, count of b)`` over all terms; equal node pairs are priced once."""
        u, v = self.roots[a:a + 1], self.roots[b:b + 1]
        met = []
        for left, right in reversed(self.children):
            width = int(max(left.max(), right.max(), 0)) + 1 if len(left) else 1
            pairs, place = np.unique(np.concatenate([left[u], right[u]]) * width + np.concatenate([left[v], right[v]]), return_inverse=True)
            met.append(place)
            u, v = pairs // width, pairs % width
        x, y = self.values[u], self.values[v]
        prices = np.where(x < 0, 0, leaf_price(np.maximum(x, 0), np.maximum(y, 0)))
        for place in reversed(met):
            both = prices[place]
            prices = both[: len(both) // 2] + both[len(both) // 2:]
        return int(prices[0])


def _shares(counts: np.ndarray, size: int, v: int) -> np.ndarray:
    if len(counts) and int(counts.max()) > 9_000_000_000:  # beyond, the product leaves 64 bits
        return np.array([1 + UNIT * (int(c) + 2) // (size + 2 * v) for c in counts], np.int64)
    return 1 + UNIT * (counts + 2) // (size + 2 * v)


def _segment_prices(table: pa.Table) -> pa.Table:
    """Prices of all pairs of one segment and two blocks of sources: (lang, a, b, price), a < b by place."""
    lang, low, high, v = (table.column(c)[0].as_py() for c in ("lang", "low", "high", "v"))
    place, size = table.column("place").to_numpy(), table.column("size").to_numpy()
    places, row = np.unique(place, return_inverse=True)
    sizes = np.zeros(len(places), np.int64)
    sizes[row] = size
    counted = table.filter(pa.compute.is_valid(table.column("term"))) if table.column("term").null_count else table
    words = counted.column("term").combine_chunks().dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    code = words.indices.to_numpy(zero_copy_only=False)
    total = np.zeros(len(words.dictionary), np.int64)
    total[code] = counted.column("total").to_numpy()
    spelled = words.dictionary.to_pylist()
    order = np.array(sorted(range(len(spelled)), key=lambda i: (-total[i], spelled[i])), np.int64)
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    matrix = np.zeros((len(places), max(len(order), 1)), np.int64)
    if len(order):
        matrix[np.searchsorted(places, counted.column("place").to_numpy()), column[code]] = counted.column("n").to_numpy()
    else:
        matrix[:] = -1
    trees = Trees(matrix)
    out = ([], [], [])
    for i in range(len(places)):
        for j in range(i + 1, len(places)):
            if low != high and places[i] // BLOCK == places[j] // BLOCK:
                continue  # this pair belongs to the task of its own block

            def leaf_price(x, y, n_x=int(sizes[i]), n_y=int(sizes[j])):
                p, q = _shares(x, n_x, v), _shares(y, n_y, v)
                return (p - q) * (p - q) // (p + q)

            out[0].append(int(places[i]))
            out[1].append(int(places[j]))
            out[2].append(trees.price(i, j, leaf_price) if len(order) else 0)
    return pa.table({"lang": pa.array([lang] * len(out[0]), pa.string()), "a": pa.array(out[0], pa.int32()),
                     "b": pa.array(out[1], pa.int32()), "price": pa.array(out[2], pa.int64())})


def pair_prices(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, price) for the sources at places a < b of each language."""
    info = groups.withColumn("segments", F.expr(f"greatest(1L, (v + {SEGMENT - 1}) div {SEGMENT})")).withColumn(
        "blocks", F.expr(f"int((sources + {BLOCK - 1}) div {BLOCK})"))
    keys = ["lang", "place", "size", "v", "blocks"]
    kept = (counts.filter("term <> ''").join(info, ["lang", "source"])
            .select(*keys, F.expr("pmod(xxhash64(term), segments)").alias("seg"), "term", "n", "total"))
    # every group takes part in every segment, also where it has no term
    marks = info.select(*keys, F.explode(F.expr("sequence(0L, segments - 1)")).alias("seg"),
                        F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("total"))
    rows = kept.union(marks).withColumn("own", F.expr(f"int(place div {BLOCK})")).withColumn(
        "other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = rows.select("lang", "seg", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                        "place", "size", "v", "term", "n", "total")
    priced = dealt.groupBy("lang", "seg", "low", "high").applyInArrow(_segment_prices, "lang string, a int, b int, price long")
    return priced.groupBy("lang", "a", "b").agg(F.sum("price").alias("price"))


def _ranked(found: DataFrame, part: str, most: int | None = None) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked = found.withColumn("rank", place)
    if most is not None:
        ranked = ranked.filter(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) over ``docs(lang, source, text)``.

    Part ``pair``: every other source of the language, by falling price.  Part ``term``: the
    ``top_terms`` terms that set the source apart from its language by a larger share.
    """
    counts = kept_counts(docs, min_docs)
    groups = group_totals(counts)
    prices = materialise(pair_prices(counts, groups), "divergence-pairs")
    names = groups.select(F.col("lang").alias("of"), F.col("place").alias("at"), "source")
    first = names.select("of", F.col("at").alias("a_at"), F.col("source").alias("a_source"))
    second = names.select(F.col("of").alias("of2"), F.col("at").alias("b_at"), F.col("source").alias("b_source"))
    named = (prices.join(first, (F.col("lang") == F.col("of")) & (F.col("a") == F.col("a_at")))
             .join(second, (F.col("lang") == F.col("of2")) & (F.col("b") == F.col("b_at"))))
    both = named.select("lang", F.explode(F.array(
        F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")),
        F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item")))).alias("e"), F.col("price").alias("value"))
    pairs = _ranked(both.select("lang", "e.source", "e.item", "value"), "pair")

    shares = (counts.filter("term <> '' and n > 0").join(groups, ["lang", "source"])
              .select("lang", "source", F.col("term").alias("item"), _share("n", "size").alias("p"), _share("total", "lang_size").alias("q")))
    apart = shares.filter("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    return pairs.union(_ranked(apart, "term", top_terms))
