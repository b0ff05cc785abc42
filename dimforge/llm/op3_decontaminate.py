"""Benchmark decontamination: pair seeds that no copy lacks, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased.  A document leaks an item when the
best local alignment over words (match +2, mismatch and gap -1) reaches ``MIN_RATIO`` of
a perfect one; an item of two words needs more than that, as one word alone scores half.

A seed is an ordered pair of words with at most one word between them.  An alignment of M
matches and E edits reaches the ratio r of n words only if 2M - E >= 2rn.  Two edits
or more between neighbouring matches cost a match, so at least rn - 1 words of the item
start a seed that the document has, all within (3 - 2r) n words.  Therefore:

1. The items are dealt into chunks of about ``CHUNK_WORDS`` words; each chunk's index
   is broadcast and the documents are read twice per chunk.
2. The first pass counts the documents that hold each seed.  Every item leaves out
   the rn - 2 starts whose seeds are the most frequent.  A copy still has a seed; the
   frequencies steer the work and never the result.
3. The second pass finds the remaining seeds in a document.  Around each, the item must
   share rn - 1 seeds of any frequency within the span, and is then aligned.

Defined results: NULL or word-free texts (documents or items) never match;
repeated rows give one result per (doc_id, item_id); rows with a NULL id count as rows of
one id, and the result names them by NULL; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import bounded_batches, free_name, materialise, with_row_key
from dimforge.llm.textnum import grams, run_bounds, span_hashes

CHUNK_WORDS = 1 << 20
MIN_RATIO = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def content_words(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased letter-and-digit runs of a text."""
    if not text:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    return span_hashes(raw, *run_bounds(_WORD[raw]))


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: (score, start, end) of the aligned part of the window."""
    n, m = len(item), len(window)
    table = np.zeros((n + 1, m + 1), np.int32)
    ramp = np.arange(m + 1, dtype=np.int32) * -GAP
    for i in range(1, n + 1):
        above = table[i - 1]
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(window == item[i - 1], MATCH, MISMATCH))
        table[i] = np.maximum.accumulate(row + ramp) - ramp
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, end = int(table[i, j]), int(j)
    while table[i, j] > 0:
        if table[i, j] == table[i - 1, j - 1] + (MATCH if item[i - 1] == window[j - 1] else MISMATCH):
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), end


def word_pairs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed, start) of all pairs at distance 1 and 2."""
    near = grams(words, 2)
    # the pairs over one word, in the even and the odd places
    far = np.empty(max(0, len(words) - 2), np.uint64)
    far[::2], far[1::2] = grams(words[::2], 2), grams(words[1::2], 2)
    return np.concatenate([near, far]), np.concatenate([np.arange(len(near)), np.arange(len(far))])


def needed(n: int) -> int:
    """Starts of seeds that every copy of an item of n words shares with it."""
    return max(1, math.ceil(MIN_RATIO * n) - 1)


def span(n: int) -> int:
    """The most words that a copy of an item of n words covers."""
    return math.ceil((3 - 2 * MIN_RATIO) * n)


def is_leak(score: int, n: int) -> bool:
    return score > MATCH if n == 2 else score >= MIN_RATIO * MATCH * n


def _items(benchmark: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            words = [content_words(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64()))], names=["item_id", "item_words"])

    rows = benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(run, "item_id long, item_words array<long>")
    return rows.filter(F.size("item_words") > 0).dropDuplicates(["item_id", "item_words"])


class Lookup:
    """Sorted distinct seeds behind a bitmap of their top bits."""

    def __init__(self, seeds: np.ndarray):
        self.seeds = np.unique(seeds)
        self.shift = np.uint64(64 - max(20, int(32 * len(self.seeds)).bit_length()))
        self.table = np.zeros(1 << (64 - int(self.shift) - 3), np.uint8)
        slot = self.seeds >> self.shift
        np.bitwise_or.at(self.table, (slot >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (slot & np.uint64(7)).astype(np.uint8)))

    def find(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``seeds``, number of the seed) of those that are in the table."""
        slot = seeds >> self.shift
        at = np.flatnonzero((self.table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & np.uint8(1))
        number = np.searchsorted(self.seeds, seeds[at])
        same = self.seeds[np.minimum(number, len(self.seeds) - 1)] == seeds[at]
        return at[same], number[same]


def _seeds(words: np.ndarray, single: bool) -> tuple[np.ndarray, np.ndarray]:
    """(seed, start): the word pairs, and the words themselves if items of one word need them."""
    seeds, starts = word_pairs(words)
    if single:
        seeds, starts = np.concatenate([seeds, grams(words, 1)]), np.concatenate([starts, np.arange(len(words))])
    return seeds, starts


def _frequencies(docs: DataFrame, lookup: Lookup, single: bool) -> np.ndarray:
    """Documents (rows) that hold each seed."""
    shared = docs.sparkSession.sparkContext.broadcast(lookup)

    def run(batches):
        table = shared.value
        counts = np.zeros(len(table.seeds), np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts[np.unique(table.find(_seeds(content_words(text.as_py()), single)[0])[1])] += 1
        some = np.flatnonzero(counts)
        for k in range(0, len(some), 1 << 16):
            part = some[k:k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(counts[part], pa.int64())], names=["number", "df"])

    found = docs.select("text").mapInArrow(run, "number long, df long").groupBy("number").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(lookup.seeds), np.int64)
    out[found.column("number").to_numpy()] = found.column("df").to_numpy()
    shared.destroy()
    return out


class Index:
    """The kept seeds of a chunk's items and the items that each belongs to."""

    def __init__(self, ids: list, items: list[np.ndarray], lookup: Lookup, frequency: np.ndarray):
        self.ids, self.items = ids, items
        seeds, owners = [], []
        for k, words in enumerate(items):
            n = len(words)
            if n == 1:
                kept = grams(words, 1)
            else:
                pairs, starts = word_pairs(words)
                cost = np.bincount(starts, frequency[np.searchsorted(lookup.seeds, pairs)], n - 1)
                rare = np.zeros(n - 1, bool)
                rare[np.argsort(cost, kind="stable")[: n - needed(n)]] = True
                kept = np.unique(pairs[rare[starts]])
            seeds.append(kept)
            owners.append(np.full(len(kept), k))
        seeds, owners = np.concatenate(seeds), np.concatenate(owners)
        self.lookup = Lookup(seeds)
        self.owners = owners[np.argsort(seeds, kind="stable")]
        self.ends = np.searchsorted(np.sort(seeds), self.lookup.seeds, "right")
        self.single = any(len(w) == 1 for w in items)

    def candidates(self, words: np.ndarray) -> dict[int, np.ndarray]:
        """Sorted starts of kept seeds in a document, per item."""
        seeds, starts = _seeds(words, self.single)
        at, number = self.lookup.find(seeds)
        if not len(at):
            return {}
        first = np.where(number > 0, self.ends[number - 1], 0)
        size = self.ends[number] - first
        place = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        item, start = self.owners[place], np.repeat(starts[at], size)
        order = np.lexsort((start, item))
        item, start = item[order], start[order]
        cuts = np.flatnonzero(np.diff(item)) + 1
        return dict(zip(item[np.concatenate(([0], cuts))].tolist(), np.split(start, cuts)))

    def leaks(self, words: np.ndarray):
        """(item number, score, start, end) of the best alignment of each item found."""
        for k, starts in self.candidates(words).items():
            item, best = self.items[k], None
            for lo, hi in _windows(item, words, starts):
                score, a, b = align(item, words[lo:hi])
                if is_leak(score, len(item)) and (best is None or (score, -a - lo) > (best[0], -best[1])):
                    best = (score, a + lo, b + lo)
            if best:
                yield k, *best


def _windows(item: np.ndarray, words: np.ndarray, starts: np.ndarray):
    """Parts of a document around seeds that share enough seeds with the item, at most two spans long."""
    n, reach = len(item), span(len(item))
    cuts = np.flatnonzero(np.diff(starts) > 2 * reach) + 1
    own = np.sort(word_pairs(item)[0]) if n > 1 else None
    for part in np.split(starts, cuts):
        first, last = max(0, int(part[0]) - reach), min(len(words), int(part[-1]) + reach + 1)
        if n > 1:
            seeds, at = word_pairs(words[first:last])
            have = own[np.minimum(np.searchsorted(own, seeds), len(own) - 1)] == seeds
            marks = np.concatenate(([0], np.cumsum(np.bincount(at[have], minlength=last - first) > 0)))
        # every stretch of ``reach`` words lies in one of the windows
        for lo in range(first, max(first + 1, last - reach), reach):
            hi = min(last, lo + 2 * reach)
            if n > 1:
                m = marks[lo - first : hi - first + 1]
                if (m[min(reach, hi - lo):] - m[: max(1, hi - lo - reach + 1)]).max() < needed(n):
                    continue
            yield lo, hi


def _found_schema(docs: DataFrame) -> str:
    return f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, score long, ratio double, start_word long, end_word long"


def _found(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        table = shared.value
        for batch in batches:
            out = ([], [], [], [], [], [])
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                for k, score, a, b in table.leaks(content_words(text.as_py())):
                    ratio = score / (MATCH * len(table.items[k]))
                    for column, value in zip(out, (doc_id.as_py(), table.ids[k], score, ratio, a, b)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (batch.column(0).type, pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                names=["doc_id", "item_id", "score", "ratio", "start_word", "end_word"])

    schema = _found_schema(docs)
    found = materialise(docs.mapInArrow(run, schema), "decontam-found")
    shared.destroy()
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, score, ratio, start_word, end_word): benchmark items found in documents.

    The best place per document and item; word positions count content words.  ``key`` names the
    column that tells documents apart, of any type; it is returned as doc_id.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    told = F.col(key).cast("long") if key == "doc_id" else F.col(key)
    texts = docs.select(told.alias("doc_id"), "text").filter("text is not null")
    items = materialise(_items(benchmark), "decontam-items")
    chunks = -(-(items.agg(F.sum(F.size("item_words"))).first()[0] or 0) // CHUNK_WORDS)
    found = spark.createDataFrame([], _found_schema(texts))
    for c in range(chunks):
        rows = items.filter(F.pmod(F.xxhash64("item_words"), F.lit(chunks)) == c).toArrow()
        if not rows.num_rows:
            continue
        words = [np.array(w.as_py(), np.int64).view(np.uint64) for w in rows.column("item_words")]
        single = any(len(w) == 1 for w in words)
        lookup = Lookup(np.concatenate([_seeds(w, len(w) == 1)[0] for w in words]))
        index = Index(rows.column("item_id").to_pylist(), words, lookup, _frequencies(texts, lookup, single))
        found = found.union(_found(texts, index))
    best = found.groupBy("doc_id", "item_id").agg(
        F.max(F.struct("ratio", "score", F.negative("start_word").alias("s"), "end_word")).alias("best"))
    return best.select("doc_id", "item_id", "best.score", "best.ratio", F.negative("best.s").alias("start_word"), "best.end_word")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found; rows are told apart also without an id."""
    row = free_name(docs, "leak_row")
    keyed = with_row_key(docs, row)
    found = leaks(keyed.select(row, "text"), benchmark, key=row).select(F.col("doc_id").alias(row)).distinct()
    return keyed.join(found, row, "left_anti").select(*docs.columns)
