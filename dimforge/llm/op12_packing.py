"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

A document's ids are those of a public tokenizer, then END.  Documents above
CAPACITY are cut into pieces of CAPACITY; only the last may be shorter.  Full pieces
are sequences of their own, the rest is packed:

1. The pieces are dealt by a hash into blocks of about BLOCK.  Each block is evolved on
   ISLANDS islands, each a task of its own.  An individual is a partition of the block's
   pieces into bins; it is fitter the fewer bins it has, then the more unevenly
   they are filled.  Crossover injects whole well-filled bins of one parent into the other, removes the
   bins that hold a piece twice and best-fits the displaced pieces, the longest first.
   Mutation dissolves a few of the worst-filled bins.
2. After every epoch each island takes the elite of the island before it and evolves on.  A block
   whose elite needs no more bins than a lower bound allows goes through no further epoch.
3. Bins filled to within SLACK of the capacity stay.  The pieces of the others meet those of other
   blocks in the blocks of the next level, until one block is left or the
   rest no longer shrinks; the last level keeps all its bins.

Lengths and row keys are all that is moved; a task holds one block.  Every choice is drawn
from a generator seeded by block, island, epoch and level.

Defined results: NULL text is empty and gives one piece with END only; repeated rows and rows
with a NULL doc_id are documents of their own; extra columns are ignored; an empty
table gives no rows.  ``sequence_id`` is the smallest row key of a piece in the sequence.
"""

from __future__ import annotations

import os
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import bounded_batches, materialise

CAPACITY = 4096
END = 1
BLOCK = 1024
ISLANDS = 3
EPOCHS = 3
CHILDREN = 16        # per island and epoch
POPULATION = 6
SLACK = 8
LEVELS = 8
CACHED_CHUNKS = 700_000  # two tables of them, some 150 MB each
CACHED_LENGTH = 64


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer removes white space, so no token crosses a blank, tab or line break: a text is cut
    there and distinct chunks are encoded once, as long as they are remembered.  Chunks seen
    since the last turn of the table stay over the next one.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        self.tokenizer = Tokenizer.from_str(vocabulary)
        # a word of a-z is normalised, one split piece and spelled by its own bytes already
        self.words = Tokenizer.from_str(vocabulary)
        self.words.normalizer = self.words.pre_tokenizer = None
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def __call__(self, text: str) -> bytes:
        chunks = text.encode("utf-8").split()
        known = self.known
        missing = set(chunks).difference(known)
        if not missing:
            return b"".join(map(known.__getitem__, chunks))
        if len(known) > CACHED_CHUNKS:
            self.before, self.known = known, {}
            known, missing = self.known, set(chunks)
        before = self.before
        made = {c: before[c] for c in missing if c in before}
        # a mark after an ASCII letter is a token piece of its own, and ASCII words count in lower case:
        # such chunks are looked up and encoded by their core
        core = {c: _core(c) for c in missing if c not in made}
        fresh = {x for x, _ in core.values() if x not in known and x not in before}
        fresh.update(x for _, x in core.values() if x and x not in known)
        plain = [x for x in fresh if x.isalpha() and x.islower()]  # of bytes: a-z only
        for tokenizer, some in ((self.words, plain), (self.tokenizer, list(fresh.difference(plain)))):
            encoded = tokenizer.encode_batch_fast([x.decode("utf-8") for x in some], add_special_tokens=False)
            made.update(zip(some, (struct.pack(f"<{len(e)}I", *e.ids) for e in encoded)))
        ids_of = lambda x: made[x] if x in made else known[x] if x in known else before[x]
        made.update([(c, ids_of(word) + ids_of(mark) if mark else ids_of(word)) for c, (word, mark) in core.items()])
        known.update(made)
        out = b"".join(map(known.__getitem__, chunks))
        for c in made:
            if len(c) > CACHED_LENGTH:
                del known[c]
        return out


def _core(chunk: bytes) -> tuple[bytes, bytes]:
    """A chunk as (word, mark) whose ids follow each other; the mark may be empty."""
    mark = b""
    if len(chunk) > 1 and chunk[-1] in b".,;:!?" and (97 <= chunk[-2] <= 122 or 65 <= chunk[-2] <= 90):
        chunk, mark = chunk[:-1], chunk[-1:]
    if chunk.isascii() and b"<" not in chunk:
        chunk = chunk.lower()
    return chunk, mark


def _encoder(vocabulary: str) -> Encoder:
    """One encoder per worker process; this package travels by value, so its own globals last for one task only."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_dimforge_encoders", {})
    key = hash(vocabulary)
    if key not in kept:
        kept.clear()
        kept[key] = Encoder(vocabulary)
    return kept[key]


def pieces_of(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces of one document's ids."""
    step = 4 * capacity
    return [(at // 4, len(part) // 4, zlib.crc32(part)) for at in range(0, len(ids), step) for part in (ids[at:at + step],)]


def document_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row of ``docs(doc_id, text)``.

    ``vocabulary`` is the path of a tokenizer file; it is read on the driver and sent to the tasks (1 to 2 MB).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())
    end = np.array([END], "<u4").tobytes()

    def run(batches):
        encode = _encoder(shared.value)
        for batch in batches:
            rows = ([], [], [], [], [])
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, (start, length, crc) in enumerate(pieces_of(encode(text or "") + end, capacity)):
                    for column, value in zip(rows, (doc_id, k, start, length, crc)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Packing:
    """A partition of items into bins (lists of item numbers) with the free space of each."""

    def __init__(self, bins: list[list[int]], free: list[int]):
        self.bins, self.free = bins, free

    def fitness(self, capacity: int) -> tuple[int, int]:
        """Fewer bins first, then the larger sum of squared fills."""
        return -len(self.bins), sum((capacity - f) ** 2 for f in self.free)

    def best_fit(self, items, lengths: list[int], capacity: int) -> None:
        """Put every item, in the order given, where the least space is left."""
        at: dict[int, list[int]] = {}
        spaces = 0  # bit f: some bin has f free
        for b, f in enumerate(self.free):
            at.setdefault(f, []).append(b)
            spaces |= 1 << f
        for i in items:
            need = lengths[i]
            fits = spaces >> need
            if fits:
                f = need + (fits & -fits).bit_length() - 1
                same = at[f]
                b = same.pop()
                if not same:
                    spaces ^= 1 << f
                self.bins[b].append(i)
            else:
                f, b = capacity, len(self.bins)
                self.bins.append([i])
                self.free.append(f)
            left = f - need
            self.free[b] = left
            same = at.setdefault(left, [])
            if not same:
                spaces |= 1 << left
            same.append(b)


def crossover(a: Packing, b: Packing, lengths: list[int], capacity: int, draw: random.Random) -> Packing:
    """Whole well-filled bins of ``b`` go into ``a``; bins of ``a`` that share an item with them are dissolved."""
    order = sorted(range(len(b.bins)), key=b.free.__getitem__)
    good = order[: max(1, len(order) // 2)]
    given = draw.sample(good, draw.randint(1, len(good)))
    taken = {i for k in given for i in b.bins[k]}
    child = Packing([list(b.bins[k]) for k in given], [b.free[k] for k in given])
    displaced = []
    for items, free in zip(a.bins, a.free):
        left = [i for i in items if i not in taken]
        if len(left) == len(items):
            child.bins.append(list(items))
            child.free.append(free)
        else:
            displaced += left
    displaced.sort(key=lambda i: (-lengths[i], i))
    child.best_fit(displaced, lengths, capacity)
    return child


def mutate(packing: Packing, lengths: list[int], capacity: int, draw: random.Random) -> Packing:
    """Dissolve a few of the worst-filled bins and some others; their items are best-fitted in a shuffled order of length."""
    n = len(packing.bins)
    order = sorted(range(n), key=packing.free.__getitem__, reverse=True)
    gone = set(order[: 1 + n // 20]) | set(draw.sample(range(n), min(n, 1 + n // 20)))
    out = Packing([list(packing.bins[k]) for k in range(n) if k not in gone], [packing.free[k] for k in range(n) if k not in gone])
    items = [i for k in sorted(gone) for i in packing.bins[k]]
    items.sort(key=lambda i: -lengths[i] * draw.uniform(0.8, 1.0))
    out.best_fit(items, lengths, capacity)
    return out


def from_numbers(of: list[int], lengths: list[int], capacity: int) -> Packing:
    """The packing in which item i lies in bin ``of[i]``."""
    out = Packing([[] for _ in range(max(of, default=-1) + 1)], [])
    for i, b in enumerate(of):
        out.bins[b].append(i)
    out.free = [capacity - sum(lengths[i] for i in items) for items in out.bins]
    return out


def numbers(packing: Packing, n: int) -> list[int]:
    of = [0] * n
    for b, items in enumerate(packing.bins):
        for i in items:
            of[i] = b
    return of


def fewest_bins(lengths: list[int], capacity: int) -> int:
    """A lower bound: the volume, and the items of which no two fit into one bin."""
    return max(-(-sum(lengths) // capacity), sum(2 * x > capacity for x in lengths))


def evolve(lengths: list[int], seeds: list[list[int]], capacity: int, draw: random.Random,
           children: int = CHILDREN, population: int = POPULATION) -> Packing:
    """The elite of one island after ``children`` births, starting from ``seeds`` (packings as bin numbers)."""
    least = fewest_bins(lengths, capacity)
    rank = lambda p: p.fitness(capacity)
    alive = [from_numbers(of, lengths, capacity) for of in seeds]
    if not alive:
        plain = Packing([], [])
        plain.best_fit(sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)), lengths, capacity)
        alive.append(plain)
    if len(alive[0].bins) <= least:
        return max(alive, key=rank)
    while len(alive) < population:
        blur = Packing([], [])
        blur.best_fit(sorted(range(len(lengths)), key=lambda i: -lengths[i] * draw.uniform(0.7, 1.0)), lengths, capacity)
        alive.append(blur)
    alive.sort(key=rank, reverse=True)
    for _ in range(children):
        if len(alive[0].bins) <= least:
            break
        a, b = draw.sample(alive, 2)
        child = crossover(a, b, lengths, capacity, draw)
        if draw.random() < 0.5:
            child = mutate(child, lengths, capacity, draw)
        alive.append(child)
        alive.sort(key=rank, reverse=True)
        alive.pop()
    return alive[0]


STATE = "block long, island int, keys array<long>, lens array<int>, elite array<int>, bins int, least int"


def _epoch(state: DataFrame, level: int, epoch: int, capacity: int) -> DataFrame:
    """One epoch on every island: rows (block, island, keys, lens, seeds array<array<int>>) to STATE."""
    def run(batches):
        for batch in batches:
            blocks, islands, seeds = (batch.column(c).to_pylist() for c in ("block", "island", "seeds"))
            elites, bins, least = [], [], []
            for k in range(len(batch)):
                lengths = batch.column("lens")[k].as_py()
                draw = random.Random(f"{level}:{epoch}:{blocks[k]}:{islands[k]}")
                best = evolve(lengths, seeds[k] or [], capacity, draw)
                elites.append(numbers(best, len(lengths)))
                bins.append(len(best.bins))
                least.append(fewest_bins(lengths, capacity))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("island"), batch.column("keys"), batch.column("lens"),
                 pa.array(elites, pa.list_(pa.int32())), pa.array(bins, pa.int32()), pa.array(least, pa.int32())],
                names=["block", "island", "keys", "lens", "elite", "bins", "least"])

    return state.select("block", "island", "keys", "lens", "seeds").mapInArrow(run, STATE)


def _pack_level(current: DataFrame, blocks: int, level: int, capacity: int) -> DataFrame:
    """(key, length, sequence_id, offset, free) of every piece of ``current(key, length)``, packed block by block."""
    block = F.pmod(F.xxhash64("key", F.lit(level)), F.lit(blocks).cast("long")).alias("block")
    packed = current.select(block, F.struct(F.col("length").cast("int").alias("n"), "key").alias("item")).groupBy("block").agg(
        F.sort_array(F.collect_list("item"), asc=False).alias("items"))  # about BLOCK pieces, dealt by a hash
    state = packed.select("block", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                          F.col("items.key").alias("keys"), F.col("items.n").alias("lens"),
                          F.lit(None).cast("array<array<int>>").alias("seeds"))
    settled = None
    for epoch in range(EPOCHS):
        dealt = state.repartition("block", "island")
        after = materialise(_epoch(dealt, level, epoch, capacity), "packing-epoch")
        # per block: the elites of its islands (a fixed number)
        met = after.groupBy("block").agg(
            F.first("keys").alias("keys"), F.first("lens").alias("lens"), F.min("bins").alias("bins"), F.first("least").alias("least"),
            F.sort_array(F.collect_list(F.struct("island", "bins", "elite"))).alias("elites"))
        best = F.array_min(F.transform("elites", lambda e: F.struct(e["bins"].alias("bins"), e["island"].alias("island"), e["elite"].alias("elite"))))["elite"]
        done = met if epoch == EPOCHS - 1 else met.filter("bins <= least")
        out = done.select("block", "keys", "lens", best.alias("elite"))
        settled = out if settled is None else settled.union(out)
        if epoch < EPOCHS - 1:
            going = met.filter("bins > least")
            state = going.select("block", F.posexplode("elites").alias("island", "own"), "keys", "lens", "elites").select(
                "block", "island", "keys", "lens",
                F.array(F.col("own.elite"), F.element_at("elites", F.expr(f"(island + {ISLANDS - 1}) % {ISLANDS} + 1"))["elite"]).alias("seeds"))
            if going.isEmpty():
                break

    def place(batches):
        for batch in batches:
            rows = ([], [], [], [], [])
            for keys, lengths, elite in zip(*(batch.column(c).to_pylist() for c in ("keys", "lens", "elite"))):
                found = from_numbers(elite, lengths, capacity)
                for items, free in zip(found.bins, found.free):
                    at, first = 0, min(keys[i] for i in items)
                    for i in items:
                        for column, value in zip(rows, (keys[i], lengths[i], first, at, free)):
                            column.append(value)
                        at += lengths[i]
            yield pa.RecordBatch.from_arrays([pa.array(r, pa.int64()) for r in rows], names=["key", "length", "sequence_id", "offset", "free"])

    return settled.select("keys", "lens", "elite").mapInArrow(place, "key long, length long, sequence_id long, offset long, free long")


def pack_pieces(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, slack: int = SLACK) -> DataFrame:
    """(key, sequence_id, offset) for ``items(key, length)`` with distinct keys and lengths of 1 to ``capacity``."""
    full = items.filter(F.col("length") == capacity).select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    current = items.filter(F.col("length") < capacity)
    n = current.count()
    placed = full
    for level in range(LEVELS):
        if not n:
            break
        blocks = -(-n // block)
        packed = materialise(_pack_level(current, blocks, level, capacity), "packing-level")
        open_bins = F.col("free") > slack
        left = packed.filter(open_bins).count()
        last = blocks == 1 or level == LEVELS - 1 or 2 * left > n
        stays = packed if last else packed.filter(~open_bins)
        placed = placed.union(stays.select("key", "sequence_id", "offset"))
        if last:
            break
        current, n = packed.filter(open_bins).select("key", "length"), left
    return placed


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece of ``docs(doc_id, text)``."""
    pieces = materialise(document_pieces(docs, vocabulary, capacity).withColumn("key", F.monotonically_increasing_id()), "packing-pieces")
    placed = pack_pieces(pieces.select("key", "length"), capacity)
    return pieces.join(placed, "key").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
