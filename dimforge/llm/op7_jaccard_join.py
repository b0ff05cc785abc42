"""N-gram Jaccard join by vertical partitioning.

Documents are sets of distinct word shingles (64-bit hashes).  Two documents
link when ``100 * intersection >= 75 * union``.  The global n-gram order is
(seen once, frequency class, hash); it is cut into fragments by hash range, and overlaps
are counted per fragment and summed per pair.

1. Documents with equal sets form one *class*; everything below works on classes.
2. N-gram frequencies over all documents are counted per fragment.  Two tables
   of fixed size come out of it: one bit per slot "seen twice or more", and the
   largest frequency class per slot.  Slots are hash prefixes, so the tables
   only steer order and skip n-grams that cannot match; they never lose a link.
3. Prefix filter: two linked sets share one of their first ``n - ceil(0.75 n) + 1``
   n-grams in the global order.  Those n-grams are the postings.  Two classes can
   share no more than the n-grams that either has in common with any other text, so
   pairs whose sizes or ``common`` counts rule a link out are never compared.
4. Every n-gram has one leading posting, that of the class whose prefix holds the
   most frequent n-grams: near copies differ from their original by rare n-grams,
   so the original leads and its copies link to it.  A class is first compared with one
   class only, the leader that it shares the most n-grams with, so a large group
   of near copies costs one pair per member, however many leaders it has.  Then
   every n-gram's postings are compared with its leader.  Pairs already in one
   component need no comparison.  N-grams whose remaining postings
   still span several components go to another round with the next leader; once
   few pairs are left, all of them across components are compared.
5. A comparison joins the two classes' segments of each fragment, counts partial
   overlaps, and sums them per pair.

Defined results: NULL or blank text has no shingles and links with nothing;
repeated rows stay rows and share a component; a row with a NULL doc_id is a text like
any other, but its id never names a component (a component of such rows only is NULL);
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import SPACE_RUN, bounded_batches, discard, free_name, materialise, membership_bits, with_row_key
from dimforge.llm.textnum import set_id, shingle_set

PERCENT = 75
SHINGLE = 5
SEEN_BITS = 27        # slots of the "seen twice" bitmap: 16 MB
CLASS_BITS = 22       # slots of the frequency-class table: 4 MB
WANTED_BITS = 24      # slots of the "class needs segments" bitmap: 2 MB
FRAGMENT_TOKENS = 1 << 20
FLUSH_TOKENS = 1 << 20
SEGMENTS = 8


def _prefix_length(n: int) -> int:
    return n + (-PERCENT * n // 100) + 1


def _sets(batches: Iterator[pa.RecordBatch], column: int = 0):
    for batch in batches:
        for i, text in enumerate(batch.column(column)):
            yield batch, i, shingle_set(text.as_py(), SHINGLE)


def document_classes(docs: DataFrame, *carry: str) -> DataFrame:
    """(doc_id, n, cls) per row: size and id of its shingle set; ``carry`` columns come along."""
    def run(batches):
        for batch in batches:
            sizes, ids = [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), SHINGLE)
                sizes.append(len(s))
                ids.append(set_id(s))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()), *batch.columns[2:]],
                                              names=["doc_id", "n", "cls", *carry])

    types = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select(F.col("doc_id").cast("long"), "text", *carry).mapInArrow(run, "doc_id long, n long, cls long" + types)


def _frequency_tables(docs: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-size tables over all documents: seen-twice bits and frequency classes."""
    shift, low = np.uint64(64 - bits), np.uint64(32 - bits)

    def emit(parts):
        tokens, counts = np.unique(np.concatenate(parts), return_counts=True)
        fragment = (tokens >> shift).astype(np.int64)
        cuts = np.flatnonzero(np.diff(fragment, prepend=-1))
        rest = ((tokens >> low) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        small = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32)
        ends = np.append(cuts[1:], len(tokens))
        few = small < 255
        rows = [[], [], [], []]
        for a, b in zip(cuts, ends):
            big = np.flatnonzero(~few[a:b]).astype(np.uint32)
            rows[0].append(int(fragment[a]))
            rows[1].append(rest[a:b].tobytes())
            rows[2].append(np.where(few[a:b], small[a:b], 0).astype(np.uint8).tobytes())
            rows[3].append(np.stack([big, small[a:b][big]]).tobytes() if len(big) else b"")
        for k in range(0, len(rows[0]), 64):
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0][k:k + 64], pa.int64()), *(pa.array(r[k:k + 64], pa.binary()) for r in rows[1:])],
                names=["fragment", "tokens", "counts", "large"])

    def local(batches):
        parts, held = [], 0
        for _, _, s in _sets(batches):
            if len(s):
                parts.append(s)
                held += len(s)
            if held >= FLUSH_TOKENS:
                yield from emit(parts)
                parts, held = [], 0
        if parts:
            yield from emit(parts)

    seen_slots, class_slots = 1 << (SEEN_BITS - bits), 1 << (CLASS_BITS - bits)

    def merge(key, group):
        tokens, counts = [], []
        for t, c, g in zip(group.column("tokens"), group.column("counts"), group.column("large")):
            tokens.append(np.frombuffer(t.as_py(), np.uint32))
            c = np.frombuffer(c.as_py(), np.uint8).astype(np.int64)
            if g.as_py():
                where, value = np.frombuffer(g.as_py(), np.uint32).reshape(2, -1)
                c[where] = value
            counts.append(c)
        tokens, counts = np.concatenate(tokens), np.concatenate(counts)
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        total, tokens = np.add.reduceat(counts, first), tokens[first]
        seen = np.zeros(seen_slots, np.uint8)
        seen[tokens[total >= 2] >> np.uint32(32 - SEEN_BITS + bits)] = 1
        level = np.zeros(class_slots, np.uint8)
        often = total >= 8
        np.maximum.at(level, tokens[often] >> np.uint32(32 - CLASS_BITS + bits),
                      np.log2(total[often]).astype(np.uint8))
        return pa.table({"fragment": pa.array([key[0].as_py()], pa.int64()),
                         "seen": pa.array([np.packbits(seen).tobytes()], pa.binary()),
                         "level": pa.array([level.tobytes()], pa.binary())})

    partial = docs.select("text").mapInArrow(local, "fragment long, tokens binary, counts binary, large binary")
    merged = partial.groupBy("fragment").applyInArrow(merge, "fragment long, seen binary, level binary")
    seen = np.zeros((1 << bits, seen_slots // 8), np.uint8)
    level = np.zeros((1 << bits, class_slots), np.uint8)
    for row in merged.collect():  # tables of fixed size, 20 MB in all; one job, so the fragments merge in parallel
        seen[row.fragment] = np.frombuffer(row.seen, np.uint8)
        level[row.fragment] = np.frombuffer(row.level, np.uint8)
    return seen.ravel(), level.ravel()


def _postings(docs: DataFrame, seen: np.ndarray, level: np.ndarray) -> DataFrame:
    """(tok, cls, n, rem, weight): prefix n-grams of every class that occur twice or more anywhere.

    ``rem`` is the number of the class's n-grams from this one on, in the global order, and
    ``weight`` the mean frequency class of its prefix.
    """
    shared = docs.sparkSession.sparkContext.broadcast((seen, level))

    def run(batches):
        seen, level = shared.value
        done = set()
        toks, ids, sizes, rems, weights, held = [], [], [], [], [], 0

        def batch():
            times = [len(t) for t in toks]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(toks).view(np.int64)), pa.array(np.repeat(ids, times)), pa.array(np.repeat(sizes, times)),
                 pa.array(np.concatenate(rems)), pa.array(np.repeat(weights, times))], names=["tok", "cls", "n", "rem", "weight"])

        for _, _, s in _sets(batches):
            if not len(s):
                continue
            cls = set_id(s)
            if cls in done:
                continue
            done.add(cls)
            slot = (s >> np.uint64(64 - SEEN_BITS)).astype(np.int64)
            twice = (seen[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1
            rank = np.where(twice, 1 + level[s >> np.uint64(64 - CLASS_BITS)], 0)
            order = np.argsort(rank, kind="stable")[: _prefix_length(len(s))]  # s is sorted: ties stay by hash
            place = np.flatnonzero(rank[order] > 0)
            head = s[order[place]]
            if len(head):
                toks.append(head)
                ids.append(cls)
                sizes.append(len(s))
                rems.append(len(s) - place)
                weights.append(float(rank[order].mean()))
                held += len(head)
            if held > 100_000:
                yield batch()
                toks, ids, sizes, rems, weights, held = [], [], [], [], [], 0
        if held:
            yield batch()

    return docs.select("text").mapInArrow(run, "tok long, cls long, n long, rem long, weight double")


def _segments(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cls, part, seg): the n-grams per fragment of every class named in ``pairs``."""
    ids = pairs.select(F.col("a").alias("cls")).union(pairs.select("b"))
    wanted = docs.sparkSession.sparkContext.broadcast(membership_bits(ids, WANTED_BITS))

    def run(batches):
        table = wanted.value
        done = set()
        cut = np.arange(1, SEGMENTS, dtype=np.uint64) << np.uint64(64 - SEGMENTS.bit_length() + 1)
        rows, held = ([], [], []), 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()),
                 pa.array(rows[2], pa.list_(pa.int64()))], names=["cls", "part", "seg"])

        for _, _, s in _sets(batches):
            if not len(s):
                continue
            cls = set_id(s)
            slot = (cls & 0xFFFFFFFFFFFFFFFF) >> (64 - WANTED_BITS)
            if cls in done or not (int(table[slot >> 6]) >> (slot & 63)) & 1:
                continue
            done.add(cls)
            for part, seg in enumerate(np.split(s, np.searchsorted(s, cut))):
                if len(seg):
                    rows[0].append(cls)
                    rows[1].append(part)
                    rows[2].append(seg.view(np.int64))
            held += len(s)
            if held > 200_000:
                yield batch()
                rows, held = ([], [], []), 0
        if held:
            yield batch()

    found = docs.select("text").mapInArrow(run, "cls long, part int, seg array<long>")
    return found.groupBy("cls", "part").agg(F.first("seg").alias("seg"))  # copies in other tasks give the same segment


def verified_links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes whose Jaccard similarity reaches the threshold.

    ``pairs`` has (a, na, b, nb); partial overlaps are counted per fragment.
    """
    segs = _segments(docs, pairs)
    by_part = pairs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))))
    left = (by_part.join(segs.select(F.col("cls").alias("b"), "part", F.col("seg").alias("seg_b")), ["b", "part"])
            .join(segs.select(F.col("cls").alias("a"), "part", F.col("seg").alias("seg_a")), ["a", "part"]))
    partial = left.select("a", "na", "b", "nb", F.size(F.array_intersect("seg_a", "seg_b")).cast("long").alias("part_overlap"))
    total = partial.groupBy("a", "na", "b", "nb").agg(F.sum("part_overlap").alias("overlap"))
    return total.filter(100 * F.col("overlap") >= PERCENT * (F.col("na") + F.col("nb") - F.col("overlap"))).select("a", "b")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or hangs on exactly one centre."""
    ends = edges.select(F.col("hi").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("lo", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter(
        "below > 1 or (below = 1 and above = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of ``edges(a, b)``.

    Alternating large-star and small-star steps, written after each, until only
    stars are left; no neighbourhood is ever held in one row.
    """
    both = edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    current = materialise(both.distinct(), "components")
    while not _is_stars(current):
        # large star: every larger neighbour is linked to the smallest of the neighbourhood
        arcs = current.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(current.select("hi", "lo"))
        low = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialise(arcs.join(low, "u").filter("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct(), "components")
        # small star: a node and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(low, "hi").select(F.explode(F.array(
            F.struct(F.col("m").alias("lo"), F.col("hi")), F.struct(F.col("m").alias("lo"), F.col("lo").alias("hi")))).alias("e"))
            .select("e.lo", "e.hi").filter("lo <> hi").distinct())
        after = materialise(small, "components")
        discard(current, large)
        current = after
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("comp")).union(
        current.groupBy(F.col("lo").alias("node")).agg(F.min("lo").alias("comp")))


def _may_link(n_a: str, rem_a: str, n_b: str, rem_b: str) -> str:
    """SQL condition: the sizes, and what both have left from this n-gram on, leave room for the threshold.

    True for a linked pair at its first common n-gram in the global order, since all it shares comes from there on.
    """
    return (f"100 * least({n_a}, {n_b}) >= {PERCENT} * greatest({n_a}, {n_b})"
            f" and {100 + PERCENT} * least({rem_a}, {rem_b}) >= {PERCENT} * ({n_a} + {n_b})")


def _led(posts: DataFrame) -> DataFrame:
    """Postings other than their n-gram's leader, with the leader as ``lead``.

    ``posts`` has (tok, cls, n, rem, weight, comp); only n-grams over two components or more stay.
    """
    leads = (posts.groupBy("tok").agg(F.max(F.struct("weight", "cls", "n", "rem", "comp")).alias("lead"),
                                      F.min("comp").alias("c0"), F.max("comp").alias("c1"))
             .filter("c0 <> c1").select("tok", "lead"))
    return posts.join(leads, "tok").filter("cls <> lead.cls")


def _led_pairs(led: DataFrame) -> DataFrame:
    """Pairs (leader, other) across components that may link, one row per shared n-gram."""
    return (led.filter("comp <> lead.comp and " + _may_link("n", "rem", "lead.n", "lead.rem"))
            .select(F.col("lead.cls").alias("a"), F.col("lead.n").alias("na"), F.col("cls").alias("b"), F.col("n").alias("nb")))


def _first_pairs(posts: DataFrame) -> DataFrame:
    """For every class the pair with the leader that it shares the most n-grams with (ties: the smaller one)."""
    shared = _led_pairs(_led(posts)).groupBy("a", "na", "b", "nb").count()
    best = shared.groupBy("b", "nb").agg(F.max(F.struct("count", -F.col("a"), "a", "na")).alias("best"))
    return best.select("best.a", "best.na", "b", "nb")


def _band(n: str) -> str:
    """SQL: size band; linked sets lie in the same band or in neighbouring ones."""
    return f"int(floor(ln({n}) / ln({100 / PERCENT!r}) + 1e-9))"


def _linkable(rest: DataFrame) -> DataFrame:
    """Postings that may still link with a posting of another component at their n-gram.

    Per n-gram and size band the two smallest sets of different components are enough to tell:
    the smaller the other set, the fewer n-grams a pair needs to share.
    """
    banded = rest.withColumn("band", F.expr(_band("n")))
    # every posting tells its own band and the two beside it how small a partner they may find
    told = (banded.groupBy("tok", "band", "comp").agg(F.min("n").alias("low"), F.max("rem").alias("most"))
            .select("tok", "comp", "low", "most", F.explode(F.expr("array(band - 1, band, band + 1)")).alias("band")))
    per = told.groupBy("tok", "band", "comp").agg(F.min("low").alias("low"), F.max("most").alias("most"))
    first = per.groupBy("tok", "band").agg(F.min(F.struct("low", "comp")).alias("one"), F.max(F.struct("most", "comp")).alias("top"))
    other = (per.join(first, ["tok", "band"])
             .groupBy("tok", "band").agg(F.first("one").alias("one"), F.first("top").alias("top"),
                                         F.min(F.when(F.col("comp") != F.col("one.comp"), F.col("low"))).alias("low2"),
                                         F.max(F.when(F.col("comp") != F.col("top.comp"), F.col("most"))).alias("most2"))
             .filter("low2 is not null"))
    low = "if(comp = one.comp, low2, one.low)"
    most = "if(comp = top.comp, most2, top.most)"
    needed = f"{PERCENT} * (n + greatest({low}, ({PERCENT} * n + 99) div 100))"
    return banded.join(other, ["tok", "band"]).filter(f"{100 + PERCENT} * least(rem, {most}) >= {needed}").select(*rest.columns)


def _cross_pairs(rest: DataFrame, open_toks: DataFrame) -> DataFrame:
    """All pairs of different components that may link, through the rows outside each n-gram's largest component.

    A pair not compared before still has its first common n-gram in ``rest``: a leader's posting
    goes only once the leader's pairs at that n-gram are compared, and no bound rules a link out there.
    """
    y = (rest.select("tok", F.expr(_band("n")).alias("band"), F.struct("cls", "n", "rem").alias("b"), F.col("comp").alias("cb"))
         .join(open_toks.select("tok", "major"), "tok"))
    x = y.filter("cb <> major").select("tok", F.explode(F.expr("array(band - 1, band, band + 1)")).alias("band"),
                                       F.col("b").alias("a"), F.col("cb").alias("ca"))
    near = x.join(y, ["tok", "band"]).filter(
        "ca <> cb and (cb = major or a.cls < b.cls) and " + _may_link("a.n", "a.rem", "b.n", "b.rem"))
    return near.select(F.least("a.cls", "b.cls").alias("a"), F.expr("if(a.cls < b.cls, a.n, b.n)").alias("na"),
                       F.greatest("a.cls", "b.cls").alias("b"), F.expr("if(a.cls < b.cls, b.n, a.n)").alias("nb")).distinct()


def class_components(docs: DataFrame, n_tokens: int) -> DataFrame | None:
    """(node, comp) for every class that has a link."""
    bits = min(20, max(6, int(n_tokens // FRAGMENT_TOKENS).bit_length()))
    rest = materialise(_postings(docs, *_frequency_tables(docs, bits)), "jaccard-postings")
    spent = [rest]
    pairs = compared = materialise(_first_pairs(rest.withColumn("comp", F.col("cls"))), "jaccard-pairs")
    comps = budget = None
    last = False
    while True:
        if not pairs.isEmpty():
            links = materialise(verified_links(docs, pairs), "jaccard-links")
            if not links.isEmpty():
                known = links if comps is None else links.union(comps.select("node", "comp"))
                before, comps = comps, materialise(connected_components(known), "jaccard-comps")
                discard(before)
            discard(links)
        if last:
            return comps
        own = rest.withColumn("comp", F.col("cls")) if comps is None else (
            rest.join(comps.withColumnRenamed("node", "cls"), "cls", "left")
            .select("tok", "cls", "n", "rem", "weight", F.coalesce("comp", "cls").alias("comp")))
        rest = materialise(_linkable(own), "jaccard-rest")
        discard(*spent)
        spent = [rest]
        sizes = rest.groupBy("tok", "comp").count()
        open_toks = materialise(sizes.groupBy("tok").agg(
            F.max_by("comp", "count").alias("major"), F.sum("count").alias("m"), F.max("count").alias("top"))
            .filter("m > top"), "jaccard-open")
        n_rows, cost = open_toks.agg(F.sum("m"), F.sum((F.col("m") - F.col("top")) * F.col("m"))).first()
        if cost is None:
            return comps
        # each leader round allows four times the pairs, so the rounds end
        budget = 4 * budget if budget else 20 * n_rows
        last = cost <= budget
        if last:
            pairs = _cross_pairs(rest, open_toks)
        else:
            led = materialise(_led(rest), "jaccard-led")
            spent.append(led)
            rest, pairs = led.select("tok", "cls", "n", "rem", "weight"), _led_pairs(led).distinct()
        # the first pairs are compared once; later rounds cannot meet a pair again
        first = compared.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
        pairs = materialise(pairs.join(first, (F.least("a", "b") == F.col("x")) & (F.greatest("a", "b") == F.col("y")), "left_anti"),
                            "jaccard-pairs")


def _row_components(docs: DataFrame, *carry: str) -> DataFrame:
    """(doc_id, carry, n_shingles, comp, component_id) per row; ``comp`` tells components apart and is NULL without words."""
    bounded_batches(docs.sparkSession)
    rows = materialise(document_classes(docs, *carry), "jaccard-classes")
    n_tokens = rows.agg(F.sum("n")).first()[0] or 0
    classes = rows.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("low"))
    comps = class_components(docs.select("doc_id", "text"), n_tokens) if n_tokens else None
    if comps is not None:
        members = classes.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        lows = members.groupBy("comp").agg(F.min("low").alias("component_id"))
        classes = members.join(lows, "comp").select("cls", "comp", "component_id")
    else:
        classes = classes.select("cls", F.col("cls").alias("comp"), F.col("low").alias("component_id"))
    return (rows.join(classes.withColumnRenamed("cls", "class_key"), (F.col("cls") == F.col("class_key")) & (F.col("n") > 0), "left")
            .select("doc_id", *carry, F.col("n").alias("n_shingles"), "comp", F.coalesce("component_id", "doc_id").alias("component_id")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest doc_id reachable over links, itself included; NULL ids do not count.
    """
    return _row_components(docs).select("doc_id", "n_shingles", "component_id")


def keep_one_per_component(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, of its smallest doc_id; a NULL id comes after all others.

    Texts without words have no component and all stay, but of equal texts of one doc_id one
    stays.  A NULL id names no document, so of texts without words all such rows stay.
    """
    row = free_name(docs, "jaccard_row")
    keyed = with_row_key(docs, row)
    blank = F.when(F.rlike("text", F.lit(f"^(?:{SPACE_RUN})?$")), F.col("text")).alias("blank")
    found = materialise(_row_components(keyed.select("doc_id", "text", F.col(row).alias("at_row"), blank), "at_row", "blank"), "jaccard-found")
    one = (found.filter("n_shingles > 0").groupBy("comp")
           .agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "at_row")).alias("low")).select("low.at_row"))
    alone = F.when(F.col("doc_id").isNull(), F.col("at_row")).alias("alone")
    wordless = found.filter("n_shingles = 0").groupBy("doc_id", "blank", alone).agg(F.min("at_row").alias("at_row")).select("at_row")
    return keyed.join(one.union(wordless).withColumnRenamed("at_row", row), row, "left_semi").select(*docs.columns)
