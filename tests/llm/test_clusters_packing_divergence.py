"""Centroid clustering, packing and the divergence audit against plain versions, with edge rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

DOCS = "doc_id long, text string, lang string, source string, n long, key string, block string"


def _plain_divergence(rows, min_docs, top):
    groups, in_docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang or "", source or ""].update(words)
        in_docs[lang or ""].update(set(words))
    out = set()
    for lang in {k[0] for k in groups}:
        kept = [t for t, c in in_docs[lang].items() if c >= min_docs]
        v = len(kept)
        counts = {s: {t: c[t] for t in kept} for (x, s), c in groups.items() if x == lang}
        whole = {t: sum(c[t] for c in counts.values()) for t in kept}
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v) for t in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        price = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(sum(price(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            found = [(price(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, values, most in (("pair", pairs, len(pairs)), ("term", found, top)):
                for k, (value, item) in enumerate(sorted(values, key=lambda x: (-x[0], x[1].encode()))[:most]):
                    out.add((lang, s, part, item, value, k + 1))
    return out


def test_divergence_matches_plain_version(spark, monkeypatch):
    from dimforge.llm import op13_divergence as op

    monkeypatch.setattr(op, "SEGMENT", 16)
    monkeypatch.setattr(op, "BLOCK", 3)
    draw = random.Random(5)
    words = ["Été", "été", "straße", "A-b", "x9y", "İ", "ÅNGSTRÖM", *(f"{a}{b}" for a in "abcdefg" for b in "uvwxyz")]
    rows = [(" ".join(draw.choices(words, k=draw.randint(0, 30))), draw.choice(["en", "de"]), draw.choice("ABCDEFGH")) for _ in range(300)]
    rows += [(None, "en", "A"), ("", None, None), ("only once", None, "z"), (None, "fr", "q"), (None, "fr", "r")] + rows[:40]
    df = spark.createDataFrame([(i, t, la, so, 1, "k", "b") for i, (t, la, so) in enumerate(rows)], DOCS)
    got = [tuple(r) for r in op.divergence(df.repartition(5), min_docs=10, top_terms=4).collect()]
    assert len(got) == len(set(got))
    assert set(got) == _plain_divergence(rows, 10, 4)


def test_divergence_trees_price_each_node_pair_once():
    from dimforge.llm.op13_divergence import Trees

    counts = np.array([[3, 0] * 8, [1, 0] * 8])
    trees, seen = Trees(counts), []

    def leaf(x, y):
        seen.append(len(x))
        return (x - y) ** 2

    assert trees.price(0, 1, leaf) == 32
    assert seen == [2]  # 16 terms, two distinct pairs of counts


def test_divergence_of_an_empty_table(spark):
    from dimforge.llm.op13_divergence import divergence

    assert divergence(spark.createDataFrame([], DOCS)).collect() == []


def _plain_clusters(rows, k, rounds):
    kept = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((x for x in kept if x[0] is not None), key=lambda x: (hashlib.sha256(f"2:{x[0]}".encode()).hexdigest(), tuple(x[1])))
    v, c = np.array([x[1] for x in kept]), np.array([x[1] for x in named[:k]])
    near = lambda: (((v[:, None] - c[None]) ** 2).sum(-1))
    for _ in range(rounds):
        label = near().argmin(1)
        c = np.array([[int(s) // int((label == j).sum()) for s in v[label == j].sum(0)] if (label == j).any() else c[j] for j in range(len(c))])
    d = near()
    label, best = d.argmin(1), d.min(1)
    digest = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted((-1 if i is None else i, int(j), int(b), int(best[label == j].sum()), int(best.sum()), digest[j])
                  for (i, _), j, b in zip(kept, label, best))


def test_centroids_match_plain_rounds(spark):
    from dimforge.llm.op11_centroids import cluster

    rng = np.random.default_rng(3)
    hubs = rng.normal(0, 1, (6, 64))
    rows = [(i, [float(x) for x in hubs[i % 6] + rng.normal(0, 0.2, 64)]) for i in range(150)]
    bad = rows[0][1][:]
    bad[5] = float("nan")
    gap = rows[1][1][:]
    gap[7] = None
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, bad), (904, gap), (905, [float("inf")] * 64), (None, rows[3][1]),
             (7, rows[7][1]), (7, rows[8][1]), (906, [0.0] * 64), (907, [0.0] * 64)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, distance int")
    for k, rounds in ((12, 5), (500, 2)):
        wide = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
        got = [tuple(r) for r in cluster(df.repartition(4), k=k, rounds=rounds).collect()]
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == _plain_clusters(wide, k, rounds)


def test_centroids_of_no_vectors(spark):
    from dimforge.llm.op11_centroids import cluster

    assert cluster(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).collect() == []


def test_pivot_bounds_never_exceed_the_distance():
    from dimforge.llm.op11_centroids import Pairs, _to_points, nearest

    rng = np.random.default_rng(1)
    for scale in (1, 300, 1 << 20):
        v = rng.integers(-scale, scale + 1, (400, 64))
        v[:200] = v[:8][rng.integers(0, 8, 200)] + rng.integers(-1, 2, (200, 64))
        c, pivots = v[rng.integers(0, 400, 12)], v[rng.integers(0, 400, 9)]
        pairs, far = Pairs(c, pivots), _to_points(v, pivots)
        exact = ((v[:, None] - c[None]) ** 2).sum(-1)
        assert (pairs.bounds(far) ** 2 <= exact).all()
        label, best, measured = nearest(v, far, c, pairs)
        assert (label == exact.argmin(1)).all() and (best == exact.min(1)).all() and measured <= exact.size


def test_bounds_spare_distances_near_their_pivots():
    from dimforge.llm.op11_centroids import Pairs, _to_points, nearest

    rng = np.random.default_rng(2)
    hubs = rng.integers(-500, 500, (20, 64))
    v = np.repeat(hubs, 30, axis=0) + rng.integers(-20, 21, (600, 64))
    assert nearest(v, _to_points(v, hubs), hubs + 1, Pairs(hubs + 1, hubs))[2] <= 1.1 * len(v)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    from dimforge.llm.op12_packing import default_vocabulary

    return Tokenizer.from_file(default_vocabulary())


def _check_packing(docs, found, tokenizer, capacity):
    """Every id of every document once, pieces cut as stated, sequences gapless and within the capacity."""
    want = Counter()
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want[doc_id, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_of_the_table_is_near_the_bound(spark, sf_dir, tokenizer):
    from dimforge.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_packing"](spark, sf_dir).collect()
    used = _check_packing(docs, found, tokenizer, 4096)
    assert used <= -(-sum(r.length for r in found) // 4096) * 1.01 + 1


def test_packing_edges(spark, tokenizer):
    from dimforge.llm.op12_packing import pack

    odd = "Á H̱! <|endoftext|> x<|startoftext|>y. I'll can't go   \U0001F44D\U0001F3FD 漢字漢字 100% K. " + "\x1c\x0b\x85"
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, odd), (4, odd), (None, "no id"), (None, None), (5, "lang " * 3000), (6, "a" * 5000), (7, "Word word, WORD; word")]
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in docs], "doc_id long, text string, key string, length long, free long")
    _check_packing(docs, pack(df, capacity=64).collect(), tokenizer, 64)
    assert pack(df.filter("false")).collect() == []


def test_levels_pack_what_blocks_leave_open(spark):
    from pyspark.sql import functions as F

    from dimforge.llm.op12_packing import pack_pieces

    draw = random.Random(2)
    lengths = [draw.choice([7, 40, 333, 1300, 2100, 4095, 4096]) for _ in range(3000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "key long, length long")
    placed = pack_pieces(items, block=200).join(items, "key")
    assert placed.count() == 3000
    fills = placed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fills.filter("n > 4096 or n <> end").isEmpty()
    assert fills.count() <= max(-(-sum(lengths) // 4096), sum(x > 2048 for x in lengths)) * 1.02


def test_crossover_keeps_every_item_once():
    from dimforge.llm.op12_packing import Packing, crossover, evolve, mutate, numbers

    draw = random.Random(4)
    lengths = [draw.randint(1, 100) for _ in range(120)]
    a, b = Packing([], []), Packing([], [])
    a.best_fit(range(120), lengths, 100)
    b.best_fit(range(119, -1, -1), lengths, 100)
    for _ in range(30):
        child = mutate(crossover(a, b, lengths, 100, draw), lengths, 100, draw)
        assert sorted(i for x in child.bins for i in x) == list(range(120))
        assert all(sum(lengths[i] for i in x) + f == 100 and f >= 0 for x, f in zip(child.bins, child.free))
        a, b = b, child
    elite = evolve(lengths, [numbers(a, 120)], 100, draw)
    assert len(elite.bins) <= len(a.bins)
