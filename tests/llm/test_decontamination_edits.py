"""Decontamination against brute-force alignment of every document with every item."""

import random

import numpy as np
import pytest


def brute(docs, items):
    from dimforge.llm.op3_decontaminate import align, content_words

    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = content_words(item), content_words(text)
            if len(a) and len(b):
                score = align(a, b)[0]
                if score >= len(a) and (len(a) != 2 or score > 2):
                    out[(d, i)] = max(score, out.get((d, i), 0))
    return out


def edited(rng, words, rate, kinds="sid"):
    out = []
    for w in words:
        kind = rng.choice(kinds) if rng.random() < rate else ""
        out += {"": [w], "s": [f"e{rng.randrange(10**6)}"], "d": [], "i": [w, f"e{rng.randrange(10**6)}"]}[kind]
    return out


def corpus():
    rng = random.Random(11)
    words = lambda n, v=40: [f"w{rng.randrange(v)}" for _ in range(n)]
    items = [(k, words(n, 4000 if k % 3 else 60)) for k, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 12, 15, 20, 25, 31, 40, 40, 60, 90])]
    docs = [words(rng.randint(0, 150)) for _ in range(30)]
    for _, item in items:
        for rate in (0, 0.1, 0.2, 0.25, 0.3, 0.35, 0.5):
            docs.append(words(rng.randint(0, 60)) + edited(rng, item, rate) + words(rng.randint(0, 60)))
        docs.append(edited(rng, item, 1, "i"))  # a word after every word
        docs.append([w if k % 4 else "x" for k, w in enumerate(item)])  # every fourth word replaced
        docs.append([w if k % 3 else "x" for k, w in enumerate(item)])
    return [(k, " ".join(d)) for k, d in enumerate(docs)], [(k, " ".join(i)) for k, i in items]


def test_every_copy_at_the_ratio_is_found(spark):
    from dimforge.llm.op3_decontaminate import leaks

    docs, items = corpus()
    got = {(r.doc_id, r.item_id): r.score for r in leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute(docs, items)
    assert len(want) > 100 and got == want


def test_several_chunks_give_the_same(spark, monkeypatch):
    from dimforge.llm import op3_decontaminate as o

    docs, items = corpus()
    docs, items = docs[::5], items
    monkeypatch.setattr(o, "CHUNK_WORDS", 150)
    got = {(r.doc_id, r.item_id): r.score for r in o.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items)


def test_null_ids_leak_too(spark):
    from dimforge.llm.op3_decontaminate import leaks

    docs = [(None, "x a b c d e f"), (None, "nothing of it"), (None, "1 2 3 4 5 6 7"), (7, "1 2 3 4 5 6 7")]
    items = [(None, "a b c d e f"), (None, "1 2 3 4 5 6 7"), (3, "a b c d e g")]
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.score) for r in got.collect()} == {(None, None, 14), (None, 3, 10), (7, None, 14)}
    assert got.count() == 3


def test_word_pairs_are_all_pairs_at_distance_one_and_two():
    from dimforge.llm.op3_decontaminate import word_pairs
    from dimforge.llm.textnum import grams

    for n in range(8):
        words = np.arange(1, n + 1, dtype=np.uint64)
        want = sorted((int(grams(words[[i, i + d]], 2)[0]), i) for d in (1, 2) for i in range(n - d))
        assert sorted(zip(*(x.tolist() for x in word_pairs(words)))) == want
