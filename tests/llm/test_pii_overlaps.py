"""Overlapping candidates of op8: the best are taken first, the rest as far as they fit."""

import random

from pyspark.sql import functions as F


def test_best_candidates_are_taken_first(spark):
    from dimforge.llm.op8_pii import best_apart

    rng = random.Random(4)
    chain = [(0, 0, 10, 0.6), (1, 8, 20, 0.7), (2, 18, 30, 0.8)]
    cases = [[], chain, [(k, s, e, 0.9) for k, s, e, _ in chain]]
    for _ in range(60):
        starts = [(rng.randrange(4), rng.randrange(60)) for _ in range(rng.randrange(12))]
        cases.append([(k, s, s + rng.randint(1, 15), rng.choice([0.5, 0.6, 0.9])) for k, s in set(starts)])

    def plain(cands):
        taken = []
        for k, s, e, _ in sorted(cands, key=lambda c: (-c[3], c[0], c[1], c[2])):
            if all(b <= s or e <= a for _, a, b in taken):
                taken.append((k, s, e))
        return sorted(taken)

    rows = spark.createDataFrame(list(enumerate(cases)), "i int, cands array<struct<kind:int,s:int,e:int,p:double>>")
    got = {r.i: sorted(tuple(x) for x in r.t) for r in rows.select("i", best_apart(F.col("cands")).alias("t")).collect()}
    assert got == {i: plain(c) for i, c in enumerate(cases)}
    assert got[1] == [(0, 0, 10), (2, 18, 30)]


def test_chained_candidates_reach_the_spans(spark, monkeypatch):
    """End to end with set scores: the middle of three candidates loses to the last, so the first stays."""
    from dimforge.llm import op8_pii as o

    class Fixed:
        def score(self, f):
            return f["digits"]

        def threshold(self, kind):
            return F.lit(0.0)

    monkeypatch.setattr(o, "train", lambda spark: Fixed())
    none = "array<struct<kind:int,s:int,e:int,f:struct<digits:double>>>"
    made = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(s).alias("s"), F.lit(e).alias("e"), F.struct(F.lit(p).alias("digits")).alias("f"))
                     for k, s, e, p in ((0, 0, 10, 0.6), (1, 8, 20, 0.7), (2, 18, 30, 0.8))]).cast(none)
    monkeypatch.setattr(o, "candidates", lambda text: made)
    rows = spark.createDataFrame([(1, "text with a 1 in it, long enough for the spans")], "doc_id long, text string")
    assert [(x.kind, x.s, x.e) for x in o.find_spans(rows).first().all_spans] == [(0, 0, 10), (2, 18, 30)]
