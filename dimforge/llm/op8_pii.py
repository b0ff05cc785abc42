"""Personal data: candidate spans, boosted trees, calibrated thresholds, redaction.

Base rules find emails, addresses, cards and phones by pattern and check; those spans
always stay.  High-recall generators propose further, overlapping candidates of the same
kinds (spelled-out emails, cards with unusual groups or a typing error, phones without
a plus, spaced addresses).  Boosted trees score each candidate by format and context
features; a threshold per kind, calibrated on generated examples that the trees did not
see, selects spans.  A selected span that overlaps a base span goes; the others are taken by
falling score (of equal scores the first kind, then the first start), each unless it
overlaps one taken before.

The trees are trained by Spark's gradient-boosted trees on a bounded generated set and
then written as CASE expressions, so the main path is built-in column functions only.

Positions are code points from 0, end exclusive.  Defined results: NULL text counts as
empty and has no spans; repeated rows stay rows; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm.common import let

KINDS = ("email", "ip", "card", "phone")
SPAN = "struct<kind:int,s:int,e:int>"
EXAMPLES = 6000
TREES, DEPTH, RATE = 12, 3, 0.4
PRECISION = 0.98
CONTEXT = 24

# The contract's patterns.  Lookbehinds and possessive quantifiers only stop the
# engine from trying starts that cannot match; the leftmost matches are the same.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A part of zeros only must still match, so the leading zeros give back a digit.
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# Wider patterns of the generators.
WIDE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+(?:\x20?(?:@|\(at\)|\[at\])\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63}+)+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\x20?\.\x20?[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]?[0-9]){12,18}+(?![0-9])",
    "phone": r"(?<![0-9+(])[(+]?[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}+(?![0-9])",
}
FEATURES = ("kind", "digits", "length", "separators", "groups", "luhn", "octets", "plus", "paren", "first", "cue", "glued", "at_sign")
CUES = r"(?i)(?:call|phone|tel|fax|mobile|cell|dial|card|visa|credit|account|mail|contact|write|reach|host|server|address)[^A-Za-z]*+(?:[A-Za-z]+[^A-Za-z]*+){0,2}$"


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost matches as an array of (s, e, m), from the gaps between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

    def step(gaps):
        def add(acc, x):
            start = acc["at"] + F.get(gaps, x["k"])
            end = start + F.length(x["m"])
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("s"), end.alias("e"), x["m"].alias("m")))).alias("out"))
        return add

    return let(F.struct(found.alias("f"), gaps.alias("g")), lambda b: F.aggregate(
        F.transform(b["f"], lambda m, k: F.struct(m.alias("m"), k.alias("k"))), zero, step(b["g"]))["out"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of up to 32 digits passes the Luhn check."""
    def total(d):
        values = F.transform(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), lambda i: F.when(
            (F.length(d) - i) % 2 == 0, F.ascii(F.substr(d, i, F.lit(1))) - 48).otherwise(
            ((F.ascii(F.substr(d, i, F.lit(1))) - 48) * 2 - F.when(F.substr(d, i, F.lit(1)) >= "5", 9).otherwise(0))))
        return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0

    return let(digits, lambda d: F.when(F.length(d).between(1, 32), total(d)).otherwise(False))


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.rlike(m, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    n = F.length(_digits(m))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(m))).otherwise(False)
    return n.between(8, 15)


# What a text must hold for a kind to be possible at all.
def _possible(kind: str, text: Column, wide: bool) -> Column:
    digit = F.rlike(text, F.lit("[0-9]"))
    if kind == "email":
        mark = F.contains(text, F.lit("@"))
        return mark | F.rlike(text, F.lit(r"\(at\)|\[at\]|\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20|\x20?[(\[]dot|\.[A-Za-z0-9])")) if wide else mark
    if kind == "phone" and not wide:
        return F.contains(text, F.lit("+"))
    return digit


def base_spans(text: Column) -> Column:
    """array<(kind, s, e)> of the base rules, by kind, then start."""
    none = F.array().cast(f"array<{SPAN}>")
    parts = []

    def spans(k, kind):
        good = F.filter(_matches(text, BASE[kind]), lambda x: _valid(kind, x["m"]))
        return F.transform(good, lambda x: F.struct(F.lit(k).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))

    for k, kind in enumerate(KINDS):
        parts.append(F.when(_possible(kind, text, False), spans(k, kind)).otherwise(none))
    return F.concat(*parts)


def _features(kind: Column, m: Column, before: Column, after: Column) -> Column:
    """Format and context features of a candidate, as a struct of doubles."""
    d = _digits(m)
    num = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    octets = F.rlike(F.translate(m, " ", ""), F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    return F.struct(*[num(v).alias(n) for n, v in zip(FEATURES, (
        kind, F.length(d), F.length(m), F.length(F.regexp_replace(m, "[A-Za-z0-9]+", "")),
        F.length(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "0"), "[^0]+", "")),
        _luhn(d).cast("int"), octets.cast("int"), F.startswith(m, F.lit("+")).cast("int"), F.contains(m, F.lit("(")).cast("int"),
        F.when(F.length(d) > 0, F.ascii(d) - 48).otherwise(-1), F.rlike(before, F.lit(CUES)).cast("int"),
        (F.rlike(before, F.lit(r"[\p{L}0-9_]$")) | F.rlike(after, F.lit(r"^[\p{L}0-9_]"))).cast("int"),
        F.rlike(m, F.lit(r"@|(?i)[(\[ ]at[)\] ]")).cast("int")))])


def candidates(text: Column) -> Column:
    """array<(kind, s, e, features)> of all generators; spans of different kinds may overlap."""
    none = F.array().cast(f"array<struct<kind:int,s:int,e:int,f:struct<{','.join(f'{n}:double' for n in FEATURES)}>>>")
    parts = []

    def made(k, kind):
        return F.transform(_matches(text, WIDE[kind]), lambda x: F.struct(
            F.lit(k).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), _features(
                F.lit(k), x["m"], F.substr(text, F.greatest(x["s"] - CONTEXT, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT))),
                F.substr(text, x["e"] + 1, F.lit(2))).alias("f")))

    for k, kind in enumerate(KINDS):
        parts.append(F.when(_possible(kind, text, True), made(k, kind)).otherwise(none))
    return F.concat(*parts)


def _examples(spark: SparkSession) -> DataFrame:
    """Generated labelled candidates: (kind, m, before, after, y, calibrate)."""
    # positions of x become digits drawn by hash; each format: kind, text, 1 for personal data
    formats = [
        (0, "anna.xx at mailx dot example dot com", 1), (0, "jo.x (at) mail.example.com", 1), (0, "kim.xx [at] example [dot] org", 1),
        (0, "ab@cd.ef", 1), (0, "looked at x dot points", 0), (0, "sat at home dot and", 0), (0, "was at the.end", 0),
        (1, "1x.1xx.2x.1x", 1), (1, "10 . 1x . 2x . x", 1), (1, "8xx.9xx.3x.xx", 0), (1, "7xx.x.x.5xx", 0),
        (2, "4xxx xxxx xxxx xxxL", 1), (2, "5xxx.xxxx.xxxx.xxxL", 1), (2, "4xxx/xxxx/xxxx/xxxL", 1), (2, "3xxx xxxxxx xxxxL", 1), (2, "6xxxxxxxxxxxxxxL", 1),
        (2, "1xxxxxxxxxxxxxxN", 0), (2, "9xxx xxxx xxxx xxxN", 0), (2, "20xx-xx-xx xx.xx.xN", 0), (2, "8xxxxxxxxxxxxN", 0),
        (3, "(xxx) 555-xxxx", 1), (3, "xxx-555-xxxx", 1), (3, "1 (xxx) 555-xxxx", 1), (3, "0xx xxxx xxxx", 1), (3, "xxx.555.xxxx", 1),
        (3, "20xx-0x-1x", 0), (3, "xxxxxxxx", 0), (3, "1xxxxxxxxxxx", 0), (3, "1x.xx.xx.xx", 0), (3, "x/xx/20xx", 0), (3, "4xxxxxxxxxxxxx", 0),
    ]
    values = ", ".join(f"({i}, {k}, '{t}', {y})" for i, (k, t, y) in enumerate(formats))
    texts = spark.sql(f"select * from values {values} as f(form, kind, pattern, y)")
    ids = spark.range(EXAMPLES).withColumn("form", (F.col("id") % len(formats)).cast("int"))
    draw = lambda *k: F.pmod(F.xxhash64("id", *[F.lit(v) if isinstance(v, int) else v for v in k]), F.lit(10)).cast("int")
    rows = ids.join(F.broadcast(texts), "form")
    chars = F.transform(F.filter(F.split("pattern", ""), lambda c: c != ""), lambda c, i: F.when(c == "x", draw(i).cast("string")).otherwise(c))
    rows = rows.withColumn("filled", F.array_join(chars, ""))
    # a final L becomes the check digit that passes, N one that fails
    options = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda v: F.struct(v.alias("v"), _luhn(
        F.concat(_digits(F.regexp_replace("filled", "[LN]$", "")), v.cast("string"))).alias("ok")))
    check = F.filter(options, lambda o: o["ok"])[0]["v"]
    last = F.when(F.endswith("filled", F.lit("L")), check).otherwise((check + 1 + draw(77) % 9) % 10)
    closing = F.rlike("filled", F.lit("[0-9][LN]$"))
    rows = rows.withColumn("m", F.when(closing, F.concat(F.regexp_replace("filled", "[LN]$", ""), last.cast("string"))).otherwise(F.col("filled")))
    cues = F.array(*[F.lit(c) for c in ("call me at ", "phone: ", "my card is ", "mail to ", "please write ", "server ")])
    plain = F.array(*[F.lit(c) for c in ("the value of ", "order no ", "seen in ", "", "of the ", "version ", "dated ")])
    cue = F.when(F.col("y") == 1, draw(91) < 5).otherwise(draw(91) < 1)
    before = F.when(cue, F.element_at(cues, (draw(92) % 6 + 1))).otherwise(F.element_at(plain, (draw(93) % 7 + 1)))
    after = F.when((F.col("y") == 0) & (draw(94) < 2), "a9").otherwise(" a")
    return rows.select("id", "kind", "m", before.alias("before"), after.alias("after"), "y", (F.xxhash64("id", F.lit(5)) % 4 == 0).alias("calibrate"))


def _tree_column(text: str, field) -> Column:
    """A CASE expression from a printed regression tree; ``field(i)`` is feature i."""
    lines = [x.strip() for x in text.splitlines() if x.strip() and not x.strip().startswith(("Tree", "DecisionTree"))]
    at = 0

    def node() -> Column:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return F.lit(float(line.split(":")[1]))
        i, value = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        low = node()
        at += 1  # the matching Else
        return F.when(field(int(i)) <= float(value), low).otherwise(node())

    return node()


class Scorer:
    """Trees as expressions, and the calibrated threshold of each kind."""

    def __init__(self, trees: list[tuple[float, str]], thresholds: list[float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, f: Column) -> Column:
        total = F.lit(0.0)
        for weight, text in self.trees:
            total = total + _tree_column(text, lambda i: f[FEATURES[i]]) * weight
        return 1 / (1 + F.exp(-2 * total))

    def threshold(self, kind: Column) -> Column:
        return F.element_at(F.array(*[F.lit(t) for t in self.thresholds]), kind + 1)


_trained: dict[str, Scorer] = {}


def train(spark: SparkSession) -> Scorer:
    """Boosted trees on generated examples; per kind the least threshold with enough precision."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    app = spark.sparkContext.applicationId
    if app in _trained:
        return _trained[app]
    rows = _examples(spark).select("y", "calibrate", "kind", _features(F.col("kind"), F.col("m"), F.col("before"), F.col("after")).alias("f"))
    flat = rows.select("y", "calibrate", "kind", "f", *[F.col(f"f.{n}").alias(f"x_{n}") for n in FEATURES]).coalesce(1).cache()
    ready = VectorAssembler(inputCols=[f"x_{n}" for n in FEATURES], outputCol="x").transform(flat)
    model = GBTClassifier(featuresCol="x", labelCol="y", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, maxBins=24, seed=8).fit(ready.filter("not calibrate"))
    scorer = Scorer([(float(w), t.toDebugString) for w, t in zip(model.treeWeights, model.trees)], [1.0] * len(KINDS))
    cuts = [0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99]
    scored = flat.filter("calibrate").select("kind", "y", scorer.score(F.col("f")).alias("p"))
    kept = scored.groupBy("kind").agg(*[F.expr(f"sum(if(p >= {c}, y, 0)) / nullif(count_if(p >= {c}), 0)").alias(f"c{i}") for i, c in enumerate(cuts)])
    for r in kept.collect():
        good = [c for i, c in enumerate(cuts) if r[f"c{i}"] is not None and float(r[f"c{i}"]) >= PRECISION]
        scorer.thresholds[r.kind] = min(good, default=1.01)
    flat.unpersist()
    _trained.clear()
    _trained[app] = scorer
    return scorer


def best_apart(cands: Column) -> Column:
    """array<(kind, s, e)>: the candidates taken by falling score, each unless it overlaps one taken before."""
    ranked = F.sort_array(F.transform(cands, lambda c: F.struct(
        F.negative(c["p"]).alias("low"), c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"))))
    add = lambda taken, c: F.when(F.exists(taken, lambda o: (o["s"] < c["e"]) & (c["s"] < o["e"])), taken).otherwise(
        F.concat(taken, F.array(F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e")))))
    return F.aggregate(ranked, F.array().cast(f"array<{SPAN}>"), add)


def find_spans(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``base_spans`` and ``all_spans`` (arrays of kind, s, e, by kind, then start)."""
    scorer = train(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))

    def chosen(base, cands):
        scored = F.transform(cands, lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"), scorer.score(c["f"]).alias("p")))
        apart = F.filter(scored, lambda c: (c["p"] >= scorer.threshold(c["kind"])) & ~F.exists(base, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
        return best_apart(apart)

    # texts without a digit, an @ or a spelled-out "at" skip every pattern
    some = F.rlike(text, F.lit("[0-9@]|[(\\[ ]at[)\\] ]"))
    none = F.array().cast(f"array<{SPAN}>")
    both = F.when(some, let(F.struct(base_spans(text).alias("b"), candidates(text).alias("c")), lambda x: F.struct(
        x["b"].alias("base"), F.sort_array(F.concat(x["b"], chosen(x["b"], x["c"]))).alias("every")))).otherwise(
        F.struct(none.alias("base"), none.alias("every")))
    return (docs.withColumn("found_spans", both).withColumn("base_spans", F.col("found_spans.base"))
            .withColumn("all_spans", F.col("found_spans.every")).drop("found_spans"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"], x["e"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """Text with every span replaced by ``[KIND]``; overlapping spans are replaced once, by the first."""
    names = F.array(*[F.lit(k.upper()) for k in KINDS])
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    by_start = F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    put = lambda a, x: F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] < a["at"], a["out"]).otherwise(F.concat(
        a["out"], F.substr(text, a["at"] + 1, x["s"] - a["at"]), F.lit("["), F.element_at(names, x["kind"] + 1), F.lit("]"))).alias("out"))
    return let(F.aggregate(by_start, zero, put), lambda r: F.concat(r["out"], F.substr(text, r["at"] + 1, F.length(text))))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced in ``text``; NULL texts stay NULL."""
    found = find_spans(docs)
    clean = F.when(F.size("all_spans") > 0, redacted(F.col("text"), F.col("all_spans"))).otherwise(F.col("text"))
    return found.withColumn("text", clean).drop("base_spans", "all_spans")
