"""Quality rules as a short-circuit cascade.

``text_statistics`` computes counts of every whole text in one projection.  A rule
is a predicate over such counts; a document is kept when no rule rejects it.
``order_rules`` measures each rule on a sample: its rejection rate and its cost
(time over the sample).  Rules then run in the order of rejections per cost, each
only on the documents that all earlier rules passed (a nested CASE).  The order
changes the work, never the verdict.

Everything is built-in column functions.

Defined results: NULL text counts as empty and has no words; it fails the base rule
on length; repeated rows stay rows; extra columns are ignored.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import SPACES, let, materialise, word_array

SAMPLE_ROWS = 2000
WINDOW = 8
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over ``text`` and the columns of ``text_statistics``."""

    name: str
    rejects: str


# Shares of words or characters beyond which a text is not prose.
RULES = (
    Rule("symbol_heavy", "10 * n_symbols > word_chars"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("duplicate_lines", "n_dup_lines > 0.5 * (1 + length(text) - length(translate(text, '\\n', '')))"),
    Rule("few_letters", "2 * length(regexp_replace(text, '[^\\\\p{L}]+', '')) < word_chars"),
    Rule("mostly_capitals", "2 * length(regexp_replace(text, '[^\\\\p{Lu}]+', '')) > word_chars"),
)


def _repeat_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in the text."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(hashes, lambda h: F.transform(
        F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
    counted = let(windows, lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0).cast("long")).otherwise(_covered(x)))
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(counted)


def _covered(windows: Column) -> Column:
    """Length of the union of the windows whose hash occurs twice or more."""
    ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    at = let(ordered, lambda o: F.filter(
        F.transform(o, lambda e, k: F.when((k > 0) & (F.get(o, k - 1)["h"] == e["h"]) | (F.get(o, k + 1)["h"] == e["h"]), e["i"])),
        lambda i: i.isNotNull()))
    return let(F.sort_array(at), lambda a: F.aggregate(
        F.transform(a, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(a, k + 1) - i, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda s, g: s + g))


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) per row of ``docs(doc_id, text)``."""
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
            .withColumn("words", word_array(text)).withColumn("lines", lines)
            .select("doc_id", "text", F.size("words").cast("long").alias("n_words"),
                    F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
                    (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                    (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                    _repeat_words(F.col("words")).alias("n_repeat_words")))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def order_rules(docs: DataFrame, rules=RULES) -> list[Rule]:
    """Rules by rejections per second on a sample of about SAMPLE_ROWS rows."""
    share = min(1.0, SAMPLE_ROWS / max(1, docs.count()))
    drawn = docs.filter(F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long"), F.lit(1)), 11) / float(1 << 53) < share)
    sample = materialise(text_statistics(drawn), "rules-sample")
    sample.agg(F.count("*")).first()
    ranked = []
    for rule in rules:
        began = time.perf_counter()
        total, rejected = sample.agg(F.count("*"), F.count_if(F.expr(rule.rejects))).first()
        cost = time.perf_counter() - began
        ranked.append((-(rejected / max(1, total)) / cost, len(ranked), rule))
    return [r for _, _, r in sorted(ranked, key=lambda x: x[:2])]


def cascade(rules: list[Rule]) -> Column:
    """True unless a rule rejects; later rules are evaluated only where earlier ones passed."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(F.coalesce(F.expr(rule.rejects), F.lit(False)), F.lit(False)).otherwise(verdict)
    return verdict


def quality_rules(docs: DataFrame, rules=RULES) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row of ``docs(doc_id, text)``."""
    ordered = order_rules(docs.select("doc_id", "text"), rules)
    stats = text_statistics(docs).withColumn("base_failed", base_failed())
    return stats.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(cascade(ordered))).drop("text")
