"""Corpus preparation: five stages over ``documents``, each one operator of ``dimforge.llm``.

Every stage reads what its predecessor kept and returns the columns of
``documents`` (the last adds the mix's columns).  Stages run on written tables, in order: a
stage deletes what its predecessor wrote on its way, but never a given table.

A document's row is the unit: rows that repeat a doc_id with the same text are
copies, of which the n-gram stage keeps one.  Rows with a NULL doc_id are documents like any
other; stages that join give each row a key of its own.  Extra columns of the input are dropped.

SQL cannot express the stages (a trained network, alignment, random rounding), so
``ORACLE_SQL`` is None.  Tests cover the near-duplicate and decontamination stages on
rows with NULL ids, and single operators; no test compares a whole stage with a plain version.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm.common import discard, materialise, noted_tables, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def _tidy(docs: DataFrame) -> DataFrame:
    """``docs`` as read, so that rows keep their place in a file; only extra columns cost a projection."""
    return docs if tuple(docs.columns) == COLUMNS else _documents(docs)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects (learned from all labels outside the held-out bucket)."""
    from dimforge.llm.op10_quality import keep_good, learnable

    return keep_good(_documents(docs), learnable(table(spark, sf_dir, "labels")))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, of the smallest doc_id, of each group of near copies; texts without words all stay."""
    from dimforge.llm.op7_jaccard_join import keep_one_per_component

    return keep_one_per_component(_tidy(docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which a benchmark item is found."""
    from dimforge.llm.op3_decontaminate import drop_leaks

    return drop_leaks(_tidy(docs), table(spark, sf_dir, "benchmark"))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; n_chars is counted anew."""
    from dimforge.llm.op8_pii import redact

    return redact(_documents(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with size, source_size, target, copies and taken."""
    from dimforge.llm.op2_mixing import mix_documents

    return mix_documents(_tidy(docs))


# Tables that the last stage run for a folder wrote on its way, by session and folder.
_behind: dict[tuple[str, str], list[DataFrame]] = {}


def _in_order(first: bool, stage):
    """``stage``, deleting on entry the tables its predecessor wrote on its way.

    A stage's ``docs`` are its predecessor's written rows, so nothing reads those tables any more.  The
    first stage deletes none: the last one's rows may still be read.
    """
    @functools.wraps(stage)
    def run_stage(spark, docs, sf_dir):
        key = (spark.sparkContext.applicationId, sf_dir)
        behind = _behind.pop(key, [])
        if not first:
            discard(*behind)
        with noted_tables() as mine:
            out = stage(spark, docs, sf_dir)
        _behind[key] = mine
        return out

    return run_stage


STAGES = [(name, _in_order(k == 0, stage)) for k, (name, stage) in enumerate([
    ("quality", quality_stage),
    ("near_duplicates", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("privacy", privacy_stage),
    ("mixing", mixing_stage),
])]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = before = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, before, sf_dir), f"pipeline-{name}")
        discard(before)  # the stage's own input; a given table is not ours to delete
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
