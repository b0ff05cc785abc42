"""The registered query of each operator: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator to the whole table with production parameters and
derives the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.llm.common import bucket_of, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_jaccard_join(spark, sf_dir):
    from dimforge.llm.op7_jaccard_join import jaccard_components

    return jaccard_components(table(spark, sf_dir, "documents"))


@query
def op3_decontaminate(spark, sf_dir):
    from dimforge.llm.op3_decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_language_id(spark, sf_dir):
    from dimforge.llm.op6_language_id import language_id

    return language_id(table(spark, sf_dir, "documents"))


@query
def op10_quality(spark, sf_dir):
    from dimforge.llm.op10_quality import learnable, score

    scored = score(table(spark, sf_dir, "documents"), learnable(table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(bucket_of(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op1_quality_rules(spark, sf_dir):
    from dimforge.llm.op1_quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


@query
def op2_mixing(spark, sf_dir):
    from dimforge.llm.op2_mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op5_chat_format(spark, sf_dir):
    from dimforge.llm import op5_chat_format as chat

    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(odd).alias("prompt"), F.lit(odd).alias("response"))
    rows = chat.conversations_from_rows(table(spark, sf_dir, "conversations")).unionByName(extra, allowMissingColumns=True)
    made = chat.format_chat(chat.canonical_turns(rows)).select(
        "conv_id", "formatted", chat.read_back(F.col("formatted")).alias("back"),
        chat.learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select("conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


# The rules the contract names.
URL_RULES = """select * from values
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block') as rules(host, path, verdict)"""


@query
def op9_url_filter(spark, sf_dir):
    from dimforge.llm.op9_url_filter import judge

    return judge(table(spark, sf_dir, "pages"), spark.sql(URL_RULES))


@query
def op4_html_text(spark, sf_dir):
    from dimforge.llm.op4_html_text import extract

    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def _equals(value):
    return lambda x: x == value


@query
def op8_pii(spark, sf_dir):
    from dimforge.llm.op8_pii import KINDS, find_spans, spans_text

    found = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(F.filter(F.col("base_spans.kind"), _equals(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
                        spans_text(F.col("all_spans")).alias("spans"))


@query
def op13_divergence(spark, sf_dir):
    from dimforge.llm.op13_divergence import divergence

    return divergence(table(spark, sf_dir, "documents"))


@query
def op11_centroids(spark, sf_dir):
    from dimforge.llm.op11_centroids import cluster

    return cluster(table(spark, sf_dir, "embeddings"))


@query
def op12_packing(spark, sf_dir):
    from dimforge.llm.op12_packing import pack

    return pack(table(spark, sf_dir, "documents"))
