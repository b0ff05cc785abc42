r"""Chat formatting: schema fingerprints select declarative mappings to canonical turns.

A row's fingerprint is the hash of the nested field paths that it carries (a column
that is NULL carries none).  ``LAYOUTS`` maps path sets to expressions that give an
array of (role, text); a row whose fingerprint matches no layout gets NULL turns.

Template: ``<|im_start|>ROLE<|sep|>TEXT<|im_end|>\n`` per turn.  Inside roles and texts
a backslash is doubled and ``<|`` becomes ``<\|``, so no text can hold a marker, and
``unescape`` gives back the exact text.  The loss mask is a list of (start, length)
spans of the formatted string, one per assistant text.

Everything is built-in column functions.

Defined results: NULL roles and texts count as empty; turns with equal numbers are
ordered by role, then text; repeated rows are turns of their own; a conversation id of
NULL is an id like any other; extra columns are ignored unless a layout names them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimforge.llm.common import let

START, SEP, END = "<|im_start|>", "<|sep|>", "<|im_end|>\n"


def _turn(role, text) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


@dataclass(frozen=True)
class Layout:
    """A set of nested field paths and the expression that turns such a row into turns."""

    paths: tuple[str, ...]
    turns: Callable[[], Column]


def _renamed(role: Column) -> Column:
    return F.when(role == "human", "user").when(role == "gpt", "assistant").otherwise(role)


LAYOUTS = {
    "prompt": Layout(("prompt", "response"), lambda: F.array(
        _turn(F.lit("user"), F.col("prompt")), _turn(F.lit("assistant"), F.col("response")))),
    "instruction": Layout(("instruction", "output"), lambda: F.array(
        _turn(F.lit("user"), F.col("instruction")), _turn(F.lit("assistant"), F.col("output")))),
    "instruction_input": Layout(("input", "instruction", "output"), lambda: F.array(
        _turn(F.lit("user"), F.concat_ws("\n\n", "instruction", "input")), _turn(F.lit("assistant"), F.col("output")))),
    "messages": Layout(("messages", "messages[].content", "messages[].role"), lambda: F.transform(
        "messages", lambda m: _turn(m["role"], m["content"]))),
    "shared": Layout(("conversations", "conversations[].from", "conversations[].value"), lambda: F.transform(
        "conversations", lambda m: _turn(_renamed(m["from"]), m["value"]))),
    "turns": Layout(("turns", "turns[].role", "turns[].text", "turns[].turn"), lambda: F.transform(
        F.sort_array("turns"), lambda m: _turn(m["role"], m["text"]))),
}


def field_paths(kind: T.DataType, at: str) -> list[str]:
    """Nested paths of a column: ``a``, ``a.b`` for structs, ``a[].b`` for arrays of structs."""
    out = [at]
    inner, mark = (kind.elementType, "[]") if isinstance(kind, T.ArrayType) else (kind, "")
    if isinstance(inner, T.StructType):
        for f in inner.fields:
            out += field_paths(f.dataType, f"{at}{mark}.{f.name}")
    return out


def _hash_of(paths) -> Column:
    return F.xxhash64(F.lit("\n".join(sorted(paths))))


def fingerprint(df: DataFrame, ignore=("conv_id",)) -> Column:
    """Hash of the sorted field paths that a row of ``df`` carries."""
    known = {p for layout in LAYOUTS.values() for p in layout.paths}
    parts = []
    for f in df.schema.fields:
        if f.name not in ignore and f.name in known:
            parts += [(p, F.col(f.name).isNotNull()) for p in field_paths(f.dataType, f.name)]
    return F.xxhash64(F.concat_ws("\n", *[F.when(there, F.lit(p)) for p, there in sorted(parts, key=lambda x: x[0])]))


def canonical_turns(df: DataFrame, ignore=("conv_id",)) -> DataFrame:
    """``df`` with ``layout`` and ``canonical`` (array of role, text) chosen by fingerprint."""
    have = {p for f in df.schema.fields for p in field_paths(f.dataType, f.name)}
    usable = {name: x for name, x in LAYOUTS.items() if set(x.paths) <= have}
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    for name, x in usable.items():
        match = F.col("schema_fingerprint") == _hash_of(x.paths)
        layout, turns = F.when(match, name).otherwise(layout), F.when(match, x.turns()).otherwise(turns)
    return df.withColumn("schema_fingerprint", fingerprint(df, ignore)).withColumn("layout", layout).withColumn("canonical", turns)


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_chat(df: DataFrame) -> DataFrame:
    """``df`` (with ``canonical``) plus ``formatted`` and ``loss`` (spans, 1-based start and length)."""
    parts = F.transform("canonical", lambda t: F.struct(
        F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == "assistant").alias("learn")))
    span = "struct<start:int,length:int>"

    def step(s, p):
        here = s["at"] + F.length(p["head"])
        size = F.length(p["body"])
        grown = F.concat(s["spans"], F.array(F.struct(here.alias("start"), size.alias("length"))))
        return F.struct((here + size + len(END)).alias("at"), F.when(p["learn"], grown).otherwise(s["spans"]).alias("spans"))

    zero = F.struct(F.lit(1).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))
    made = let(parts, lambda ps: F.struct(
        F.array_join(F.transform(ps, lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.aggregate(ps, zero, step)["spans"].alias("loss")))
    return (df.withColumn("made", F.when(F.col("canonical").isNotNull(), made))
            .withColumn("formatted", F.col("made.formatted")).withColumn("loss", F.col("made.loss")).drop("made"))


def read_back(formatted: Column) -> Column:
    """Turns (role, text) parsed from a formatted string."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.transform(F.filter(pieces, lambda p: F.startswith(p, F.lit(START))), lambda p: _turn(
        unescape(F.substring_index(F.substr(p, F.lit(len(START) + 1)), SEP, 1)),
        unescape(F.substr(p, F.locate(SEP, p) + len(SEP)))))


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"], s["length"]))), "")


def conversations_from_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turns) from one row per turn; a conversation is one output row."""
    return rows.groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", "text")).alias("turns"))
