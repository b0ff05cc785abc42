"""Language identification by hierarchical discrimination.

A document becomes the square roots of its hashed letter n-gram frequencies
(bytes, lengths 2 and 3, word ends marked), scaled to unit length.  One linear
support vector machine per family picks the family; inside it, one machine per
pair of languages votes, margins breaking ties.

Training uses at most about ``PER_LANGUAGE`` labelled documents per language,
drawn by a hash of the id; prediction reads every whole text.

Defined results: NULL text or text without a letter gives ``und`` with score 0,
as does a corpus without labels; repeated rows stay rows; extra columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import bounded_batches, bucket_of

PER_LANGUAGE = 500
SLOTS = 4096

# Language families of common ISO 639-1 codes.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk pl cs sk bg sr hr sl mk be",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz",
    "indic": "hi bn mr ne ur pa gu",
    "semitic": "ar he am mt",
}
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed 2- and 3-byte n-grams of the letter runs of a text."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    inside = _LETTER[raw]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # one mark after each run
    codes = np.where(inside, raw, 32)[keep].astype(np.uint32)
    codes = np.concatenate(([np.uint32(32)], codes)).astype(np.uint32)
    if len(codes) < 3:
        return np.zeros(SLOTS, np.int64)
    two = codes[:-1] * np.uint32(256) + codes[1:]
    three = two[:-1] * np.uint32(256) + codes[2:]
    grams = np.concatenate((two, three | np.uint32(1 << 25)))
    return np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=SLOTS)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Unit-length square roots, row-wise."""
    x = np.sqrt(counts.astype(np.float32))
    return x / np.maximum(np.sqrt((x * x).sum(-1, keepdims=True)), 1e-9)


def train_svm(x: np.ndarray, y: np.ndarray, reg: float = 1e-3, steps: int = 150) -> np.ndarray:
    """Weights (bias last) of a linear squared-hinge machine, balanced classes, y in -1/+1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    w = np.zeros(x.shape[1], x.dtype)
    ahead, rate = w.copy(), 0.25
    for t in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        step = ahead - rate * (reg * ahead - 2 * ((share * y * slack) @ x))
        ahead, w = step + t / (t + 3) * (step - w), step
    return w


def _families(langs: list[str], centres: np.ndarray) -> list[str]:
    known = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
    out = [known.get(x.lower().split("-")[0]) for x in langs]
    named = [i for i, f in enumerate(out) if f]
    for i, f in enumerate(out):
        if not f:  # an unknown code joins the family of the most similar known language
            out[i] = out[max(named, key=lambda j: float(centres[i] @ centres[j]))] if named else "other"
    return out


def train(counts: np.ndarray, labels: list[str]) -> dict:
    """Family machines and pairwise machines from n-gram counts and labels."""
    langs = sorted(set(labels))
    if not langs:
        return {"langs": []}
    x, at = scaled(counts), np.array([langs.index(v) for v in labels])
    family = _families(langs, scaled(np.stack([x[at == i].mean(0) for i in range(len(langs))]) ** 2))
    names = sorted(set(family))
    of = np.array([names.index(f) for f in family])
    tops = np.stack([train_svm(x, np.where(of[at] == f, 1.0, -1.0).astype(np.float32)) for f in range(len(names))]) if len(names) > 1 else None
    pairs = {}
    for f in range(len(names)):
        for i, j in combinations([k for k in range(len(langs)) if of[k] == f], 2):
            rows = (at == i) | (at == j)
            pairs[i, j] = train_svm(x[rows], np.where(at[rows] == i, 1.0, -1.0).astype(np.float32))
    return {"langs": langs, "of": of, "tops": tops, "pairs": pairs}


def _squash(margin: float) -> float:
    return 1 / (1 + np.exp(-3.0 * np.clip(margin, -20, 20)))


def predict(model: dict, x: np.ndarray) -> tuple[str, float]:
    """Language and score of one scaled n-gram vector."""
    score, f = 1.0, 0
    if model["tops"] is not None:
        margins = model["tops"][:, :-1] @ x + model["tops"][:, -1]
        f = int(margins.argmax())
        score *= _squash(margins[f])
    inside = [k for k in range(len(model["langs"])) if model["of"][k] == f]
    votes = {k: [0, 0.0] for k in inside}
    for i, j in combinations(inside, 2):
        w = model["pairs"][i, j]
        m = float(w[:-1] @ x + w[-1])
        win, lose = (i, j) if m >= 0 else (j, i)
        votes[win][0] += 1
        votes[win][1] += abs(m)
        votes[lose][1] -= abs(m)
    best = max(inside, key=lambda k: (votes[k][0], votes[k][1], -k))
    if len(inside) > 1:
        score *= _squash(votes[best][1] / (len(inside) - 1))
    return model["langs"][best], float(score)


def fit(labelled: DataFrame) -> dict:
    """Model from ``labelled(doc_id, text, lang)``: about PER_LANGUAGE rows of each language."""
    counts = {r.lang: r["count"] for r in labelled.filter("lang is not null").groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return train(np.zeros((0, SLOTS)), [])
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(6)), 11) / float(1 << 53)
    limit = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, PER_LANGUAGE / counts[k]))])
    rows = labelled.filter("lang is not null").filter(draw < F.element_at(limit, F.col("lang"))).select("lang", "text")

    def run(batches):
        for batch in batches:
            kept = [(v.as_py(), t.as_py()) for v, t in zip(batch.column(0), batch.column(1))]
            kept = [(v, ngram_counts(t).astype(np.float32).tobytes()) for v, t in kept if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([v for v, _ in kept], pa.string()), pa.array([c for _, c in kept], pa.binary())],
                                             names=["lang", "counts"])

    got = sorted((r.lang, bytes(r.counts)) for r in rows.mapInArrow(run, "lang string, counts binary").collect())
    return train(np.array([np.frombuffer(c, np.float32) for _, c in got]).reshape(-1, SLOTS), [v for v, _ in got])


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs(doc_id, text)``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1):
                text = text.as_py()
                lang, score = ("und", 0.0)
                if model["langs"] and has_letter(text):
                    lang, score = predict(model, scaled(ngram_counts(text)))
                langs.append(lang)
                scores.append(score)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame, held_out_mod: int = 4, held_out_bucket: int = 2) -> DataFrame:
    """Train on the rows outside the held-out bucket, then predict every row."""
    bounded_batches(docs.sparkSession)
    held = F.coalesce(bucket_of(F.col("doc_id"), held_out_mod) == held_out_bucket, F.lit(False))
    model = fit(docs.filter(~held).select("doc_id", "text", "lang"))
    return identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")
