"""Quality classifier: random-indexing word vectors and a two-layer network.

Every text is cut into runs of letters, digits and symbols.  A run's slot has a
fixed sparse random index vector; its context vector is the sum of the index
vectors of its neighbours (two on each side) over **all** documents, gathered in
tasks and summed in two steps.  A document is the pooled mean of its runs' index
and context vectors plus a few pooled rates.  A two-layer network gives a logit;
its probability is calibrated by one temperature fitted on rows it didn't train on.

The network learns from at most about ``PER_CLASS`` labelled rows of each class.

Defined results: NULL and empty texts are scored as documents without runs; a
corpus without usable labels scores 0.5 everywhere; repeated rows stay rows; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import bounded_batches, bucket_of
from dimforge.llm.textnum import mix, run_bounds, span_hashes

PER_CLASS = 3000
SLOT_BITS = 13
SLOTS = 1 << SLOT_BITS
DIM = 32
SPAN = 2
HIDDEN = 24
THRESHOLD = 0.3
SLICES = 128
CHUNK = 200_000

_KIND = np.full(256, 3, np.uint8)          # symbols
_KIND[[9, 10, 11, 12, 13, 32]] = 0         # space
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_KIND[48:58] = 2


def index_vectors() -> np.ndarray:
    """Sparse ternary index vector of each slot; the last row (padding) is zero."""
    draw = np.random.Generator(np.random.PCG64(7))
    out = np.zeros((SLOTS + 1, DIM), np.int8)
    for sign in (1, -1):
        for _ in range(2):
            out[np.arange(SLOTS), draw.integers(0, DIM, SLOTS)] = sign
    return out


def slots_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text's runs, and each run's kind (1 letters, 2 digits, 3 symbols, 4 capitals)."""
    if not text:
        return np.empty(0, np.uint16), np.empty(0, np.uint8)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kind = _KIND[raw]
    change = np.flatnonzero(np.diff(kind)) + 1
    starts = np.concatenate(([0], change))
    ends = np.append(change, len(raw))
    used = kind[starts] > 0
    starts, ends = starts[used], ends[used]
    if not len(starts):
        return np.empty(0, np.uint16), np.empty(0, np.uint8)
    kinds = kind[starts].copy()
    upper = (raw[starts] - 65 < 26) & (raw[ends - 1] - 65 < 26) & (ends - starts > 1)
    kinds[upper & (kinds == 1)] = 4
    return (span_hashes(raw, starts, ends, fold=False) >> np.uint64(64 - SLOT_BITS)).astype(np.uint16), kinds


def _context_sums(vectors: np.ndarray, texts: list[np.ndarray], total: np.ndarray) -> None:
    gap = np.full(SPAN, SLOTS, np.uint16)
    v = np.concatenate([part for t in texts for part in (gap, t)] + [gap])
    around = np.zeros((len(v), DIM), np.int16)
    for d in range(1, SPAN + 1):
        around[d:] += vectors[v[:-d]]
        around[:-d] += vectors[v[d:]]
    order = np.argsort(v, kind="stable")
    slots = v[order]
    first = np.flatnonzero(np.concatenate(([True], slots[1:] != slots[:-1])))
    total[slots[first]] += np.add.reduceat(around[order], first, axis=0, dtype=np.int64)


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vector of each slot, from every document."""
    def local(batches):
        vectors, total = index_vectors(), np.zeros((SLOTS + 1, DIM), np.int64)
        texts, held = [], 0
        for batch in batches:
            for t in batch.column(0):
                slots, _ = slots_of(t.as_py())
                if len(slots):
                    texts.append(slots)
                    held += len(slots)
                if held >= CHUNK:
                    _context_sums(vectors, texts, total)
                    texts, held = [], 0
        if held:
            _context_sums(vectors, texts, total)
        parts = np.split(total[:SLOTS], SLICES)
        group = TaskContext.get().partitionId() // 64
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLICES), pa.int32()), pa.array([group] * SLICES, pa.int32()),
             pa.array([p.tobytes() for p in parts], pa.binary())], names=["slice", "part", "sums"])

    def add(key, group):
        total = sum(np.frombuffer(b.as_py(), np.int64) for b in group.column("sums"))
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([0], pa.int32()),
                         "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "slice int, part int, sums binary"
    sums = docs.select("text").mapInArrow(local, schema).groupBy("slice", "part").applyInArrow(add, schema)
    out = np.zeros((SLICES, SLOTS // SLICES * DIM), np.int64)
    for r in sums.groupBy("slice").applyInArrow(add, schema).collect():  # fixed size: 2 MB; one job
        out[r.slice] = np.frombuffer(r.sums, np.int64)
    out = out.reshape(SLOTS, DIM).astype(np.float64)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    out -= out.mean(0)
    return out.astype(np.float32)


N_EXTRA = 8


def pooled(texts: list, words: np.ndarray) -> np.ndarray:
    """Feature rows of texts: pooled vectors and rates.  ``words``: index and context vectors per slot."""
    cut = [slots_of(t) for t in texts]
    sizes = np.array([len(s) for s, _ in cut])
    out = np.zeros((len(texts), words.shape[1] + N_EXTRA), np.float32)
    full = np.flatnonzero(sizes)
    if len(full):
        starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        v = np.concatenate([cut[i][0] for i in full])
        out[full, : words.shape[1]] = np.add.reduceat(words[v], starts, axis=0) / sizes[full, None]
    for i in full:
        v, kinds = cut[i]
        n = len(v)
        share = np.bincount(kinds, minlength=5)[1:5] / n
        letters = v[(kinds == 1) | (kinds == 4)].astype(np.uint64)
        m = len(letters)
        same = float((letters[1:] == letters[:-1]).mean()) if m > 1 else 0.0
        repeat = 0.0
        if m > 4:
            four = mix(letters[:-3] + letters[1:-2] * np.uint64(1 << 13) + letters[2:-1] * np.uint64(1 << 26) + letters[3:] * np.uint64(1 << 39))
            repeat = 1 - len(np.unique(four)) / len(four)
        out[i, words.shape[1]:] = (*(share * 3), same * 3, repeat * 3, np.log1p(n) / 10, min(1.0, n / 50))
    return out


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, fold: np.ndarray, steps: int = 400) -> dict:
    """Two-layer network trained on rows with ``fold`` false; temperature from the others."""
    if len(np.unique(y[~fold])) < 2:
        return {}
    draw = np.random.Generator(np.random.PCG64(11))
    mean, dev = x[~fold].mean(0), x[~fold].std(0) + 1e-3
    a, t = ((x[~fold] - mean) / dev).clip(-6, 6), y[~fold]
    p = [draw.normal(0, 1 / np.sqrt(a.shape[1]), (a.shape[1], HIDDEN)), np.zeros(HIDDEN), draw.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, s = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    for step in range(1, steps + 1):
        h = np.tanh(a @ p[0] + p[1])
        err = (sigmoid(h @ p[2] + p[3]) - t) / len(t)
        back = np.outer(err, p[2]) * (1 - h * h)
        grads = [a.T @ back + 2e-4 * p[0], back.sum(0), h.T @ err + 2e-4 * p[2], np.array([err.sum()])]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            s[i] = 0.99 * s[i] + 0.01 * g * g
            p[i] = p[i] - 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.99**step)) + 1e-8)
    model = {"mean": mean, "dev": dev, "p": p, "temperature": 1.0}
    if fold.any():
        z = logits(model, x[fold])
        loss = {t: -np.mean(np.log(np.where(y[fold] > 0, sigmoid(z / t), sigmoid(-z / t)) + 1e-9)) for t in np.geomspace(0.25, 8, 41)}
        model["temperature"] = float(min(loss, key=loss.get))
    return model


def logits(model: dict, x: np.ndarray) -> np.ndarray:
    h = np.tanh(((x - model["mean"]) / model["dev"]).clip(-6, 6) @ model["p"][0] + model["p"][1])
    return h @ model["p"][2] + model["p"][3]


def _features(docs: DataFrame, words, keep: list[str], schema: str) -> DataFrame:
    def run(batches):
        table = words.value
        for batch in batches:
            x = pooled(batch.column(batch.schema.get_field_index("text")).to_pylist(), table)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array([r.tobytes() for r in x], pa.binary())], names=[*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(run, f"{schema}, x binary")


def fit(docs: DataFrame, labels: DataFrame, words) -> dict:
    """Network from ``labels(doc_id, quality)`` and the texts of ``docs``; a bounded draw per class."""
    known = (labels.filter("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.avg("quality").alias("q")).select("doc_id", (F.col("q") >= 0.5).cast("int").alias("y")))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counts) < 2:
        return {}
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(10)), 11) / float(1 << 53)
    drawn = known.filter(draw < F.when(F.col("y") == 1, min(1.0, PER_CLASS / counts[1])).otherwise(min(1.0, PER_CLASS / counts[0])))
    # about 2 * PER_CLASS ids: small enough to send to every task
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id")
    rows = sorted((r.doc_id, r.y, bytes(r.x)) for r in _features(texts, words, ["doc_id", "y"], "doc_id long, y int").collect())
    if not rows:
        return {}
    ids = np.array([r[0] for r in rows])
    x = np.array([np.frombuffer(r[2], np.float32) for r in rows], np.float64)
    return train(x, np.array([r[1] for r in rows], np.float64), mix(ids.view(np.uint64)) % np.uint64(5) == 0)


def _scorer(docs: DataFrame, labels: DataFrame):
    """A function from texts to scores, for use inside tasks."""
    bounded_batches(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    words = sc.broadcast(np.hstack([index_vectors()[:SLOTS].astype(np.float32), context_vectors(docs)]))
    shared = sc.broadcast(fit(docs, labels, words))

    def scores(texts: list) -> np.ndarray:
        table, model = words.value, shared.value
        out = np.full(len(texts), 0.5)
        for a in range(0, len(texts), 64) if model else ():
            out[a:a + 64] = sigmoid(logits(model, pooled(texts[a:a + 64], table)) / model["temperature"])
        return out

    return scores


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs(doc_id, text)``; ``labels`` are the rows to learn from."""
    scores = _scorer(docs, labels)

    def run(batches):
        for batch in batches:
            s = scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject, with all their columns."""
    scores = _scorer(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at).to_pylist()) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def learnable(labels: DataFrame, held_out_mod: int = 5, held_out_bucket: int = 0) -> DataFrame:
    """Label rows outside the held-out bucket."""
    return labels.filter(F.coalesce(bucket_of(F.col("doc_id"), held_out_mod) != held_out_bucket, F.lit(False)))
