"""Quality classifier: random-indexing word vectors, pooled per document, under a small neural network.

Random indexing.  Words fall into ``BUCKETS`` hash buckets and each bucket has a
fixed sparse ternary index vector.  A bucket's context vector is the sum, over
*all* documents, of the index vectors of the words up to two places away.  Every
partition adds up its own context matrix (``(BUCKETS + SHAPES) * WIDTH`` numbers)
and the matrices are added by row range, so the size does not depend on the
corpus.  Shapes (case, signs, length, whether the word repeats the one before)
are indexed in the same way beside the words.

Document vector.  The mean of the normalised vectors of its words and of its
shapes, and the logarithm of its number of words.

Network.  Two layers (``HIDDEN`` rectified units, one output), trained in numpy
on the driver with Adam.  The labelled rows for it are a bounded sample:
``most_labels`` rows, those with the least hash of the id.  A seventh of them
is kept aside to fit the temperature that calibrates the probabilities.

Labels, lang, source and doc_id are no inputs of a score.

Edge cases: a null or empty text has a zero vector and still gets a score.  Null
labels are not learned from.  A null id counts as held in.  Repeated rows are
scored each.  With no label, or labels of one class, the score is the share of
label 1 (0.5 without labels).  An empty table gives an empty result.  Extra
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.arrays import U64, byte_values, chunks, joined, mix, sorted_groups, spans_hash, word_spans
from harrow.llm.exchange import pack, unpack
from harrow.llm.lm_scoring import held_out

BUCKETS, SHAPES, WIDTH, NONZERO, HIDDEN = 8192, 256, 32, 4, 32
ROWS = BUCKETS + SHAPES
PARTS = 16
FEATURES = 2 * WIDTH + 1
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_SIGN = np.zeros(256, np.int64)
_SIGN[[x for x in range(33, 127) if not chr(x).isalnum()]] = 1


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors: ``NONZERO`` places of each row are 1 or -1."""
    found = np.zeros((ROWS, WIDTH), np.float32)
    for j in range(NONZERO):
        h = mix(np.arange(ROWS, dtype=U64) * U64(NONZERO) + U64(j + 1))
        place = (h % U64(WIDTH)).astype(np.int64)
        found[np.arange(ROWS), place] += np.where(h >> U64(40) & U64(1), 1.0, -1.0)
    return found


@dataclass
class Words:
    word: np.ndarray
    shape: np.ndarray
    row: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    data, at = joined(texts)
    start, end = word_spans(data)
    h = spans_hash(byte_values(data), start, end)
    upper, sign = np.zeros(len(data) + 1, np.int64), np.zeros(len(data) + 1, np.int64)
    np.cumsum(_UPPER[data], out=upper[1:])
    np.cumsum(_SIGN[data], out=sign[1:])
    n, ups, signs = end - start, upper[end] - upper[start], sign[end] - sign[start]
    row = np.searchsorted(at, start, "right") - 1
    case = np.where(ups == 0, 0, np.where(2 * ups > n - signs, 3, np.where(_UPPER[data[start]] == 1, 1, 2)))
    again = np.zeros(len(h), np.int64)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    shape = BUCKETS + ((case * 4 + np.minimum(signs, 3)) * 8 + np.minimum(n // 3, 7)) * 2 + again
    return Words((h % U64(BUCKETS)).astype(np.int64), shape, row)


def _sum_by(index: np.ndarray, values: np.ndarray, into: np.ndarray) -> None:
    order = np.argsort(index, kind="stable")
    g = sorted_groups(index[order])[:-1]
    if len(index):
        into[index[order[g]]] += np.add.reduceat(values[order], g, axis=0)


def add_contexts(w: Words, vectors: np.ndarray, into: np.ndarray) -> None:
    """Add to each bucket's row the index vectors around its words."""
    own = vectors[w.word] + vectors[w.shape]
    around = np.zeros_like(own)
    for k in (1, 2):
        same = (w.row[k:] == w.row[:-k])[:, None]
        around[k:] += own[:-k] * same
        around[:-k] += own[k:] * same
    _sum_by(w.word, around, into)
    _sum_by(w.shape, around, into)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vectors, total = index_vectors(), np.zeros((ROWS, WIDTH))
    for batch in batches:
        for _, texts in chunks(batch, "text"):
            add_contexts(words_of(texts), vectors, total)
    yield pa.record_batch([pa.array(range(PARTS), pa.int32()), pa.array([pack(x.ravel()) for x in np.array_split(total, PARTS)], pa.binary())], names=["part", "payload"])


def _add(table: pa.Table) -> pa.Table:
    total = sum(unpack(p.as_py())[0] for p in table.column("payload"))
    return pa.table({"part": table.column("part")[:1], "payload": pa.array([pack(total)], pa.binary())})


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Normalised context vectors of all buckets and shapes, from all documents."""
    parts = docs.select(F.col(text).alias("text")).mapInArrow(_partial, "part int, payload binary")
    rows = {r["part"]: unpack(r["payload"])[0].reshape(-1, WIDTH) for r in parts.groupBy("part").applyInArrow(_add, "part int, payload binary").collect()}
    total = np.concatenate([rows[i] for i in range(PARTS)]) if rows else np.zeros((ROWS, WIDTH))
    common = total.sum(0)
    common /= np.linalg.norm(common) or 1.0
    total -= np.outer(total @ common, common)  # what all contexts share says nothing
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    w = words_of(texts)
    n = np.bincount(w.row, minlength=len(texts))
    out = np.zeros((len(texts), FEATURES), np.float32)
    if len(w.row):
        g = sorted_groups(w.row)[:-1]
        at = w.row[g]
        out[at, :WIDTH] = np.add.reduceat(vectors[w.word], g, axis=0) / n[at, None]
        out[at, WIDTH : 2 * WIDTH] = np.add.reduceat(vectors[w.shape], g, axis=0) / n[at, None]
    out[:, -1] = np.log1p(n) / 5
    return out


@dataclass
class Network:
    """Input scaling, two layers and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(np.float64) / self.temperature, -700, 700)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit_network(x: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 256) -> Network:
    """Train on all rows but every seventh, then choose the temperature on those."""
    zero = Network(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FEATURES, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    share = float(y.mean()) if len(y) else 0.5
    if len(y) < 14 or share in (0.0, 1.0):
        zero.b2 = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return zero
    aside = np.arange(len(y)) % 7 == 0
    tx, ty = x[~aside].astype(np.float64), y[~aside]
    rng = np.random.default_rng(11)
    net = Network(tx.mean(0), tx.std(0) + 1e-3, rng.normal(0, np.sqrt(2 / FEATURES), (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, HIDDEN), 0.0)
    tx = (tx - net.mean) / net.scale
    p = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(ty))
        for a in range(0, len(ty), batch):
            xb, yb = tx[order[a : a + batch]], ty[order[a : a + batch]]
            pre = xb @ p[0] + p[1]
            h = np.maximum(pre, 0)
            err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -60, 60))) - yb) / len(yb)
            dh = np.outer(err, p[2]) * (pre > 0)
            step += 1
            for i, g in enumerate((xb.T @ dh + 1e-4 * p[0], dh.sum(0), h.T @ err + 1e-4 * p[2], err.sum(keepdims=True))):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.001 * (g * g - v[i])
                p[i] -= 0.003 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(p[3][0])
    z, ay = net.logits(x[aside]), y[aside]
    net.temperature = min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(z / t, ay))
    return net


def _featured(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001  a Broadcast
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in chunks(batch, "text"):
                x = pooled(texts, shared.value)
                yield pa.record_batch([batch.column("label").slice(first, len(texts)), pa.array([r.tobytes() for r in x], pa.binary())], names=["label", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label: str = "quality", text: str = "text", doc_id: str = "doc_id", folds: int = 5, most_labels: int = 20_000) -> Network:
    """Learn ``label`` from at most ``most_labels`` labelled rows that are not held out."""
    rows = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"), folds))
    sample = rows.orderBy(F.xxhash64("id"), "id", "label").limit(most_labels)
    # The sample is bounded by most_labels, so it can be broadcast.
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id").select("label", "text")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    got = known.mapInArrow(_featured(shared), "label int, x binary").collect()
    got.sort(key=lambda r: (bytes(r["x"]), r["label"]))
    order = np.random.default_rng(3).permutation(len(got))
    x = np.array([np.frombuffer(got[i]["x"], np.float32) for i in order]).reshape(-1, FEATURES)
    return fit_network(x, np.array([float(got[i]["label"]) for i in order]))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id", folds: int = 5, at: float = 0.3, most_labels: int = 20_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    vectors = word_vectors(docs, text)
    net = train(docs, labels, vectors, label, text, doc_id, folds, most_labels)
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vec, model = shared.value
        for batch in batches:
            for first, texts in chunks(batch, "text"):
                yield pa.record_batch([batch.column("doc_id").slice(first, len(texts)), pa.array(model.probability(pooled(texts, vec)))], names=["doc_id", "score"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored = own.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), folds).alias("held_out"), "score", (F.col("score") >= at).cast("int").alias("predicted"))
