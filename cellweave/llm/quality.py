"""Quality classifier: random-indexing word vectors pooled per document, a two-layer numpy network, temperature-calibrated.

Words and the shape of each word fall into `buckets` hashed rows. A row's index
vector is a fixed sparse random vector; its context vector sums the index
vectors of its neighbours over the fitting sample (random indexing). A document
is the mean of its rows' vectors with the means and spreads of its words' shapes
(letters, digits, marks, repeats of the word before) and a few sizes; it goes through one hidden layer to a chance of label 1.
The last fifth of the sample isn't trained on: on it a temperature is fitted, so
that scores are chances and a threshold other than one half means something.

Fitting takes at most about `sample` labelled rows, by a hash of their id. Their
contexts are summed and their features made where the texts are; the driver gets
four tables of sums and a short row of numbers for each text. Scoring reads
whole texts, of any length.

Defined cases: null or empty text is scored by its empty vector; labels without
a document, or null ones, aren't learned from; an id with several labels has the
largest, one with several texts the smallest; repeated rows get equal scores;
with no labelled rows at all every score is 0.5, with one class only its share
of the prior; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, importable, store, text_crc
from .text import BYTE_LOWER, U64, mix, raw, slices, span_hashes, word_spans

BUCKETS, WIDTH, NONZERO, SHAPES = 1 << 13, 48, 6, 8


def index_vectors(buckets: int = BUCKETS, width: int = WIDTH) -> np.ndarray:
    """Sparse ternary vectors of whole numbers, fixed by a hash of the row."""
    out = np.zeros((buckets, width), np.int64)
    rows = np.arange(buckets, dtype=U64)
    with np.errstate(over="ignore"):
        for j in range(NONZERO):
            h = mix(rows * U64(31) + U64(j + 1) * U64(0xBF58476D1CE4E5B9))
            out[np.arange(buckets), (h % U64(width)).astype(np.int64)] += np.where((h >> U64(40)) & U64(1), 1, -1)
    return out


# Classes of bytes: lower, upper, digit, sentence mark, other ASCII mark, beyond ASCII.
CLASS = np.full(256, 4, np.uint8)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = 0, 1, 2, 5
for _c in b".,;:'\"()!?-":
    CLASS[_c] = 3


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of each word, its 64-bit hash, and (words, SHAPES) flags of its shape."""
    starts, ends, rows = word_spans(data, offsets)
    hashed = span_hashes(BYTE_LOWER[data], starts, ends)
    classes = CLASS[data]
    flags = np.zeros((len(starts), SHAPES), np.float32)
    if len(starts):
        length = (ends - starts).astype(np.float32)
        for c in range(6):
            sums = np.concatenate([[0], np.cumsum(classes == c)])
            flags[:, c] = (sums[ends] - sums[starts]) / length
        flags[:, 6] = np.minimum(length, 32) / 16
        flags[1:, 7] = (hashed[1:] == hashed[:-1]) & (rows[1:] == rows[:-1])
    return (hashed & U64(BUCKETS - 1)).astype(np.int64), rows, hashed, flags


@dataclass
class QualityModel:
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]
    temperature: float
    constant: float | None = None
    shapes: bool = True

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return pooled(self.vectors, data, offsets, self.shapes)

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(features), self.constant)
        z = forward(self.layers, (features - self.mean) / self.scale)[1]
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -30, 30)))


def pooled(vectors: np.ndarray, data: np.ndarray, offsets: np.ndarray, shapes: bool = True) -> np.ndarray:
    """Of each row: mean vector of its words, mean and spread of shapes, log size, share of distinct words, log of line breaks; without shapes the vector alone."""
    n, width = len(offsets) - 1, vectors.shape[1]
    out = np.zeros((n, width + 2 * SHAPES + 3), np.float64)
    bucket, rows, hashed, flags = tokens(data, offsets)
    counts = np.bincount(rows, minlength=n)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    at = np.concatenate([[0], np.cumsum(counts[full])])[:-1]
    size = counts[full][:, None]
    for a in range(0, len(full), 64):  # bounded temporaries
        some = full[a : a + 64]
        first, last = at[a], at[a] + counts[some].sum()
        here = at[a : a + 64] - first
        out[some, :width] = np.add.reduceat(vectors[bucket[first:last]], here, axis=0) / size[a : a + 64]
        out[some, width : width + SHAPES] = np.add.reduceat(flags[first:last], here, axis=0) / size[a : a + 64]
        out[some, width + SHAPES : width + 2 * SHAPES] = np.sqrt(np.maximum(np.add.reduceat(flags[first:last] ** 2, here, axis=0) / size[a : a + 64] - out[some, width : width + SHAPES] ** 2, 0))
    out[full, -3] = np.log1p(counts[full])
    out[full, -2] = [len(np.unique(bucket[x : x + c])) / c for x, c in zip(at, counts[full], strict=True)]
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    out[full, -1] = np.log1p(breaks[offsets[1:]] - breaks[offsets[:-1]])[full]
    if not shapes:
        out[:, width:] = 0
    return out


def forward(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    (a, b), (c, d) = layers
    hidden = np.tanh(x @ a + b)
    return hidden, (hidden @ c + d)[:, 0]


def add_contexts(context: np.ndarray, data: np.ndarray, offsets: np.ndarray, index: np.ndarray, window: int = 2) -> None:
    """Random indexing: each row of context gains the index vectors of its words' neighbours. Sums of whole numbers, so their order doesn't matter."""
    bucket, rows, _, _ = tokens(data, offsets)
    for d in range(1, window + 1):
        near = np.flatnonzero(rows[d:] == rows[:-d])
        for here, there in ((near, near + d), (near + d, near)):
            order = np.argsort(bucket[here], kind="stable")
            here, there = bucket[here][order], bucket[there][order]
            firsts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]])) if len(here) else np.zeros(0, np.int64)
            for a in range(0, len(firsts), 1024):
                lo, hi = firsts[a], firsts[a + 1024] if a + 1024 < len(firsts) else len(here)
                context[here[firsts[a : a + 1024]]] += np.add.reduceat(index[there[lo:hi]], firsts[a : a + 1024] - lo, axis=0)


def word_vectors(context: np.ndarray) -> np.ndarray:
    """Contexts scaled to length 1, and each row's own index vector."""
    length = np.linalg.norm(context, axis=1, keepdims=True)
    return (context / np.maximum(length, 1e-6) + index_vectors() / np.sqrt(NONZERO)).astype(np.float32)


def train(vectors: np.ndarray, x: np.ndarray, labels: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 5, shapes: bool = True) -> QualityModel:
    """Rows of features in a fixed order: four fifths train, the last fifth sets the temperature."""
    y = labels.astype(np.float64)
    share = float((y.sum() + 1) / (len(y) + 2))
    if len(np.unique(y)) < 2:
        return QualityModel(vectors, np.zeros(x.shape[1]), np.ones(x.shape[1]), [], 1.0, share, shapes)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = (x - mean) / scale
    cut = max(1, len(z) * 4 // 5)
    rng = np.random.default_rng(seed)
    layers = [[rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], hidden)), np.zeros(hidden)], [rng.normal(0, 1 / np.sqrt(hidden), (hidden, 1)), np.zeros(1)]]
    moments = [[(np.zeros_like(w), np.zeros_like(w)) for w in layer] for layer in layers]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(cut)
        for i in range(0, cut, 128):
            at = order[i : i + 128]
            h, out = forward(layers, z[at])
            gap = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[at])[:, None] / len(at)
            back = gap @ layers[1][0].T * (1 - h**2)
            slopes = [[z[at].T @ back + 1e-4 * layers[0][0], back.sum(0)], [h.T @ gap + 1e-4 * layers[1][0], gap.sum(0)]]
            step += 1
            for l, layer in enumerate(layers):  # noqa: E741
                for k in range(2):
                    m, v = moments[l][k]
                    m += 0.1 * (slopes[l][k] - m)
                    v += 0.001 * (slopes[l][k] ** 2 - v)
                    layer[k] -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    final = [tuple(layer) for layer in layers]
    held = slice(cut, None) if len(z) - cut >= 20 else slice(None)
    out = forward(final, z[held])[1]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, -(2 * y[held] - 1) * out / t)) for t in grid]
    return QualityModel(vectors, mean, scale, final, float(grid[int(np.argmin(loss))]), shapes=shapes)


def held_out(doc_id: str = "doc_id", parts: int = 5, part: int = 0):
    return F.pmod(text_crc(doc_id), F.lit(parts)) == part


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000, doc_id: str = "doc_id", text: str = "text", label: str = "quality", shapes: bool = True) -> QualityModel:
    """Learn from the labelled rows given, of which a hash of their id picks about `sample` at most; without shapes from the word vectors alone."""
    named = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    total = named.count()
    ticket = F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(1 << 30))
    chosen = named.where(ticket < F.lit(float(sample)) / max(total, 1) * float(1 << 30)) if total > sample else named
    # about `sample` ids, whatever the tables hold: small enough to send to every reader of the texts
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows, spark = store(rows, "sample"), docs.sparkSession
    importable(spark)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        context = np.zeros_like(index)
        for batch in batches:
            for part in slices(batch, "text"):
                add_contexts(context, *raw(part.column("text")), index)
        yield pa.RecordBatch.from_arrays([pa.array([context.tobytes()], pa.binary())], ["sums"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.frombuffer(v.as_py(), np.int64) for batch in batches for v in batch.column("sums")]
        yield pa.RecordBatch.from_arrays([pa.array([np.sum(parts, 0).tobytes()] if parts else [], pa.binary())], ["sums"])

    sums = rows.select("text").mapInArrow(contexts, "sums binary").repartition(4).mapInArrow(added, "sums binary").collect()
    context = np.sum([np.frombuffer(r["sums"], np.int64) for r in sums], 0).reshape(BUCKETS, WIDTH) if sums else np.zeros((BUCKETS, WIDTH), np.int64)
    vectors = word_vectors(context)
    shared = spark.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x = pooled(shared.value, *raw(part.column("text")), shapes)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    made = rows.select("doc_id", "label", "text").mapInArrow(features, f"doc_id {dict(rows.dtypes)['doc_id']}, label int, x array<double>")
    found = sorted(((shuffled(r["doc_id"]), str(r["doc_id"]), r["x"], r["label"]) for r in made.toLocalIterator()), key=lambda r: r[:2])  # about `sample` rows of some 70 numbers
    forget(rows)
    x = np.array([r[2] for r in found]).reshape(len(found), WIDTH + 2 * SHAPES + 3)
    return train(vectors, x, np.array([r[3] for r in found], int), shapes=shapes)


def shuffled(value) -> bytes:
    """A fixed shuffle of ids of any kind."""
    return hashlib.blake2b(str(value).encode(), digest_size=8).digest()


def score(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score)."""
    importable(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.score(shared.value.features(*raw(part.column("text")))))], ["doc_id", "score"])

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"doc_id {dict(chosen.dtypes)['doc_id']}, score double")
