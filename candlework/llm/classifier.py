"""Quality of a text from word vectors: random indexing, a small network, calibration.

Each word has a sparse random index vector, given by its hash. The vector of a word is
the sum of the index vectors of its neighbours over all documents. A text is the mean of
its words' vectors, once for the words and once for their forms (which kinds of
characters follow each other); a network of two layers scores it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlework.llm.filters import only_ids
from candlework.llm.text import NOT_SPACE, SAME, U64, blocks, mix, span_hashes, words

BUCKETS = 1 << 13
WIDTH = 32
#: Neighbours on either side.
REACH = 2
#: Expected number of labelled rows to learn from, drawn by a hash of the id.
SAMPLE_ROWS = 10_000
HIDDEN = 32
CHOOSE = 0.7

# Kinds of characters in the form of a word; others stand for themselves.
_KIND = np.arange(256, dtype=np.uint8)
_KIND[0x30:0x3A] = ord("0")
_KIND[0x41:0x5B] = ord("A")
_KIND[0x61:0x7B] = ord("a")
_KIND[0x80:] = ord("a")

# Places and signs of the two entries of each bucket's index vector.
_RANDOM = mix(np.arange(1, BUCKETS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
_ENTRIES = [
    ((_RANDOM >> U64(8 * j)) % U64(WIDTH), 1 - 2 * ((_RANDOM >> U64(40 + j)) & U64(1)).astype(np.int64)) for j in (0, 1)
]


def trained_on(doc_id: Column) -> Column:
    """Rows whose labels may be learned from."""
    return F.crc32(doc_id.cast("string")) % 4 != 2


def _buckets(column: pa.Array):
    """Where each text's words begin, and the bucket of each word and of its form."""
    w = words(column, NOT_SPACE, SAME)
    shift = U64(64 - BUCKETS.bit_length() + 1)
    word = span_hashes(w.data, w.start, w.end) >> shift
    kind = _KIND[w.data]
    new = np.zeros(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[w.start] = True
    new &= NOT_SPACE[w.data]
    place = np.append(0, np.cumsum(new))
    form = span_hashes(kind[new], place[w.start], place[w.end]) >> shift
    return w.first, [word.astype(np.int64), form.astype(np.int64)]


def _neighbours(batches):
    """Of each bucket the sum of its neighbours' index vectors, over the rows of a task."""
    sums = np.zeros(2 * BUCKETS * WIDTH, np.int64)
    for batch in batches:
        column = batch.column("text")
        for a, b in blocks(column):
            first, channels = _buckets(column.slice(a, b - a))
            doc = np.repeat(np.arange(b - a), np.diff(first))
            for c, bucket in enumerate(channels):
                for d in range(1, REACH + 1):
                    same = doc[d:] == doc[:-d]
                    left, right = bucket[:-d][same], bucket[d:][same]
                    for word, other in ((left, right), (right, left)):
                        for place, sign in _ENTRIES:
                            cell = word * WIDTH + place.astype(np.int64)[other]
                            sums[c * BUCKETS * WIDTH : (c + 1) * BUCKETS * WIDTH] += np.bincount(
                                cell, sign[other], BUCKETS * WIDTH
                            ).astype(np.int64)
    table = sums.reshape(-1, WIDTH)
    used = np.flatnonzero(table.any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int64())] + [pa.array(table[used, j], pa.int64()) for j in range(WIDTH)],
        names=["bucket", *[f"v{j}" for j in range(WIDTH)]],
    )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of the buckets of words and of forms, from all documents: a fixed size."""
    names = [f"v{j}" for j in range(WIDTH)]
    rows = (
        docs.where("text IS NOT NULL").select("text")
        .mapInArrow(_neighbours, "bucket bigint, " + ", ".join(f"{n} bigint" for n in names))
        .groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])
        .toArrow()
    )
    table = np.zeros((2 * BUCKETS, WIDTH))
    table[rows["bucket"].to_numpy()] = np.column_stack([rows[n].to_numpy() for n in names])
    norm = np.sqrt((table**2).sum(axis=1, keepdims=True))
    return (table / np.maximum(norm, 1)).astype(np.float32)


#: For each channel: mean vector, spread, share of words equal to the one before; and the length.
FEATURES = 2 * (WIDTH + 2) + 1


def pooled(table: np.ndarray, column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text; zeros for one without words."""
    first, channels = _buckets(column)
    n = np.diff(first)
    out = np.zeros((len(n), FEATURES), np.float32)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    begin = first[:-1][some]
    for c, bucket in enumerate(channels):
        mean = np.add.reduceat(table[c * BUCKETS + bucket], begin, axis=0) / n[some, None]
        at = c * (WIDTH + 2)
        out[some, at : at + WIDTH] = mean
        out[some, at + WIDTH] = np.sqrt((mean**2).sum(axis=1))
        equal = np.zeros(len(bucket))
        equal[1:] = bucket[1:] == bucket[:-1]
        equal[begin] = 0
        out[some, at + WIDTH + 1] = np.add.reduceat(equal, begin) / n[some]
    out[:, -1] = np.log1p(n)
    return out


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the last sum."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def _loss(logits, y, temperature):
    z = logits / temperature
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit(x: np.ndarray, y: np.ndarray, epochs: int = 60, seed: int = 7) -> Network:
    """Adam on four fifths of the rows; the temperature on the rest. Constant without both classes."""
    width = x.shape[1]
    x, y = x.astype(np.float64), y.astype(np.float64)
    share = float(np.clip(y.mean(), 0.02, 0.98)) if len(y) else 0.5
    prior = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), prior)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    x, y = x[order], y[order]
    held = max(1, len(y) // 5)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    # Smoothed targets, so that separable labels do not drive the weights without end.
    z_held, y_held, z, y = z[:held], y[:held], z[held:], 0.02 + 0.96 * y[held:]
    p = [
        rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.array(prior),
    ]
    m, s, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            a, t = z[rows], y[rows]
            h = np.tanh(a @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - t) / max(1, len(rows))
            back = np.outer(d, p[2]) * (1 - h**2)
            grads = [a.T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ d + 1e-4 * p[2], d.sum()]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g**2
                p[i] = p[i] - 0.005 * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3]))
    logits = np.tanh(z_held @ p[0] + p[1]) @ p[2] + p[3]
    grid = np.exp(np.linspace(np.log(0.5), np.log(8), 60))
    net.temperature = float(min(grid, key=lambda t: _loss(logits, y_held, t)))
    return net


def _mapped(table, keep, schema_names, make):
    def run(batches):
        for batch in batches:
            column = batch.column("text")
            for a, b in blocks(column):
                x = pooled(table.value, column.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(a, b - a) for c in keep], make(x)], names=[*keep, *schema_names]
                )

    return run


def train(docs: DataFrame, labels: DataFrame, table: np.ndarray, target: str = "quality", rows: int = SAMPLE_ROWS) -> Network:
    """Fits a network to about ``rows`` of the labelled documents that may be learned from.

    Labels without id or value, and those of documents that are not there, are left out.
    """
    labels = labels.where(trained_on(F.col("doc_id")) & F.col(target).isNotNull()).select(
        "doc_id", (F.col(target) > 0).cast("int").alias("y")
    )
    rate = min(1.0, rows / max(1, labels.count()))
    drawn = labels.where(F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 30)) < rate * (1 << 30))
    texts = only_ids(docs.where("text IS NOT NULL").select("doc_id", "text"), "doc_id", drawn, "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(table)
    x = texts.mapInArrow(
        _mapped(shared, ["doc_id"], ["x"], lambda x: pa.array(x.tolist(), pa.list_(pa.float32()))),
        T.StructType([docs.schema["doc_id"], T.StructField("x", T.ArrayType(T.FloatType()))]),
    )
    got = x.join(drawn, "doc_id").orderBy("doc_id", "y", F.hash("x")).select("x", "y").toArrow()
    features = np.array(got["x"].to_pylist(), np.float32).reshape(-1, FEATURES)
    return fit(features, got["y"].to_numpy())


def score(docs: DataFrame, table: np.ndarray, net: Network) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every row; a null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    return docs.select("doc_id", "text").mapInArrow(
        _mapped(shared, ["doc_id"], ["score"], lambda x: pa.array(net.scores(x.astype(np.float64)), pa.float64())),
        T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())]),
    )
