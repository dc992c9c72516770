"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Tokens are the lower-cased words and the runs of punctuation of a text, hashed
into ``BUCKETS``; a word in capitals and a token that repeats the one before
it have buckets of their own. Each bucket has a fixed sparse index vector
(``NONZERO`` entries of +1 or -1 among ``DIM``); the vector of a bucket is the sum of
the index vectors of its neighbours up to ``REACH`` places away, over **all**
documents (integer sums, so any split of the input gives the same), scaled to length one and
centred. A document is the mean and the spread of its tokens' vectors and the
logarithm of their number.

A network of one hidden layer, trained in numpy on at most ``sample``
labelled documents, gives the score; its temperature comes from a part of the sample that is
not trained on. Vectors and network are of fixed size and are broadcast.

Defined cases: null text is empty; a text without tokens is scored from zero
features like any other. Rows that repeat an id get a score each; labels that
repeat an id count once, by the smallest label; without both labels every score is the
share of label 1 (0.5 without labels). Texts are scored whole; an empty table gives an
empty result. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ratelens.llm import counters, kernels as K

BUCKETS, DIM, NONZERO, REACH = 1 << 14, 32, 2, 2
SAMPLE, HIDDEN, EPOCHS, KEEP_FROM = 6000, 32, 40, 0.3
CAPITALS, REPEAT = BUCKETS - 1, BUCKETS - 2

KIND = np.full(256, 2, np.uint8)                      # 1 word, 2 punctuation, 0 blank
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[:33] = KIND[127] = 0
CAPITAL = np.zeros(256, np.int32)
CAPITAL[65:91] = 1

_spread = K.mix(np.arange(1, BUCKETS * NONZERO + 1, dtype=np.uint64)).reshape(BUCKETS, NONZERO)
PLACE = (_spread % np.uint64(DIM)).astype(np.int64)   # index vectors: places and signs of their entries
SIGN = np.where(_spread >> np.uint64(63), 1.0, -1.0)


def tokens(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tokens of all texts, and each text's first token (one longer than ``docs``)."""
    raw = np.frombuffer(b"\n".join(docs), np.uint8)
    hashes, starts, ends = K.runs_hashed(K.LOWER[raw], KIND[raw])
    bucket = (hashes % np.uint64(BUCKETS - 2)).astype(np.int64)
    capitals = np.concatenate(([0], np.cumsum(CAPITAL[raw])))
    shouted = (ends - starts > 1) & (capitals[ends] - capitals[starts] == ends - starts)
    first = np.searchsorted(starts, np.cumsum([0] + [len(d) + 1 for d in docs]), "left")
    again = np.zeros(len(bucket), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    again[first[:-1][first[:-1] < len(again)]] = False
    bucket[shouted] = CAPITALS
    bucket[again] = REPEAT
    return bucket, first


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS * DIM)
    for batch in K.slices(batches):
        bucket, first = tokens(K.doc_bytes(batch.column("text")))
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for gap in range(1, REACH + 1):
            same = doc[gap:] == doc[:-gap]
            left, right = bucket[:-gap][same], bucket[gap:][same]
            for k in range(NONZERO):
                for word, near in ((left, right), (right, left)):
                    total += np.bincount(word * DIM + PLACE[near, k], SIGN[near, k], BUCKETS * DIM)
    yield counters.chunks(total.astype(np.int64))


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Centred vectors of length one of all buckets, from all documents."""
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(_contexts, counters.SCHEMA)
    sums = counters.total(parts, BUCKETS * DIM).reshape(BUCKETS, DIM).astype(np.float64)
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    met = length[:, 0] > 0
    sums[met] /= length[met]
    if met.any():
        sums[met] -= np.average(sums[met], axis=0, weights=length[met, 0])
    return sums.astype(np.float32)


def with_squares(vectors: np.ndarray) -> np.ndarray:
    return np.hstack([vectors, vectors * vectors]).astype(np.float64)


def features(docs: list[bytes], paired: np.ndarray) -> np.ndarray:
    """Mean and spread of each text's token vectors, from the number of times
    it has each bucket, and the logarithm of its number of tokens."""
    bucket, first = tokens(docs)
    out = np.zeros((len(docs), 2 * DIM + 1))
    for i, (a, z) in enumerate(zip(first[:-1], first[1:], strict=True)):
        if z > a:
            seen, times = np.unique(bucket[a:z], return_counts=True)
            pooled = times @ paired[seen] / (z - a)
            out[i, :DIM] = pooled[:DIM]
            out[i, DIM:2 * DIM] = np.sqrt(np.maximum(pooled[DIM:] - pooled[:DIM] ** 2, 0))
    out[:, -1] = np.log1p(np.diff(first))
    return out


@dataclass
class Model:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple | None
    temperature: float
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.share)
        z = _forward((x - self.centre) / self.scale, self.layers)[1] / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _forward(x: np.ndarray, layers: tuple) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, hidden @ w2 + b2[0]


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, seed: int = 1) -> Model:
    """Fit the two layers by Adam on small batches, then the temperature."""
    share = float(y.mean()) if len(y) else 0.5
    centre, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(2 * DIM + 1), np.ones(2 * DIM + 1))
    if len(set(y.tolist())) < 2:
        return Model(vectors, centre, scale, None, 1.0, share)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    x, y = ((x - centre) / scale)[order], y[order].astype(np.float64)
    held = len(y) // 5
    layers = (rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1))
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(held + rng.permutation(len(y) - held), max(1, (len(y) - held) // 32)):
            hidden, z = _forward(x[rows], layers)
            error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y[rows]) / len(rows)
            back = np.outer(error, layers[2]) * (1 - hidden * hidden)
            grads = (x[rows].T @ back + 1e-4 * layers[0], back.sum(0), hidden.T @ error + 1e-4 * layers[2], np.array([error.sum()]))
            step += 1
            for p, g, m, v in zip(layers, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 3e-3 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    temperature = 1.0
    if held:
        z = _forward(x[:held], layers)[1]
        grid = np.geomspace(0.2, 10, 81)
        temperature = float(min(grid, key=lambda t: np.logaddexp(0, np.where(y[:held] > 0, -z, z) / t).mean()))
    return Model(vectors, centre, scale, layers, temperature, share)


def _sampled(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paired = with_squares(shared.value)
        for batch in K.slices(batches):
            x = features(K.doc_bytes(batch.column("text")), paired)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])
    return run


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality") -> Model:
    """Word vectors from all ``docs``; the network from at most ``sample``
    labelled ids, chosen by a hash of the id among the ``trainable`` ones."""
    spark = docs.sparkSession
    vectors = word_vectors(docs, text_col)
    ids = (labels.where(trainable).select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
           .where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
           .orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id").limit(sample))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    chosen = rows.join(F.broadcast(ids), "doc_id").select("label", "text")  # at most ``sample`` ids
    found = chosen.mapInArrow(_sampled(spark.sparkContext.broadcast(vectors)), "label int, x array<double>").limit(2 * sample).collect()
    found.sort(key=lambda r: (r["label"], r["x"]))  # the same order however the input is split
    return train(np.array([r["x"] for r in found]).reshape(-1, 2 * DIM + 1), np.array([r["label"] for r in found]), vectors)


def _scored(shared, columns: list[str], text: str = "text"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        paired = with_squares(model.vectors)
        for batch in K.slices(batches, text):
            scores = model.scores(features(K.doc_bytes(batch.column(text)), paired))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in columns], pa.array(scores, pa.float64())], [*columns, "score"])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score (0 to 1) and predicted (1 from ``KEEP_FROM`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = rows.mapInArrow(_scored(shared, ["doc_id"]), "doc_id long, score double")
    return out.select("doc_id", "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (columns unchanged) that are predicted 1, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of the caller cannot clash
    out = plain.mapInArrow(_scored(shared, plain.columns, f"c{docs.columns.index('text')}"), StructType([*plain.schema.fields, StructField("score", DoubleType())]))
    return out.where(F.col("score") >= KEEP_FROM).drop("score").toDF(*docs.columns)
