"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the runs of one to four lower-cased letters, with a mark at word ends, hashed
into ``BUCKETS`` embeddings. A text is the mean embedding of its subwords; a
linear softmax on it gives the language. Embeddings and softmax are trained by
stochastic gradient descent in numpy, on a sample of at most ``per_class`` labelled
documents a language and on short draws from them, so that short
texts are met as well. A temperature and the rejection threshold come from a part
of the sample that is not trained on: a prediction is rejected when its
probability is below the least threshold at which the accepted ones are right in ``precision`` of cases.

At prediction the softmax is folded into the embeddings (one row of class
scores per bucket: a fixed table, broadcast) and whole texts are scored in vectorised passes.

Defined cases: a text that is null or without letters is ``und`` with score 0
and rejected; so is every text if there are no labelled rows. Equal scores go to the language first in order.
Repeated rows get equal results; a null id stays null. A run of over ``PIECE`` characters
without a blank is cut into pieces. An empty table gives an empty result. Only the id, text and label columns
are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ratelens.llm import kernels as K

BUCKETS, DIM, WIDTHS = 1 << 15, 16, 4
PER_CLASS, EPOCHS, RATE, PRECISION = 300, 8, 0.5, 0.99
PIECE = 1 << 20
UNKNOWN = "und"

LETTER = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
STEP, SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def pieces(text: str) -> Iterator[str]:
    """The text, cut at blanks into pieces of about ``PIECE`` characters."""
    at = 0
    while len(text) - at > PIECE:
        cut = text.find(" ", at + PIECE // 2, at + PIECE)
        cut = cut if cut > 0 else at + PIECE
        yield text[at:cut]
        at = cut
    yield text[at:]


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each width: the buckets of all subwords of the texts, and the text of each."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join([f"\0{t}\0" for t in lowered]).encode("utf-32-le"), np.uint32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 2 for t in lowered])
    codes = np.where(LETTER[codes], codes, 0).astype(np.uint64)
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0           # one mark after each word
    keep[:-1] |= codes[1:] != 0           # and one before
    codes, doc = codes[keep], doc[keep]
    letter = codes != 0
    h, inner = codes + np.uint64(1), np.ones(len(codes), bool)
    for n in range(1, WIDTHS + 1):
        if n > 1:
            h = h[:-1] * STEP + codes[n - 1:]
            inner = inner[:-1] if n == 2 else inner[:-1] & letter[n - 2: -1]
        valid = inner if n > 2 else letter[:len(h)] | letter[n - 1:]  # no mark inside, no window of marks only
        yield ((h[valid] * SPREAD) >> np.uint64(49)).astype(np.int32), doc[:len(h)][valid]


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a whole text and their counts."""
    counts = np.zeros(BUCKETS, np.int64)
    for piece in pieces(text or ""):
        for buckets, _ in subwords([piece]):
            counts += np.bincount(buckets, minlength=BUCKETS)
    seen = np.flatnonzero(counts)
    return seen, counts[seen]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


@dataclass
class Model:
    classes: list[str]
    scores: np.ndarray        # BUCKETS x classes: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[str], seed: int = 1) -> Model:
    """Stochastic gradient descent over the sample, one document at a time."""
    rng = np.random.default_rng(seed)
    classes = sorted(set(labels))
    y = np.array([classes.index(x) for x in labels])
    usable = [i for i in rng.permutation(len(bags)) if len(bags[i][0])]
    held, used = usable[: len(usable) // 5], usable[len(usable) // 5:]
    embedding = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, len(classes)), np.float32), np.zeros(len(classes), np.float32)

    def draw(i: int) -> tuple[np.ndarray, np.ndarray]:
        seen, counts = bags[i]
        few = rng.choice(seen, size=int(rng.integers(4, 60)), p=counts / counts.sum())
        return np.unique(few, return_counts=True)

    steps, done = max(1, 2 * EPOCHS * len(used)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(used):
            for seen, counts in (bags[i], draw(i)):
                rate = np.float32(RATE * (1 - done / steps))
                done += 1
                w = (counts / counts.sum()).astype(np.float32)
                rows = embedding[seen]
                hidden = w @ rows
                error = softmax(hidden @ weights + bias)
                error[y[i]] -= 1
                back = weights @ error
                weights -= rate * np.outer(hidden, error)
                bias -= np.float32(0.1) * rate * error
                # a mean over many subwords gives each a small step: lengthen it by their number
                embedding[seen] = rows - rate * np.minimum(w * len(seen), 4)[:, None] * back
    scores = embedding @ weights

    def logits(items) -> np.ndarray:
        return np.array([(c / c.sum()) @ scores[s] + bias for s, c in items]).reshape(-1, len(classes))

    z = logits([bags[i] for i in held] + [draw(i) for i in held])
    truth = np.concatenate([y[held], y[held]]) if held else np.empty(0, int)
    temperature, threshold = 1.0, 0.0
    if held:
        grid = np.geomspace(0.05, 20, 121)
        loss = [-np.log(softmax(z / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / temperature)
        best, right = p.max(1), p.argmax(1) == truth
        order = np.argsort(-best)
        share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share >= PRECISION)
        threshold = float(best[order[good[-1]]]) if len(good) else 1.0
    return Model(classes, scores, bias, temperature, threshold)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in K.slices(batches):
        bags = [bag(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array([b[0] for b in bags], pa.list_(pa.int32())),
             pa.array([b[1] for b in bags], pa.list_(pa.int64()))], ["label", "seen", "counts"])


def fit(docs: DataFrame, trainable: Column, per_class: int = PER_CLASS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "lang") -> Model | None:
    """A model from at most 2 x ``per_class`` (about ``per_class``) documents a
    label, chosen by a hash of their id among the ``trainable`` ones."""
    rows = docs.where(trainable).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                                        F.col(label_col).alias("label")).where(F.col("label").isNotNull())
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # one row a language
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_class / n))])
    place = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30))
    chosen = rows.where(place < F.element_at(share, F.col("label")) * (1 << 30)).orderBy(place, "doc_id")
    found = chosen.limit(2 * per_class * len(counts)).mapInArrow(_bags, "label string, seen array<int>, counts array<long>").collect()
    return train([(np.array(r["seen"], np.int64), np.array(r["counts"], np.int64)) for r in found], [r["label"] for r in found])


def _totals(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sum of class scores and number of subwords of each text."""
    owner, parts = [], []
    for i, t in enumerate(texts):
        for piece in pieces(t or ""):
            owner.append(i)
            parts.append(piece)
    k = len(model.classes)
    total, number = np.zeros((len(texts), k)), np.zeros(len(texts), np.int64)
    at = 0
    while at < len(parts):
        end, size = at, 0
        while end < len(parts) and (end == at or size + len(parts[end]) <= PIECE):
            size += len(parts[end])
            end += 1
        own = np.array(owner[at:end])
        for buckets, doc in subwords(parts[at:end]):
            if len(buckets):
                first = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
                whose = own[doc[first]]
                np.add.at(total, whose, np.add.reduceat(model.scores[buckets], first, axis=0, dtype=np.float64))
                np.add.at(number, whose, np.diff(np.append(first, len(doc))))
        at = end
    return total, number


def _predicted(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in K.slices(batches):
            n = batch.num_rows
            names, best = [UNKNOWN] * n, np.zeros(n)
            if model is not None:
                total, number = _totals(batch.column("text").to_pylist(), model)
                p = softmax((total / np.maximum(number, 1)[:, None] + model.bias) / model.temperature)
                for i in np.flatnonzero(number):
                    j = int(p[i].argmax())
                    names[i], best[i] = model.classes[j], float(p[i, j])
            sure = [x != UNKNOWN and s >= model.threshold for x, s in zip(names, best, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names), pa.array(best, pa.float64()), pa.array([not x for x in sure])],
                ["doc_id", "lang_pred", "score", "rejected"])
    return run


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred, score (0 to 1) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages numbers
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_predicted(shared), "doc_id long, lang_pred string, score double, rejected boolean")
