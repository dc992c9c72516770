"""Sum-of-squares online packing of token ids into fixed windows.

Each document's ids and an end id are cut into full windows and one remainder.
Remainders are placed online, each task over its own rows: ``level[h]`` counts
the windows filled to h, and the remainder goes to the level (or a new window)
that makes the sum of squared counts of partially filled windows least; ties
go to the fuller window. Only ids of open windows are held.

When a task ends, or ``max_open`` windows are open, the open windows are
consolidated: the pieces of the emptiest are cut to fill the fullest, until at
most one is partly filled. At the end of a task that one is cut into lengths
that are powers of two, which need no padding. So only whole windows and powers of
two are written, each id in exactly one piece, and no row leaves its task.

Defined cases: null text is empty and has the end id alone; repeated rows and
ids are packed once each; a null id stays null; a text of any length is packed
whole; an empty table gives an empty result. Only the id and text columns are
read, so further columns cannot clash. Which documents share a sequence
depends on how the input is split; for one split, retried tasks give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ratelens.llm import byte_bpe

WINDOW, END_ID, MAX_OPEN = 1024, 0, 2048
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

Piece = tuple  # (doc, start, ids, doc_tokens)


class SumOfSquares:
    """Open windows by fill level; ``done`` gathers closed sequences of pieces."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN):
        self.window, self.max_open = window, max_open
        self.level = np.zeros(window + 1, np.int64)
        self.at: list[list[list[Piece]]] = [[] for _ in range(window + 1)]  # open windows of each level
        self.n_open = 0
        self.done: list[list[Piece]] = []

    def best_level(self, size: int) -> int:
        """The level to place ``size`` at; 0 is a new window."""
        w, count = self.window, self.level
        change = 2 * (count[size:] - count[: w + 1 - size]) + 2
        change[-1] = 1 - 2 * count[w - size]   # a full window is no longer counted
        change[0] = 2 * count[size] + 1
        change[1:][count[1: w + 1 - size] == 0] = np.iinfo(np.int64).max
        return int(len(change) - 1 - np.argmin(change[::-1]))

    def place(self, piece: Piece) -> None:
        size = len(piece[2])
        h = self.best_level(size)
        if h:
            window = self.at[h].pop()
            self.level[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append(piece)
        self._put(window, h + size)
        if self.n_open > self.max_open:
            self.consolidate()

    def _put(self, window: list[Piece], h: int) -> None:
        if h == self.window:
            self.done.append(window)
        elif h:
            self.at[h].append(window)
            self.level[h] += 1
            self.n_open += 1

    def add(self, doc, ids: np.ndarray) -> None:
        w, n = self.window, len(ids)
        for start in range(0, n - w + 1, w):
            self.done.append([(doc, start, ids[start:start + w], n)])
        if n % w:
            self.place((doc, n - n % w, ids[n - n % w:].copy(), n))

    def consolidate(self) -> None:
        """Cut the pieces of the emptiest windows to fill the fullest ones."""
        windows = [(h, x) for h in range(self.window, 0, -1) for x in self.at[h]]
        self.at = [[] for _ in range(self.window + 1)]
        self.level[:] = 0
        self.n_open = 0
        i, j = 0, len(windows) - 1
        while i < j:
            h, target = windows[i]
            k, source = windows[j]
            doc, start, ids, n = source.pop()
            take = min(self.window - h, len(ids))
            if take < len(ids):  # the tail fills the window, the head stays
                source.append((doc, start, ids[:-take], n))
            target.append((doc, start + len(ids) - take, ids[-take:], n))
            windows[i], windows[j] = (h + take, target), (k - take, source)
            if h + take == self.window:
                self.done.append(target)
                i += 1
            if k == take:
                j -= 1
        if i == j:
            self._put(windows[i][1], windows[i][0])

    def finish(self) -> None:
        self.consolidate()
        last = [p for h in range(self.window) for x in self.at[h] for p in x]
        left = sum(len(p[2]) for p in last)
        while left:
            size, sequence = 1 << (left.bit_length() - 1), []
            left -= size
            while size:
                doc, start, ids, n = last.pop()
                take = min(size, len(ids))
                sequence.append((doc, start, ids[:take], n))
                if take < len(ids):
                    last.append((doc, start + take, ids[take:], n))
                size -= take
            self.done.append(sequence)
        self.at = [[] for _ in range(self.window + 1)]
        self.level[:] = 0
        self.n_open = 0


def _rows(packer: SumOfSquares, task: int, first: int) -> pa.RecordBatch:
    out: list[tuple] = []
    for k, sequence in enumerate(packer.done, first):
        offset = 0
        for doc, start, ids, n in sequence:
            out.append((doc, start, len(ids), n, (task << 36) + k, offset, ids.astype("<u4").tobytes()))
            offset += len(ids)
    packer.done = []
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    columns = list(zip(*out, strict=True)) or [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _packed(window: int, max_open: int, end_id: int, tokenizer: str, ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, first = TaskContext.get().partitionId(), 0
        encoder, packer = byte_bpe.encoder(tokenizer, ranks), SumOfSquares(window, max_open)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                packer.add(doc, np.concatenate((encoder.ids(text), end)))
                if len(packer.done) >= 2048:
                    n = len(packer.done)
                    yield _rows(packer, task, first)
                    first += n
        packer.finish()
        yield _rows(packer, task, first)
    return run


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, max_open: int = MAX_OPEN,
         tokenizer: str = byte_bpe.TOKENIZER, ranks: str = byte_bpe.RANKS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids
    (little-endian unsigned 32-bit integers)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_packed(window, max_open, end_id, tokenizer, ranks), SCHEMA)


def digest_columns(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
