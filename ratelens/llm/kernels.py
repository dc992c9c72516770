"""Vectorised word hashing over the bytes of many texts (numpy, inside tasks)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20           # bytes hashed at a time
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64

SEP = np.zeros(256, bool)
SEP[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective, every output bit depends on every input bit)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, np.uint64), np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = PIECE + 1
    while size < n:
        size *= 2
    return _powers(size)


def slices(batches, text: str = "text", size: int = PIECE):
    """The record batches cut into runs of rows of about ``size`` text bytes
    (one longer text stands alone), so that working arrays stay small."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        runs = np.cumsum(lengths, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(lengths)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if z > a:
                yield batch.slice(a, z - a)


def doc_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each value; null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def runs_hashed(b: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every maximal run of bytes of ``b`` of one kind;
    kind 0 is no run."""
    edge = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(kind)])) if len(kind) else np.zeros(1, int)
    run = kind[edge[:-1]] != 0
    starts, ends = edge[:-1][run], edge[1:][run]
    hashes = np.empty(len(starts), np.uint64)
    w = 0
    while w < len(starts):  # pieces that end between words
        v = max(w + 1, int(np.searchsorted(ends, starts[w] + PIECE, "right")))
        lo, hi = int(starts[w]), int(ends[v - 1])
        up, down = powers(hi - lo + 1)
        total = np.concatenate(([np.uint64(0)], np.cumsum(BYTE_VALUE[b[lo:hi]] * up[: hi - lo], dtype=np.uint64)))
        s, e = starts[w:v] - lo, ends[w:v] - lo
        hashes[w:v] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        w = v
    return mix(hashes), starts, ends


def words_hashed(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, A-Z lowered, and each text's first
    word index (one longer than ``docs``)."""
    joined = b"\n".join(docs)
    b = LOWER[np.frombuffer(joined, np.uint8)]
    hashes, starts, _ = runs_hashed(b, ~SEP[b])
    first_byte = np.cumsum([0] + [len(d) + 1 for d in docs])
    return hashes, np.searchsorted(starts, first_byte, "left")


def shingle_sets(docs: list[bytes], width: int):
    """Yield each text's sorted distinct shingle hashes. A text of fewer words
    than ``width`` has its whole sequence as one shingle; none if no words."""
    words, first = words_hashed(docs)
    k = np.uint64(BASE)
    full = words.copy()
    for j in range(1, width):
        full = mix(full[:-1] * k + words[j:]) if len(full) else full
    for a, z in zip(first[:-1], first[1:], strict=True):
        n = z - a
        if n >= width:
            s = np.sort(full[a: z - width + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif n:
            h = np.uint64(n)
            for x in words[a:z]:
                h = mix(np.array([h], np.uint64) * k + x)[0]
            yield np.array([h ^ np.uint64(0x5555555555555555)], np.uint64)
        else:
            yield np.empty(0, np.uint64)
