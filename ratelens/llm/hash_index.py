"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes: several groups of signs, each after a rotation learned on a bounded sample so that the signs
lie close to the rotated, centred vectors (alternating least squares). About ``BITS``
bits, cut into substrings of 64: long ones, as a radius that is a large part of the
code leaves short ones nearly always within reach.

Index: rows are dealt into blocks of about ``block_rows`` by a hash of their
id; every row is indexed. In a block each substring has an inverted list by
value. To find all codes within a radius r of the query, with m substrings and r = ms + a, the lists
within s bits of the query's substring are opened for the first a + 1 substrings, and those within s - 1 for
the others: by the pigeonhole principle a code within r is in one of them. Values near the query's are found
by flipping bits or by comparing with the values present, whichever is fewer.

The radius grows (from a little less than the last query needed) until it holds all that is wanted:
either the k best found lie so near that a better vector would be expected within the radius (its
angle gives the mean distance of its code; ``MARGIN`` deviations are added), or the radius holds ``reach``
of the block's distinct vectors (at least ``least`` for each of the k). On clustered vectors
the first ends the search early, on isotropic ones the second does. What the radius holds is reranked by inner
products of the original vectors in double precision. Vectors much longer than others can win at a
larger angle, so many of the longest join the candidates, and only the second rule applies.

Identical vectors of a block are one entry, with the smallest ids a query can
need (k + 1), so large groups of copies cost no more than one vector. Every block meets
every query: the queries are a stated set, streamed past each block in batches. The k best of
each block are merged into the k best.

Defined cases: vectors that are null, empty, zero, hold null or non-finite
components, or have a length other than the commonest (of equals the larger) take no part, as do null ids; of rows
that repeat an id the smallest vector counts, once. Equal scores go to the smaller id. Fewer
candidates than k are all returned; an empty table gives an empty result.
Only the id and vector columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratelens.llm.common import written

BITS, SAMPLE, ROUNDS = 256, 4096, 15
BLOCK_ROWS, REACH, LEAST, MARGIN = 1 << 14, 3 / 64, 16, 3.0
WORD = 64
BALLS = [np.array([sum(1 << b for b in bits) for n in range(s + 1) for bits in combinations(range(WORD), n)], np.uint64)
         for s in range(3)]


@dataclass
class Coder:
    centre: np.ndarray
    rotations: list[np.ndarray]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """One row of 64-bit substrings per vector."""
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        bits = np.concatenate([(unit - self.centre) @ r > 0 for r in self.rotations], axis=1)
        bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % WORD)))
        return np.packbits(bits, axis=1).view(np.uint64)

    @property
    def bits(self) -> int:
        return sum(r.shape[1] for r in self.rotations)


def learn(sample: np.ndarray, bits: int = BITS, seed: int = 1) -> Coder:
    """Rotations that bring the sample closest to its own signs."""
    rng = np.random.default_rng(seed)
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    centre = x.mean(0)
    x, d = x - centre, x.shape[1]
    rotations = []
    for _ in range(max(1, -(-bits // d))):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(ROUNDS):
            u, _, vt = np.linalg.svd(x.T @ np.sign(x @ r))
            r = u @ vt
        rotations.append(r)
    return Coder(centre, rotations)


class Block:
    """The inverted lists of one block of rows."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, coder: Coder, k: int, reach: float, least: int):
        order = np.lexsort((ids, *x.T[::-1]))
        ids, x = ids[order], x[order]
        new = np.concatenate(([True], (x[1:] != x[:-1]).any(1)))
        first = np.flatnonzero(new)
        count = np.minimum(np.diff(np.append(first, len(x))), k + 1)
        self.first_id, self.n_ids, self.ids = first, count, ids
        self.x, self.k = x[first].astype(np.float64), k
        self.codes = coder.codes(self.x)
        n, self.m = self.codes.shape
        self.bits = coder.bits
        self.target = min(n, max(least * k, int(np.ceil(reach * n))))
        self.lists = []
        for j in range(self.m):
            by = np.argsort(self.codes[:, j], kind="stable").astype(np.int32)
            values, start = np.unique(self.codes[by, j], return_index=True)
            self.lists.append((values, start, np.diff(np.append(start, n)), by))
        lengths = np.linalg.norm(self.x, axis=1)
        self.length, self.uneven = lengths.max(), lengths.max() > 1.01 * lengths.min()
        self.longest = np.argsort(-lengths, kind="stable")[: self.target] if self.uneven else np.empty(0, np.int64)
        self.start = 0   # a little less than the last query needed: the next one starts there
        self.opened = 0  # rows found in opened lists, of all queries
        self.apart: dict[int, np.ndarray] = {}  # bits between this query's substrings and the values present

    def _listed(self, j: int, value: np.uint64, s: int) -> np.ndarray:
        """Rows whose substring j is within s bits of ``value``."""
        values, start, size, rows = self.lists[j]
        if s < len(BALLS) and len(BALLS[s]) < len(values):
            wanted = BALLS[s] ^ value
            at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
            at = at[values[at] == wanted]
        else:
            if j not in self.apart:
                self.apart[j] = np.bitwise_count(values ^ value)
            at = np.flatnonzero(self.apart[j] <= s)
        if len(values) == len(rows):
            return rows[at]
        n = size[at]
        end = np.cumsum(n)
        return rows[np.repeat(start[at] - end + n, n) + np.arange(end[-1] if len(end) else 0)]

    def _within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All rows within ``radius`` bits of the code, and their distances."""
        s, a = divmod(radius, self.m)
        found = np.zeros(len(self.x), bool)
        for j in range(self.m):
            if j <= a or s:
                found[self._listed(j, code[j], s if j <= a else s - 1)] = True
        rows = np.flatnonzero(found)
        self.opened += len(rows)
        distance = np.bitwise_count(self.codes[rows] ^ code).sum(1, dtype=np.int32)
        inside = distance <= radius
        return rows[inside], distance[inside]

    def near(self, code: np.ndarray, enough=None) -> np.ndarray:
        """All rows within the least radius that holds ``target`` rows, or within one
        that ``enough`` (of the rows and the radius) accepts."""
        radius, self.apart = self.start, {}
        while True:
            rows, distance = self._within(code, radius)
            full = len(rows) >= self.target
            if full or radius >= self.m * WORD or (enough and enough(rows, radius)):
                break
            radius += self.m
        self.start = max(0, radius - 2 * self.m)
        return rows[distance <= np.partition(distance, self.target - 1)[self.target - 1]] if full else rows

    def _nearest_found(self, q: np.ndarray):
        """Accepts a radius in which a vector better than the k best found would be expected."""
        size = np.linalg.norm(q) * self.length

        def enough(rows: np.ndarray, radius: int) -> bool:
            if self.n_ids[rows].sum() < self.k + 1:
                return False
            scores = np.repeat(self.x[rows] @ q, self.n_ids[rows])
            part = np.arccos(np.clip(np.partition(scores, len(scores) - self.k - 1)[len(scores) - self.k - 1] / size, -1, 1)) / np.pi
            return radius >= self.bits * part + MARGIN * np.sqrt(self.bits * part * (1 - part)) + 1
        return enough

    def search(self, own: int, q: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best found, the query's own id left out."""
        rows = self.near(code, None if self.uneven or self.target == len(self.x) else self._nearest_found(q))
        if len(self.longest):
            rows = np.union1d(rows, self.longest)
        scores = self.x[rows] @ q
        if len(rows) > self.k + 1:
            best = scores >= np.partition(scores, len(scores) - self.k - 1)[len(scores) - self.k - 1]
            rows, scores = rows[best], scores[best]
        sizes = self.n_ids[rows]
        ids = self.ids[np.repeat(self.first_id[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
        scores = np.repeat(scores, sizes)
        other = ids != own
        ids, scores = ids[other], scores[other]
        order = np.lexsort((ids, -scores))[: self.k]
        return ids[order], scores[order]


def _vectors(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _searched(shared, d: int, k: int, reach: float, least: int):
    """Rows come by block, index rows before queries; one block is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        at, ids, vectors, block = None, [], [], None
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            query = batch.column("query").to_numpy(zero_copy_only=False).astype(bool)
            key, x = batch.column("vec_id").to_numpy(), _vectors(batch.column("v"), d)
            cuts = np.concatenate(([0], np.flatnonzero((blocks[1:] != blocks[:-1]) | (query[1:] != query[:-1])) + 1, [len(blocks)]))
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                if a == z:
                    continue
                if blocks[a] != at:
                    at, ids, vectors, block = blocks[a], [], [], None
                if not query[a]:
                    ids.append(key[a:z])
                    vectors.append(x[a:z])
                    continue
                if block is None:
                    if not ids:
                        continue
                    block = Block(np.concatenate(ids), np.concatenate(vectors), coder, k, reach, least)
                    ids, vectors = [], []
                for b in range(a, z, 512):
                    own, q = key[b:min(z, b + 512)], x[b:min(z, b + 512)].astype(np.float64)
                    found = [block.search(i, v, c) for i, v, c in zip(own, q, coder.codes(q), strict=True)]
                    sizes = [len(f[0]) for f in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(own, sizes), pa.int64()), pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                         pa.array(np.concatenate([f[1] for f in found]), pa.float64())], ["query_id", "vec_id", "score"])
    return run


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): the rows that take part, one per id, of the commonest length."""
    v, single = F.col("v"), dict(table.dtypes)[vec_col] == "array<float>"  # any other kind is taken in double precision
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{'float' if single else 'double'}>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(table: DataFrame, is_query: Column, k: int = 20, block_rows: int = BLOCK_ROWS, reach: float = REACH, least: int = LEAST,
            sample: int = SAMPLE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per query (rows whose ``vec_id`` meets ``is_query``): query_id, rank,
    vec_id, score of the k largest inner products found among all other rows."""
    spark = table.sparkSession
    rows = written(usable(table, id_col, vec_col), "vectors")  # one pass and shuffle of the table, read four times below
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = sizes["d"], sizes["count"]
    rows = rows.where(F.size("v") == d)
    some = rows.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(sample).collect()
    coder = spark.sparkContext.broadcast(learn(np.array([r["v"] for r in some], np.float64)))  # a few d x d rotations
    n_blocks = max(1, -(-n // block_rows))
    index = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block"), F.lit(False).alias("query"), "vec_id", "v")
    queries = rows.where(is_query).select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"), F.lit(True).alias("query"), "vec_id", "v")
    dealt = index.unionByName(queries).repartitionByRange(n_blocks, "block").sortWithinPartitions("block", "query")
    found = dealt.mapInArrow(_searched(coder, d, k, reach, least), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # k rows a block at most
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
