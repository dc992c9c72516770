"""Token-id files: frequency-ranked ids in byte-aligned variable-length codes.

A block holds the ids of consecutive documents. Its ids are replaced by their
rank of frequency in the block (ties to the smaller id), so frequent ids take
one byte; each rank is written little-endian in 1 to 4 bytes. Lengths stand
apart, four 2-bit lengths (minus one) to a control byte, the first value in
the low bits. Decoding looks all of it up in numpy tables: a control byte
gives four lengths, a rank gives its id.

Block layout, little-endian: ``FRV1``, uint32 table size, uint64 number of
ids, table (uint32 ids by rank), control bytes, data bytes. Blocks are the ``block`` column
of a Parquet table, so Spark's writer commits them and any file system Spark knows can
hold them; beside it stand shard, number, the ids of the shard before it,
document ids and lengths.

Documents are written in ascending id order: range partitioning on the id, a
sort within each shard, shards numbered in order. A file table is written once
and its blocks are read back in parallel; the start of each document follows from the shard
totals. A block is closed at ``block_tokens`` ids, after the document that reaches it, which bounds
a task's memory but for a single longer document.

Defined cases: null text is empty and has the end id alone; null ids come
first; rows that repeat an id stand one after another, by a hash of their text; an
empty table gives an empty table. Only the id and text columns are read, so
further columns cannot clash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ratelens.llm import byte_bpe

END_ID, BLOCK_TOKENS = 2, 1 << 20
MAGIC, HEADER = b"FRV1", struct.Struct("<4sIQ")
FILE_SCHEMA = "shard int, number int, first long, n_ids long, docs array<long>, lengths array<long>, block binary"

LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1  # control byte -> four lengths


def encode_block(ids: np.ndarray) -> bytes:
    ids = np.asarray(ids, np.uint32)
    if len(ids) and ids.max() < 1 << 22:
        counts = np.bincount(ids)
        seen = np.flatnonzero(counts).astype(np.uint32)
        where, counts = ids, counts[seen]
    else:
        seen, where, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    place = np.empty(len(seen), np.uint32)
    place[order] = np.arange(len(seen), dtype=np.uint32)
    if where is ids:
        rank_of = np.zeros(int(ids.max()) + 1, np.uint32)
        rank_of[seen] = place
        ranks = rank_of[ids]
    else:
        ranks = place[where]
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = size - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    as_bytes = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = as_bytes[np.arange(4) < size[:, None]]
    return HEADER.pack(MAGIC, len(seen), len(ids)) + seen[order].astype("<u4").tobytes() + control.tobytes() + data.tobytes()


def decode_block(block: bytes) -> np.ndarray:
    magic, n_table, n = HEADER.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token-id block")
    at = HEADER.size
    table = np.frombuffer(block, "<u4", n_table, at)
    control = np.frombuffer(block, np.uint8, -(-n // 4), at + 4 * n_table)
    data = np.frombuffer(block, np.uint8, -1, at + 4 * n_table + len(control)) if n else np.empty(0, np.uint8)
    size = LENGTHS[control].reshape(-1)[:n]
    first = np.cumsum(size, dtype=np.int64) - size
    ranks = data[first].astype(np.uint32) if n else np.empty(0, np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        ranks[more] |= data[first[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return table[ranks].astype(np.uint32) if n else ranks


def _blocks(end_id: int, block_tokens: int, tokenizer: str, ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        encoder, end = byte_bpe.encoder(tokenizer, ranks), np.array([end_id], np.uint32)
        docs, ids, held, first = [], [], 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([first], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([docs], pa.list_(pa.int64())), pa.array([[len(x) for x in ids]], pa.list_(pa.int64())),
                 pa.array([encode_block(np.concatenate(ids))], pa.binary())],
                ["shard", "number", "first", "n_ids", "docs", "lengths", "block"])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                docs.append(doc)
                ids.append(np.concatenate((encoder.ids(text), end)))
                held += len(ids[-1])
                if held >= block_tokens:
                    yield row()
                    first += held
                    docs, ids, held, number = [], [], 0, number + 1
        if docs:
            yield row()
    return run


def write_token_files(docs: DataFrame, path: str, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS,
                      tokenizer: str = byte_bpe.TOKENIZER, ranks: str = byte_bpe.RANKS,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every text, with ``end_id`` after each, in id order."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # ties split across shards too: identical rows may stand in any order
    keyed = rows.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("r"))
    ordered = keyed.repartitionByRange("doc_id", "h", "r").sortWithinPartitions("doc_id", "h", "r")
    (ordered.select("doc_id", "text").mapInArrow(_blocks(end_id, block_tokens, tokenizer, ranks), FILE_SCHEMA)
     .write.option("parquet.enable.dictionary", "false").parquet(path))


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for base, docs, lengths, block in zip(*(batch.column(c).to_pylist() for c in ("base", "docs", "lengths", "block")),
                                              strict=True):
            ids = decode_block(block).astype("<u4")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(starts + base, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.array([ids[a:z].tobytes() for a, z in zip(starts, ends, strict=True)], pa.binary())],
                ["doc_id", "start", "n_tokens", "ids"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids before it), n_tokens, ids
    (little-endian unsigned 32-bit integers), all from the files."""
    blocks = spark.read.schema(FILE_SCHEMA).parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    before = shards.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("base"))
    # one row per shard: never more than the shuffle partitions of the writing job
    placed = (blocks.join(F.broadcast(before), "shard")
              .select((F.col("base") + F.col("first")).alias("base"), "docs", "lengths", "block"))
    return placed.mapInArrow(_decoded, "doc_id long, start long, n_tokens long, ids binary")


def digest_columns(decoded: DataFrame) -> DataFrame:
    return decoded.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
