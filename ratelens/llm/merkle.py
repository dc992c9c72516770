"""Merkle manifest of a dataset with leaf coordinates from bitmap ranks.

A leaf is the hash of one row. Per source the leaves ascend by doc_id; runs of
``FAN`` consecutive nodes become their hash until one is left, the subroot;
the subroots in order of their sources give the root in the same way.

Coordinates come without sorting the leaves. Each task packs the ids it reads
into compressed bitmaps of 65,536 ids per (source, id // 65,536); bitmaps of
one group merge by counting (a list of repeated ids rides along). Their totals
form a directory, summed in three radix levels of 65,536 entries at most; a
leaf's index is its group's start plus the rank of its id in the merged bitmap,
read from a popcount directory over 64-bit words.

Levels reduce in blocks of ``FAN ** TIER`` nodes: a task places the nodes of a
block in an array of slots by their index, whatever their order, and reduces
it by up to ``TIER`` levels. So a block never exceeds 729 rows, whatever the
size of its source, and an upper tier is 729 times smaller. Sibling paths then
come down the tiers: a block gets its parent's path once, and each leaf's
path lives only inside the task, which emits its digest and the folded root.

What crosses the network: partial bitmaps; each leaf (two digests, no text)
once to its bitmap and twice to its block; upper nodes and one path a block.

Defined cases: null ids come before all others, and rows that share an id (or
have none) are ordered by their leaf; rows equal in all fields are
interchangeable. A null source is a source of its own, before all others. Null
fields are hashed as ``-``. Texts are hashed whole by Spark. An empty table
gives an empty result. A repeated id that holds a large part of the rows is
dealt to several tasks. Only the five hashed columns are read, so further
columns cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratelens.llm.common import Scratch

FAN = 3
TIER = 6                 # levels reduced in one block
BLOCK = FAN ** TIER
GROUP_BITS = 16          # ids of one bitmap: 65,536
ARRAY = 4096             # up to this many ids a bitmap is stored as a list of 16-bit numbers
FLUSH = 1 << 18          # rows packed into bitmaps at once
HOT = 1 << 18            # rows of one bitmap beyond which it is dealt to ``SALTS`` tasks
SALTS = 64
PIECE = 1 << 14

PART_SCHEMA = "src string, grp long, bits binary, extra binary"
MERGED_SCHEMA = "src string, grp long, total long, bits binary, extra binary"
EXTRA = np.dtype([("low", "<u2"), ("n", "<i8")])


# -- leaves --------------------------------------------------------------------

def field(c: Column) -> Column:
    v = c.cast("string")
    return F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaves(docs: DataFrame) -> DataFrame:
    """src, doc_id, leaf, forged (the leaf of the tampered row, null if it is not tampered with)."""
    def digest(text: Column) -> Column:
        return F.unhex(F.sha2(F.concat(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text)), 256))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    forged = F.when(even, digest(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    return docs.select(_src(F.col("source")).alias("src"), F.col("doc_id").cast("long").alias("doc_id"),
                       digest(F.col("text")).alias("leaf"), forged.alias("forged"))


def _src(source: Column) -> Column:
    """The source as a key without nulls, in the same order: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


# -- bitmaps and ranks ------------------------------------------------------------

def _packed(low: np.ndarray) -> bytes:
    """Ascending 16-bit numbers as a compressed bitmap: a list, or 8,192 bytes deflated."""
    if len(low) <= ARRAY:
        return b"a" + low.astype("<u2").tobytes()
    bits = np.zeros(1 << GROUP_BITS, np.uint8)
    bits[low] = 1
    return b"b" + zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    if data[:1] == b"a":
        return np.frombuffer(data, "<u2", offset=1)
    bits = np.frombuffer(zlib.decompress(data[1:]), np.uint8)
    return np.flatnonzero(np.unpackbits(bits, bitorder="little"))


def _counted(low: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    more = n > 1
    extra = np.empty(int(more.sum()), EXTRA)
    extra["low"], extra["n"] = low[more], n[more] - 1
    return _packed(low), extra.tobytes()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _partial_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("src", pa.string()), ("grp", pa.int64()), ("bits", pa.binary()), ("extra", pa.binary())])

    def flush(tables: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(tables)
        src = table.column("src").combine_chunks().dictionary_encode()
        ids = table.column("doc_id").to_numpy()
        s = src.indices.to_numpy()
        order = np.lexsort((ids, s))
        s, ids = s[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (ids[1:] != ids[:-1])]))
        n = np.diff(np.append(first, len(ids)))
        s, grp, low = s[first], ids[first] >> GROUP_BITS, ids[first] & ((1 << GROUP_BITS) - 1)
        starts = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (grp[1:] != grp[:-1])]))
        ends = np.append(starts[1:], len(s))
        names = src.dictionary.to_pylist()
        out = [(names[s[a]], int(grp[a]), *_counted(low[a:b], n[a:b])) for a, b in zip(starts, ends, strict=True)]
        for i in range(0, len(out), PIECE):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[i:i + PIECE], strict=True), schema.types, strict=True)],
                                             schema=schema)
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size >= FLUSH:
            yield from flush(held)
            held, size = [], 0
    if held:
        yield from flush(held)


def _merge_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bitmaps of one (source, group) arrive one after the other and are counted into one array."""
    for (src, grp), rows in groupby(_rows(batches), lambda r: r[:2]):
        n = np.zeros(1 << GROUP_BITS, np.int64)
        for *_, bits, extra in rows:
            n[_unpacked(bits)] += 1
            more = np.frombuffer(extra, EXTRA)
            n[more["low"]] += more["n"]
        low = np.flatnonzero(n)
        bits, extra = _counted(low, n[low])
        yield pa.RecordBatch.from_arrays([pa.array([src]), pa.array([grp], pa.int64()), pa.array([int(n.sum())], pa.int64()),
                                          pa.array([bits], pa.binary()), pa.array([extra], pa.binary())],
                                         ["src", "grp", "total", "bits", "extra"])


def bitmaps(rows: DataFrame) -> DataFrame:
    """src, grp, total, bits, extra: one merged bitmap per source and group of ids (null ids left out)."""
    parts = rows.where("doc_id is not null").select("src", "doc_id").mapInArrow(_partial_bitmaps, PART_SCHEMA)
    return parts.repartition("src", "grp").sortWithinPartitions("src", "grp").mapInArrow(_merge_bitmaps, MERGED_SCHEMA)


def directory(maps: DataFrame, nulls: DataFrame) -> DataFrame:
    """``maps`` with ``start`` (rows of the source with smaller ids, null ids
    included) and ``n`` (all rows of the source). Sums over at most 65,536 entries each."""
    def before(keys: list[str], order: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("total").over(w), F.lit(0))
    up = maps.select("src", "grp", "total", F.shiftright("grp", 16).alias("g1"), F.shiftright("grp", 32).alias("g2"))
    first = up.groupBy("src", "g2", "g1").agg(F.sum("total").alias("total"))
    second = first.groupBy("src", "g2").agg(F.sum("total").alias("total"))
    third = (second.groupBy("src").agg(F.sum("total").alias("n")).join(nulls, "src", "left")
             .select("src", (F.col("n") + F.coalesce("n_null", F.lit(0))).alias("n"), F.coalesce("n_null", F.lit(0)).alias("s3")))
    starts = up.select("src", "grp", "g1", "g2", before(["src", "g1"], "grp").alias("s0"))
    starts = starts.join(first.select("src", "g1", before(["src", "g2"], "g1").alias("s1")), ["src", "g1"])
    starts = starts.join(second.select("src", "g2", before(["src"], "g2").alias("s2")), ["src", "g2"]).join(third, "src")
    return starts.select("src", "grp", (F.col("s0") + F.col("s1") + F.col("s2") + F.col("s3")).alias("start"), "n")


class Ranks:
    """Rank queries on one merged bitmap: a popcount directory over 64-bit words."""

    def __init__(self, bits: bytes, extra: bytes):
        flags = np.zeros(1 << GROUP_BITS, np.uint8)
        flags[_unpacked(bits)] = 1
        self.words = np.packbits(flags, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))])
        more = np.frombuffer(extra, EXTRA)
        self.low, self.n = more["low"], more["n"]
        self.sums = np.concatenate([[0], np.cumsum(self.n)])

    def rank(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows with smaller ids, and rows with the same id, for each id."""
        below = self.words[low >> 6] & ((np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1))
        at = np.searchsorted(self.low, low)
        rank = self.before[low >> 6] + np.bitwise_count(below).astype(np.int64) + self.sums[at]
        same = np.ones(len(low), np.int64)
        hit = at < len(self.low)
        hit[hit] = self.low[at[hit]] == low[hit]
        same[hit] += self.n[at[hit]]
        return rank, same


RANKED_SCHEMA = "src string, doc_id long, leaf binary, forged binary, idx long, same long, n long"


def _rank_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (source, group, salt): the bitmap comes first, then the leaves that ask for their rank."""
    names = [f.split()[0] for f in RANKED_SCHEMA.split(", ")]
    types = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    for (src, _, _), rows in groupby(_rows(batches), lambda r: r[:3]):
        *_, start, n, bits, extra = next(rows)
        ranks = Ranks(bits, extra)
        while piece := list(islice(rows, PIECE)):
            ids, leaf, forged = (list(c) for c in list(zip(*piece, strict=True))[4:7])
            at, same = ranks.rank(np.array(ids, np.int64) & ((1 << GROUP_BITS) - 1))
            k = len(piece)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                ([src] * k, ids, leaf, forged, at + start, same, [n] * k), types, strict=True)], names)


def coordinates(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """src, doc_id, leaf, forged, idx (place in the source), n (leaves of the source)."""
    nulls = rows.where("doc_id is null").groupBy("src").agg(F.count(F.lit(1)).alias("n_null"))
    maps = scratch.written(bitmaps(rows), "merkle-bitmaps")
    dirs = scratch.written(directory(maps, nulls), "merkle-directory")
    # more than 65,536 rows in a group of ids: some repeat; HOT bounds the number of such groups
    hot = maps.where(F.col("total") > HOT).select("src", "grp", F.lit(SALTS).alias("salts"))
    grp = F.shiftright("doc_id", GROUP_BITS)
    asked = (rows.where("doc_id is not null").withColumn("grp", grp).join(F.broadcast(hot), ["src", "grp"], "left")
             .select("src", "grp", F.pmod(F.xxhash64("leaf"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"),
                     F.lit(1).alias("kind"), "doc_id", "leaf", "forged", F.lit(None).cast("long").alias("start"),
                     F.lit(None).cast("long").alias("n"), F.lit(None).cast("binary").alias("bits"),
                     F.lit(None).cast("binary").alias("extra")))
    salts = F.explode(F.sequence(F.lit(0), F.when(F.col("total") > HOT, SALTS - 1).otherwise(0)))
    answers = maps.join(dirs, ["src", "grp"]).select(
        "src", "grp", salts.alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("leaf"), F.lit(None).cast("binary").alias("forged"), "start", "n", "bits", "extra")
    met = answers.unionByName(asked).repartition("src", "grp", "salt").sortWithinPartitions("src", "grp", "salt", "kind")
    ranked = scratch.written(met.mapInArrow(_rank_rows, RANKED_SCHEMA), "merkle-ranked")
    out = ranked.where("same = 1").drop("same")
    sources = dirs.select("src", "n").distinct()
    unnumbered = (rows.where("doc_id is null").join(sources.unionByName(
        nulls.join(sources, "src", "left_anti").select("src", F.col("n_null").alias("n"))), "src")
        .select("src", "doc_id", "leaf", "forged", F.lit(0).cast("long").alias("idx"), "n"))
    return out.unionByName(_place_ties(ranked.where("same > 1").drop("same").unionByName(unnumbered), scratch))


def _place_ties(tied: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows that share an id, placed by their leaf. Counts are summed per first two
    bytes of the leaf, then per leaf and salt, so that no id or leaf fills a window."""
    key = ["src", "idx"]  # rows of one id share the rank of that id
    rows = tied.withColumn("b", F.substring("leaf", 1, 2)).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.written(rows.withColumn("salt", F.col("row") % 1024), "merkle-ties")

    def before(w) -> Column:
        return F.coalesce(F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = rows.groupBy(*key, "b", "leaf", "salt").agg(F.count(F.lit(1)).alias("c"))
    inner = counts.select(*key, "b", "leaf", "salt", before(Window.partitionBy(*key, "b").orderBy("leaf", "salt")).alias("p1"))
    outer = counts.groupBy(*key, "b").agg(F.sum("c").alias("c"))
    outer = outer.select(*key, "b", before(Window.partitionBy(*key).orderBy("b")).alias("p0"))
    place = F.row_number().over(Window.partitionBy(*key, "b", "leaf", "salt").orderBy("row")) - 1
    placed = rows.withColumn("p2", place).join(inner, [*key, "b", "leaf", "salt"]).join(outer, [*key, "b"])
    return placed.select("src", "doc_id", "leaf", "forged", (F.col("idx") + F.col("p0") + F.col("p1") + F.col("p2")).alias("idx"), "n")


# -- levels ----------------------------------------------------------------------

def _hash(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def levels(n: int) -> int:
    """Levels that reduce ``n`` nodes to one."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def _reduced(slots: list[bytes], n: int) -> list[list[bytes]]:
    """The nodes of a block, level by level, for a tier of ``n`` nodes (hashes as hex text)."""
    out = [slots]
    for _ in range(min(TIER, levels(n))):
        last = out[-1]
        out.append([_hash(b"".join(last[i:i + FAN])) for i in range(0, len(last), FAN)])
    return out


def _slots(rows: list[tuple], at: int, digest: int) -> list[bytes]:
    """Nodes of a block placed by index, whatever the order they come in."""
    slots: list[bytes] = [b""] * len(rows)
    for r in rows:
        slots[r[at] % BLOCK] = bytes(r[digest]).hex().encode()
    return slots


NODE_SCHEMA = "src string, idx long, node binary, n long"


def _reduce_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for (src, block), rows in groupby(_rows(batches), lambda r: r[:2]):
        rows = list(rows)  # src, block, idx, node, n: at most BLOCK rows
        n = rows[0][4]
        top = _reduced(_slots(rows, 2, 3), n)[-1][0]
        out.append((src, block, bytes.fromhex(top.decode()), -(-n // BLOCK)))
        if len(out) == PIECE:
            yield _nodes(out)
            out = []
    if out:
        yield _nodes(out)


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.binary(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                      ["src", "idx", "node", "n"])


def _tiers(nodes: DataFrame, scratch: Scratch) -> list[DataFrame]:
    """``nodes`` (src, idx, node, n) and the tiers above them; a source is in all up to its single node."""
    out, block = [nodes], F.expr(f"idx div {BLOCK}")
    while out[-1].where("n > 1").limit(1).count():
        below = out[-1].where("n > 1").select("src", block.alias("block"), "idx", "node", "n")
        up = below.repartition("src", "block").sortWithinPartitions("src", "block").mapInArrow(_reduce_blocks, NODE_SCHEMA)
        out.append(scratch.written(up, "merkle-tier"))
    return out


def _path_of(inner: list[list[bytes]], slot: int) -> list[tuple[bytes, bytes]]:
    """Siblings on the left and on the right, level by level inside a block."""
    path = []
    for nodes in inner[:-1]:
        first = slot - slot % FAN
        path.append((b"".join(nodes[first:slot]), b"".join(nodes[slot + 1:first + FAN])))
        slot //= FAN
    return path


def _text(path: list[tuple[bytes, bytes]]) -> bytes:
    return b"".join(left + b"|" + right + b";" for left, right in path)


def _path(text: bytes) -> list[tuple[bytes, bytes]]:
    return [tuple(x.split(b"|")) for x in bytes(text).split(b";")[:-1]]


def proof(path: list[tuple[bytes, bytes]]) -> bytes:
    return _hash(b"".join(left + right for left, right in path))


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in path:
        leaf = _hash(left + leaf + right)
    return leaf


PATH_SCHEMA = "src string, idx long, path binary, subroot string"
PROOF_SCHEMA = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def _descend(final: bool):
    """Blocks with their parent's path (which comes first): paths of their nodes, or the proofs of the leaves."""
    names = [f.split()[0] for f in (PROOF_SCHEMA if final else PATH_SCHEMA).split(", ")]
    types = ([pa.int64()] + [pa.string()] * 4) if final else [pa.string(), pa.int64(), pa.binary(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (src, _), rows in groupby(_rows(batches), lambda r: r[:2]):
            rows = list(rows)  # src, block, kind, idx, node, n, doc_id, forged, path, subroot: a path and at most BLOCK nodes
            above, subroot = _path(rows[0][8]), rows[0][9]
            rows = rows[1:]
            inner = _reduced(_slots(rows, 3, 4), rows[0][5])
            for r in rows:
                slot = r[3] % BLOCK
                path = _path_of(inner, slot) + above
                if final:
                    held = inner[0][slot] if r[7] is None else bytes(r[7]).hex().encode()
                    out.append((r[6], inner[0][slot].decode(), subroot, proof(path).decode(), fold(held, path).decode()))
                else:
                    out.append((src, r[3], _text(path), subroot))
            if len(out) >= 2048:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
    return run


def _paths(tier: DataFrame, above: DataFrame, single: DataFrame, final: bool) -> DataFrame:
    """Paths (or proofs) of a tier's nodes. ``above``: paths of the tier above;
    ``single`` (src, path, subroot): those of the sources with one node here."""
    none = {"doc_id": "long", "forged": "binary"}
    nodes = tier if "forged" in tier.columns else tier.select("*", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    block = F.expr(f"idx div {BLOCK}")
    below = nodes.select("src", block.alias("block"), F.lit(1).alias("kind"), "idx", "node", "n", "doc_id", "forged",
                         F.lit(None).cast("binary").alias("path"), F.lit(None).cast("string").alias("subroot"))
    alone = nodes.where("n = 1").select("src").join(single, "src").select("src", F.lit(0).cast("long").alias("idx"), "path", "subroot")
    parents = above.unionByName(alone) if above is not None else alone
    parents = parents.select("src", F.col("idx").alias("block"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("idx"),
                             F.lit(None).cast("binary").alias("node"), F.lit(None).cast("long").alias("n"),
                             F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("forged"), "path", "subroot")
    met = parents.unionByName(below).repartition("src", "block").sortWithinPartitions("src", "block", "kind")
    return met.mapInArrow(_descend(final), PROOF_SCHEMA if final else PATH_SCHEMA)


def _descended(tiers: list[DataFrame], single: DataFrame, scratch: Scratch, final: bool) -> DataFrame:
    above = None
    for i in reversed(range(len(tiers))):
        last = final and i == 0
        above = _paths(tiers[i], above, single, last)
        above = above if last else scratch.written(above, "merkle-paths")
    return above


def _ordered_sources(subroots: DataFrame, scratch: Scratch) -> DataFrame:
    """Subroots as nodes of one tree, in order of their sources: one global sort, places from the sizes of its ranges."""
    held = scratch.written(subroots.orderBy("src").withColumn("row", F.monotonically_increasing_id()), "merkle-sources")
    part = F.shiftright("row", 33)
    sizes = held.groupBy(part.alias("part")).count().orderBy("part").collect()  # one row per range
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["part"], total))
        total += r["count"]
    starts = held.sparkSession.createDataFrame(offsets, "part long, offset long")
    idx = F.col("offset") + F.col("row") % F.lit(1 << 33)
    return scratch.written(held.withColumn("part", part).join(F.broadcast(starts), "part").select(
        F.lit("").alias("src"), idx.alias("idx"), "node", F.lit(total).cast("long").alias("n"), F.col("src").alias("of")),
        "merkle-source-nodes")


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    rows = scratch.written(leaves(docs), "merkle-leaves")
    placed = scratch.written(coordinates(rows, scratch).withColumnRenamed("leaf", "node"), "merkle-placed")
    tiers = _tiers(placed, scratch)
    subroots = tiers[0].where("n = 1").select("src", "node")
    for t in tiers[1:]:
        subroots = subroots.unionByName(t.where("n = 1").select("src", "node"))
    of_source = _ordered_sources(subroots, scratch)
    top = _tiers(of_source.drop("of"), scratch)
    found = top[-1].where("n = 1").select(F.lower(F.hex("node"))).first()
    if found is None:  # an empty table
        return spark.createDataFrame([], PROOF_SCHEMA).select("doc_id", "leaf", "subroot", F.lit("").alias("root"), "proof_sha256",
                                                              "folded_root", F.lit(True).alias("verified"))
    root = found[0]
    crown = spark.createDataFrame([("", bytearray(), root)], "src string, path binary, subroot string")
    paths = _descended(top, crown, scratch, False)  # of each source's subroot
    single = of_source.select("idx", F.col("of").alias("src"), F.lower(F.hex("node")).alias("subroot")).join(paths.select("idx", "path"), "idx")
    out = _descended(tiers, scratch.written(single.select("src", "path", "subroot"), "merkle-crowns"), scratch, True)
    return out.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.lit(root)).alias("verified"))
