"""N-gram Jaccard self-join by rare-first prefix filtering.

A document is the set of its distinct word shingles (64-bit hashes). Two link
when ``100 * intersection >= percent * union``. The result keeps every such
link as connectivity; pairs within a group are never all written out.

1. *Order.* All documents count their shingles into ``SLOTS`` hashed counters
   (a fixed 8 MB table after log scaling, so its broadcast does not grow). A shingle's place in
   the order is (counter, hash), so shared passages come last. The order is
   the same for all documents, which is all that correctness asks of it.
2. *Classes.* Documents with one set are one class, represented by a text of its smallest id.
   Classes go by that id, or by numbers in its order where classes share an id.
3. *Prefix filter.* Of n shingles in order, the first n - ceil(t n) + ``COMMON``
   are emitted; two linked sets share ``COMMON`` of them at least. Those that one class
   has alone are dropped.
4. *Stars.* The smallest class of a shared prefix shingle is its pivot. Each
   class is verified against the pivot it meets most often, and the links found are
   merged into components. This finds most links of a large group with one pair per class.
5. *Rest.* Prefix shingles that still meet two components are joined, between different components only,
   with the length filter, the shorter index prefix for the smaller set and the
   positional filter. Pairs that meet in ``COMMON`` shingles and pass the suffix filter (a lower bound of
   the difference of two sets from their counts in eight hash ranges) are verified once, on the full
   sets. As pairs inside a component add no connectivity, no link between different texts is lost.
6. Components over all links of classes; each document gets the smallest id of its component.

Defined cases: null or blank text has no shingles and links with nothing; rows
that repeat an id are each placed by their own text, so that components may
share their smallest id but not their documents; a null id links with
nothing and has a null component; ties in the order fall to the hash; long
texts count whole; an empty table gives an empty result. Only the id and text
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ratelens.llm import counters, kernels as K
from ratelens.llm.common import Scratch, written
from ratelens.llm.components import components

SLOTS = 1 << 22
PARTS, COMMON = 8, 3


def _counters(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        for batch in K.slices(batches):
            sets = list(K.shingle_sets(K.doc_bytes(batch.column("text")), width))
            if sets:
                np.add.at(counts, (np.concatenate(sets) & np.uint64(SLOTS - 1)).astype(np.int64), np.uint32(1))
        yield counters.chunks(counts)
    return run


def _log_scaled(v: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1.0 + v) * 1024, 65535).astype(np.uint16)


def shingle_frequencies(docs: DataFrame, width: int) -> np.ndarray:
    """Log-scaled hashed counters over all documents: SLOTS 16-bit values."""
    return counters.total(docs.select("text").mapInArrow(_counters(width), counters.SCHEMA), SLOTS, _log_scaled, np.uint16)


def _part_counts(s: np.ndarray) -> int:
    """Counts of the eight hash ranges, modulo 256, in one 64-bit value."""
    bounds = np.arange(1, PARTS, dtype=np.uint64) << np.uint64(61)
    c = np.diff(np.concatenate(([0], np.searchsorted(s, bounds), [len(s)]))) % 256
    return int.from_bytes(c.astype(np.uint8).tobytes(), "little", signed=True)


def _prefixes(freq, width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = freq.value
        for batch in K.slices(batches):
            n, digest, parts, prefix = [], [], [], []
            for s in K.shingle_sets(K.doc_bytes(batch.column("text")), width):
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                parts.append(_part_counts(s))
                if not linkable(len(s), percent):
                    prefix.append(np.empty(0, np.int64))
                    continue
                order = np.argsort(table[(s & np.uint64(SLOTS - 1)).astype(np.int64)], kind="stable")
                prefix.append(s[order[: len(s) - -(-percent * len(s) // 100) + COMMON]].view(np.int64))
            offsets = np.cumsum([0] + [len(p) for p in prefix]).astype(np.int32)
            values = np.concatenate(prefix) if prefix else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int32()), pa.array(digest, pa.binary()), pa.array(parts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))],
                ["doc_id", "key", "n", "digest", "parts", "prefix"])
    return run


def linkable(n: int, percent: int) -> bool:
    """Can a set of n link with a different one? Its closest is n + 1 or n - 1."""
    return n > 0 and 100 * n >= percent * (n + 1)


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in K.slices(batches):
            sets = [s.view(np.int64) for s in K.shingle_sets(K.doc_bytes(batch.column("text")), width)]
            offsets = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            values = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))],
                ["node", "shingles"])
    return run


def _sets_of(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """(node, shingles) of all nodes of the pairs, from their own texts, once each. The
    join is a merge at every size, as what is wanted grows with the corpus."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = scratch.written(nodes.select("node", "doc_id", "key").join(wanted, "node", "left_semi"), "wanted-sets")
    chosen = docs.hint("merge").join(texts, ["doc_id", "key"]).select("node", "text")
    sets = scratch.written(chosen.mapInArrow(_sets(width), "node long, shingles array<long>"), "shingle-sets")
    if sets.count() > texts.count():  # rows that repeat an id and a text
        sets = scratch.written(sets.dropDuplicates(["node"]), "distinct-sets")
    return sets


def _suffix_bound(x: Column, y: Column) -> Column:
    """Least size of the difference of two sets, from their part counts."""
    total = F.lit(0)
    for k in range(PARTS):
        d = F.abs(F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(255)) - F.shiftrightunsigned(y, 8 * k).bitwiseAND(F.lit(255)))
        total = total + F.least(d, F.lit(256) - d)
    return total


def _fewest(n: Column, m: Column, percent: int) -> Column:
    """Fewest common shingles of two linked sets of n and m."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent) - F.lit(1e-9))


def _sizes_fit(n: Column, m: Column, xparts: Column, yparts: Column, percent: int) -> Column:
    """Length and suffix filter."""
    return ((F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m))
            & (_suffix_bound(xparts, yparts) <= n + m - 2 * _fewest(n, m, percent)))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    return (joined.select("a", "b", (F.size("sa") + F.size("sb")).alias("total"), both.alias("common"))
            .where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("total") - F.col("common"))).select("a", "b"))


def _text_key(text: Column) -> Column:
    """What tells apart the texts of one id."""
    return F.xxhash64(text)


def _placed(docs: DataFrame, width: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, key of its text, n, component (a number of its own), component_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), _text_key(F.col(text_col)).alias("key"))
    freq = spark.sparkContext.broadcast(shingle_frequencies(docs, width))
    rows = written(docs.mapInArrow(_prefixes(freq, width, percent),
                                   "doc_id long, key long, n int, digest binary, parts long, prefix array<long>"), "shingle-prefixes")
    scratch = Scratch(spark)
    some = rows.where("n > 0 and doc_id is not null")
    classes = some.groupBy("digest", "n", "parts", "prefix").agg(F.min("doc_id").alias("node"))
    # the same classes without their prefixes, which their digests stand for
    nodes = scratch.written(some.groupBy("digest", "n", "parts").agg(F.min("doc_id").alias("doc_id"), F.min_by("key", "doc_id").alias("key")), "shingle-classes")
    if nodes.groupBy("doc_id").count().where("count > 1").limit(1).count():
        # classes share an id: numbers in the order of the ids, the same for every reader once written
        nodes = scratch.written(nodes.orderBy("doc_id", "key").withColumn("node", F.monotonically_increasing_id()), "numbered-classes")
        classes = classes.drop("node").join(nodes.select("digest", "node"), "digest")
    else:
        nodes = nodes.withColumn("node", F.col("doc_id"))

    tokens = classes.select("node", "n", "parts", F.posexplode("prefix").alias("pos", "token"))
    shared = (tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("pivot"))
              .where("c > 1").select("token", "pivot"))
    met = scratch.written(tokens.join(shared, "token"), "shared-prefix-shingles")

    sizes = nodes.select(F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("parts").alias("pivot_parts"))
    meetings = (met.where("node != pivot").groupBy("node", "n", "parts", "pivot").agg(F.count(F.lit(1)).alias("c"))
                .where(F.col("c") >= F.least(F.lit(COMMON), _fewest(F.col("n"), F.col("n"), percent)))
                .join(sizes, "pivot").where(_sizes_fit(F.col("n"), F.col("m"), F.col("parts"), F.col("pivot_parts"), percent)))
    star_pairs = scratch.written(meetings.groupBy("node").agg(F.max_by("pivot", F.struct("c", -F.col("pivot"))).alias("pivot"))
                         .select(F.col("node").alias("a"), F.col("pivot").alias("b")), "stars")
    star_links = scratch.written(_verified(star_pairs, _sets_of(docs, star_pairs, nodes, width, scratch), percent), "star-links")
    merged = components(star_links)

    placed = (met.select("token", "node", "n", "pos", "parts").join(merged, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    open_tokens = (placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .where("lo != hi").select("token"))
    rest = scratch.written(placed.join(open_tokens, "token", "left_semi"), "open-prefix-shingles")
    x = rest.select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "pos", "parts", "component")])
    y = rest.select("token", *[F.col(c).alias(f"y_{c}") for c in ("node", "n", "pos", "parts", "component")])
    xn, yn = F.col("x_n"), F.col("y_n")
    index = yn - F.ceil(F.lit(2 * percent) * yn / F.lit(100 + percent) - F.lit(1e-9)) + COMMON
    # shingles still to come, if this is the last of the first COMMON they share
    most = COMMON - 1 + F.least(xn - F.col("x_pos"), yn - F.col("y_pos"))
    pairs = (x.join(y, "token")
             .where((F.col("x_component") != F.col("y_component"))
                    & ((xn > yn) | ((xn == yn) & (F.col("x_node") > F.col("y_node"))))
                    & (F.lit(100) * yn >= F.lit(percent) * xn) & (F.col("y_pos") < index) & (most >= _fewest(xn, yn, percent)))
             .groupBy(F.col("x_node").alias("a"), F.col("y_node").alias("b"), "x_n", "y_n", "x_parts", "y_parts")
             .agg(F.count(F.lit(1)).alias("c"))
             .where((F.col("c") >= F.least(F.lit(COMMON), _fewest(xn, yn, percent)))
                    & _sizes_fit(xn, yn, F.col("x_parts"), F.col("y_parts"), percent)).select("a", "b").distinct())
    pairs = scratch.written(pairs, "rest-pairs")
    links = star_links.unionByName(_verified(pairs, _sets_of(docs, pairs, nodes, width, scratch), percent))
    final = components(links)
    linked = nodes.select("node", "doc_id").join(final, "node")
    least = linked.groupBy("component").agg(F.min("doc_id").alias("least"))
    member = written(nodes.select("digest", "node", "doc_id").join(final.join(least, "component"), "node", "left").select(
        F.col("digest").alias("d"), F.coalesce("component", "node").alias("component"), F.coalesce("least", "doc_id").alias("component_id")), "members")
    scratch.clear()

    out = rows.join(member, (rows["digest"] == member["d"]) & (rows["n"] > 0) & rows["doc_id"].isNotNull(), "left")
    return out.select("doc_id", "key", "n", "component", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def link_components(docs: DataFrame, width: int = 3, percent: int = 90,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    return _placed(docs, width, percent, id_col, text_col).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (columns unchanged) that are the smallest id of their component, decided
    by id and text: of several texts of that id in one component, one stays."""
    placed = _placed(docs, width, percent)
    heads = placed.where("component is not null and component_id = doc_id")
    torn = heads.groupBy("component").agg(F.min("key").alias("keep"), F.max("key").alias("last")).where("keep != last")
    dropped = (placed.where("component_id != doc_id").select("doc_id", "key")
               .unionByName(heads.join(torn, "component").where("key != keep").select("doc_id", "key")))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names of the caller cannot clash
    doc_id, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    same = (doc_id == F.col("doc_id")) & (_text_key(text) == F.col("key"))
    return plain.join(dropped, same, "left_anti").toDF(*docs.columns)
