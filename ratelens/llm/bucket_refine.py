"""Removal of repeated byte strings by bucket-pointer refinement.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else. Suffixes are kept in buckets of equal beginnings; a bucket has an
identifier, and buckets of a doubled length come from sorting on the pair
(identifier here, identifier at the later offset): 25-gram identifiers give
those of 50 bytes, they those of 100, and they those of 200, each round reusing
what the one before has named. An identifier is a fingerprint of the bucket's
common beginning, so that tasks name buckets alike and need not look one up.
A bucket of one suffix leaves at once.

To carry few suffixes, only *samples* enter the first buckets: of the 101
100-grams in a 200-byte window the one with the least identifier (the leftmost
of equals), which depends on the window alone, so equal windows have samples at
equal places. A sample stands for the run of windows that chose it, and for
the bytes they cover, its *context*.

1. Texts: copies become one row with a count.
2. Samples are sorted by (100-byte identifier, identifier of the context, from
   its first and last 200 bytes). A bucket of one leaves. Samples with equal
   contexts are repeated with all their windows, one of them stays as partner.
3. Where a bucket holds several contexts, one sample of each carries its
   context (300 bytes at most) to the bucket, whose windows are refined to 200
   bytes there. Windows in buckets of two or more are repeated.
4. Ranges of repeated windows meet their text, which is cut once.

Identifiers that decide have two lanes of 64 bits. What crosses the network:
texts three times (copies once), one row of five numbers per sample (2 % of all
positions), contexts of contested samples, ranges.

Hot buckets: identifiers held by more than ``HOT`` samples and by more than one
in ``MOST`` (counted over all) number ``MOST`` at most and are broadcast. Their
samples are dealt by context; contexts that are as frequent are answered from a
list with the same bound; and their windows are counted by a partial aggregate
instead of in one task.

Defined cases: null text is empty; texts shorter than 200 bytes keep all.
Repeated rows and copies under any id (null included) repeat each other, so
of 200 bytes or more nothing is left. Long texts are cut into slices that
overlap, so every window is seen whole. An empty table gives an empty result.
Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratelens.llm.common import Scratch
from ratelens.llm.kernels import BYTE_VALUE, mix, powers

LENGTH = 200              # bytes of a repeated string
GRAM = 100                # bytes of a first bucket's beginning
FIRST = 25                # bytes of the q-grams that start the naming
CHOICES = LENGTH - GRAM + 1
SLICE = 1 << 20           # bytes named at once
HOT = 20_000              # samples of a bucket beyond which it may be dealt out
MOST = 1_000_000          # buckets dealt out at most
LANES = (BYTE_VALUE, mix(BYTE_VALUE ^ np.uint64(0xA5A5A5A55A5A5A5A)))
ODD = np.uint64(0xD6E8FEB86659FD93)
PLACE_BITS = np.uint64(21)  # places in a slice and its last overlap

SAMPLE_SCHEMA = "gram long, context long, key long, at long, span int, many boolean"
FOUND_SCHEMA = "key long, at long, span int, repeated boolean, partner boolean, wanted boolean, hot boolean"
CONTEXT_SCHEMA = "gram long, key long, at long, wanted boolean, hot boolean, bytes binary"
RANGE_SCHEMA = "key long, at long, span int"
CUT_SCHEMA = "key long, n_removed long, n_spans long, kept_sha256 string"


def _bar(total: int) -> int:
    """Rows beyond which a key counts as hot: at most ``MOST`` keys have more."""
    return max(HOT, total // MOST)


# -- identifiers ------------------------------------------------------------------

def _pair(ids: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of the doubled length from those here and at the later offset."""
    return mix(ids * ODD + later)


def first_names(buf: np.ndarray, lane: int) -> np.ndarray:
    """The identifier of the q-gram at every place (fewer by FIRST - 1)."""
    n = len(buf)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(LANES[lane][buf] * up[:n], out=sums[1:])
    return mix((sums[FIRST:] - sums[:-FIRST]) * down[:n - FIRST + 1])


def refine(names: np.ndarray, length: int, to: int) -> np.ndarray:
    """Identifiers of ``length`` bytes at every place, refined by doubling to ``to`` bytes."""
    while length < to:
        names = _pair(names[:-length], names[length:])
        length *= 2
    return names


def _names_at(first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifiers of LENGTH bytes at some places only, by the same rounds."""
    names = [first[at + k * FIRST] for k in range(LENGTH // FIRST)]
    while len(names) > 1:
        names = [_pair(a, b) for a, b in zip(names[::2], names[1::2], strict=True)]
    return names[0]


# -- samples --------------------------------------------------------------------

def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[tuple]]]:
    """Runs of about ``SLICE`` bytes: the bytes and (key, many, offset in the text, start, end) of
    each segment; a longer text comes in slices that overlap by LENGTH - 1 bytes."""
    held: list[np.ndarray] = []
    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for key, many, text in zip(batch.column("key").to_pylist(), batch.column("many").to_pylist(), batch.column("text"), strict=True):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            for off in range(0, max(1, len(data) - LENGTH + 1), SLICE - LENGTH + 1):
                part = data[off:off + SLICE]
                if len(part) < LENGTH:
                    continue
                if size + len(part) > SLICE and held:
                    yield np.concatenate(held), rows
                    held, rows, size = [], [], 0
                rows.append((key, many, off, size, size + len(part)))
                held.append(part)
                size += len(part)
    if held:
        yield np.concatenate(held), rows


def samples(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """For the segments [start, end) of ``buf``: (segment, sample, first window, last window) of each sample,
    and the identifiers of its 100-gram and of its context."""
    one, two = first_names(buf, 0), first_names(buf, 1)
    grams = refine(one, FIRST, GRAM)
    least = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= CHOICES:  # least of ever wider ranges, then of two that overlap
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = CHOICES - width
    least = np.minimum(least[:-rest], least[rest:]) if rest else least
    windows = ends - starts - LENGTH + 1
    window = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    segment = np.repeat(np.arange(len(starts)), windows)
    chosen = (least[window] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.append(first[1:], len(chosen)) - 1
    a, b = window[first], window[last]
    context = mix(_pair(_names_at(two, a), _names_at(two, b)) + (b - a).astype(np.uint64))
    return segment[first], chosen[first], a, b, grams[chosen[first]], context


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for buf, rows in _segments(batches):
        key, many, off, start, end = (np.array(c) for c in zip(*rows, strict=True))
        segment, _, a, b, gram, context = samples(buf, start, end)
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(key[segment], pa.int64()),
             pa.array(off[segment] + a - start[segment], pa.int64()), pa.array(b - a, pa.int32()), pa.array(many[segment])],
            ["gram", "context", "key", "at", "span", "many"])


# -- first refinement: equal contexts ----------------------------------------------

def _runs(change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run number of each row, and the size of each run, from the flags where one begins."""
    run = np.cumsum(change) - 1
    return run, np.bincount(run)


def _sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by (gram, deal, context); whole runs of (gram, deal) are judged at once."""
    held = None

    def judged(t: pa.Table) -> pa.RecordBatch:
        gram, deal, context = (t.column(c).to_numpy() for c in ("gram", "deal", "context"))
        many = t.column("many").to_numpy(zero_copy_only=False)
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (deal[1:] != deal[:-1])])
        fresh = new | np.concatenate([[True], context[1:] != context[:-1]])
        (bucket, _), (group, size) = _runs(new), _runs(fresh)
        contexts = np.bincount(bucket[fresh])[bucket]
        repeated = (size[group] > 1) | many
        contested = (contexts > 1) | (deal != 0)
        partner = contested & fresh
        keep = partner | (repeated & ~many)
        columns = {"key": t.column("key"), "at": t.column("at"), "span": t.column("span"), "repeated": pa.array(repeated & ~many),
                   "partner": pa.array(partner), "wanted": pa.array(partner & ~repeated), "hot": pa.array(deal != 0), "gram": t.column("gram")}
        return pa.table(columns).filter(pa.array(keep)).combine_chunks()

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        gram, deal = held.column("gram").to_numpy(), held.column("deal").to_numpy()
        border = np.flatnonzero((gram[1:] != gram[:-1]) | (deal[1:] != deal[:-1]))
        if len(border):
            cut = int(border[-1]) + 1
            yield from judged(held.slice(0, cut)).to_batches()
            held = held.slice(cut).combine_chunks()
    if held is not None:
        yield from judged(held).to_batches()


# -- second refinement: contested windows -------------------------------------------

def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes under the windows of each contested sample of a text."""
    for batch in batches:
        for key, text, asked in zip(*[batch.column(c) for c in ("key", "text", "asked")], strict=True):
            data, rows = memoryview(text.as_buffer()), asked.as_py()
            for i in range(0, len(rows), 4096):
                part = rows[i:i + 4096]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["gram"] for r in part], pa.int64()), pa.array([key.as_py()] * len(part), pa.int64()),
                     pa.array([r["at"] for r in part], pa.int64()), pa.array([r["wanted"] for r in part]), pa.array([r["hot"] for r in part]),
                     pa.array([bytes(data[r["at"]:r["at"] + r["span"] + LENGTH]) for r in part], pa.binary())],
                    ["gram", "key", "at", "wanted", "hot", "bytes"])


def _windows(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every window of some contexts: its context's number, its place there and its identifiers."""
    buf = np.frombuffer(b"".join(parts), np.uint8)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    count = size - LENGTH + 1
    which = np.repeat(np.arange(len(parts)), count)
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = (np.cumsum(size) - size)[which] + place
    return which, place, *[refine(first_names(buf, lane), FIRST, LENGTH)[at] for lane in (0, 1)]


def _ranges(key: np.ndarray, at: np.ndarray, which: np.ndarray, place: np.ndarray, hit: np.ndarray) -> pa.RecordBatch:
    """Runs of repeated windows of each context as rows (key, at, span)."""
    which, place = which[hit], place[hit]
    first = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (place[1:] != place[:-1] + 1)])) if len(which) else which
    last = np.append(first[1:], len(which)) - 1 if len(which) else which
    return pa.RecordBatch.from_arrays([pa.array(key[which[first]], pa.int64()), pa.array(at[which[first]] + place[first], pa.int64()),
                                       pa.array(place[last] - place[first], pa.int32())], ["key", "at", "span"])


def _refine_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts arrive sorted by gram; whole buckets are refined together, about ``SLICE`` bytes at once."""
    def judged(t: pa.Table) -> pa.RecordBatch:
        which, place, one, two = _windows([bytes(x.as_buffer()) for x in t.column("bytes")])
        order = np.lexsort((two, one))
        change = np.concatenate([[True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])])
        run, size = _runs(change)
        hit = np.zeros(len(which), bool)
        hit[order] = size[run] > 1
        wanted = t.column("wanted").to_numpy(zero_copy_only=False)
        return _ranges(t.column("key").to_numpy(), t.column("at").to_numpy(), which, place, hit & wanted[which])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.nbytes < SLICE:
            continue
        gram = held.column("gram").to_numpy()
        border = np.flatnonzero(gram[1:] != gram[:-1])
        if len(border):
            cut = int(border[-1]) + 1
            yield judged(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None:
        yield judged(held)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each window of hot buckets as a row of its own: identifiers, key, place."""
    for batch in batches:
        for i in range(0, batch.num_rows, 2048):
            t = batch.slice(i, 2048)
            which, place, one, two = _windows([bytes(x.as_buffer()) for x in t.column("bytes")])
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(t.column("key").to_numpy()[which], pa.int64()),
                 pa.array(t.column("at").to_numpy()[which] + place, pa.int64()),
                 pa.array(t.column("wanted").to_numpy(zero_copy_only=False)[which])], ["one", "two", "key", "at", "wanted"])


def _hot_windows(contexts: DataFrame, scratch: Scratch) -> DataFrame:
    """Repeated windows of hot buckets: windows counted by partial aggregates; the
    hottest identifiers (a bounded list) are broadcast, the others joined."""
    rows = scratch.written(contexts.mapInArrow(_window_rows, "one long, two long, key long, at long, wanted boolean"), "hot-windows")
    by = ["one", "two"]
    counts = scratch.written(rows.groupBy(*by).count().where("count > 1"), "hot-counts")
    bar = _bar(rows.count())
    hottest = F.broadcast(counts.where(F.col("count") > bar).select(*by))
    wanted = rows.where("wanted")
    hits = wanted.join(hottest, by, "left_semi").unionByName(
        wanted.join(hottest, by, "left_anti").join(counts.where(F.col("count") <= bar).select(*by).hint("merge"), by, "left_semi"))
    return hits.select("key", "at", F.lit(0).alias("span"))


# -- cutting --------------------------------------------------------------------

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for key, text, ranges in zip(*[batch.column(c) for c in ("key", "text", "ranges")], strict=True):
            data = memoryview(text.as_buffer())
            at = ranges.values.field("at").to_numpy(zero_copy_only=False)
            end = at + ranges.values.field("span").to_numpy(zero_copy_only=False) + LENGTH
            order = np.argsort(at, kind="stable")
            at, reach = at[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], at[1:] > reach[:-1]])
            begin, stop = at[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
            digest, last = hashlib.sha256(), 0
            for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
                digest.update(data[last:a])
                last = b
            digest.update(data[last:])
            out.append((key.as_py(), int((stop - begin).sum()), len(begin), digest.hexdigest()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["key", "n_removed", "n_spans", "kept_sha256"])


# -- the whole -------------------------------------------------------------------

def distinct_texts(rows: DataFrame) -> DataFrame:
    """key, digest, n, size, text: one row per text, however many rows hold it."""
    one = rows.groupBy("digest").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("n"))
    return one.select(F.monotonically_increasing_id().alias("key"), "digest", "n",
                      F.octet_length("text").cast("long").alias("size"), "text")


def repeated_ranges(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """key, at, span: windows [at, at + span] of the single texts that start elsewhere too."""
    source = texts.where(F.col("size") >= LENGTH).select("key", (F.col("n") > 1).alias("many"), "text")
    sampled = Scratch(texts.sparkSession)
    rows = sampled.written(source.mapInArrow(_sample_rows, SAMPLE_SCHEMA), "samples")
    bar = _bar(rows.count())
    hot = scratch.written(rows.groupBy("gram").count().where(F.col("count") > bar).select("gram"), "hot-grams")
    dealt = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "gram", "left")
    # a hot context of a hot bucket: known from a bounded list, its first sample stays as partner
    same = (rows.join(F.broadcast(hot), "gram", "left_semi").groupBy("gram", "context")
            .agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "at")).alias("first")).where(F.col("c") > bar))
    same = scratch.written(same.select("gram", "context", "first"), "hot-contexts")
    dealt = dealt.join(F.broadcast(same), ["gram", "context"], "left")
    dealt = dealt.withColumn("hot", F.coalesce("hot", F.lit(False)))
    known = dealt.where("first is not null").select(
        "key", "at", "span", (~F.col("many")).alias("repeated"), F.col("first").eqNullSafe(F.struct("key", "at")).alias("partner"),
        F.lit(False).alias("wanted"), F.lit(True).alias("hot"), "gram").where("repeated or partner")
    deal = F.when(F.col("hot"), F.pmod(F.col("context"), F.lit(1 << 20)) + 1).otherwise(0)
    open_ = dealt.where("first is null").select("gram", deal.alias("deal"), "context", "key", "at", "span", "many")
    found = (open_.repartition("gram", "deal").sortWithinPartitions("gram", "deal", "context")
             .mapInArrow(_sort_out, FOUND_SCHEMA + ", gram long"))
    found = scratch.written(found.unionByName(known), "samples-found")
    sampled.clear()
    asked = (found.where("partner").groupBy("key")
             .agg(F.collect_list(F.struct("gram", "at", "span", "wanted", "hot")).alias("asked")))
    contexts = texts.select("key", "text").join(asked, "key").mapInArrow(_contexts, CONTEXT_SCHEMA)
    contexts = scratch.written(contexts, "contexts")
    cold = (contexts.where("not hot").repartition("gram").sortWithinPartitions("gram").mapInArrow(_refine_windows, RANGE_SCHEMA))
    ranges = found.where("repeated").select("key", "at", "span").unionByName(cold)
    if hot.limit(1).count():
        ranges = ranges.unionByName(_hot_windows(contexts.where("hot"), scratch))
    return scratch.written(ranges, "repeated-ranges")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    texts = scratch.written(distinct_texts(rows), "texts")
    ranges = repeated_ranges(texts, scratch).groupBy("key").agg(F.collect_list(F.struct("at", "span")).alias("ranges"))
    cut = texts.where("n = 1").select("key", "text").join(ranges, "key").mapInArrow(_cut, CUT_SCHEMA)
    copies = (F.col("n") > 1) & (F.col("size") >= LENGTH)
    nothing = F.sha2(F.lit(""), 256)
    done = texts.select("key", "digest", "n", "size").join(cut, "key", "left").select(
        "digest", "n", F.col("size").alias("n_bytes"),
        F.when(copies, F.col("size")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copies, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copies, nothing).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"))
    done = scratch.written(done, "cut-texts")
    ids = scratch.written(rows.select("doc_id", "digest"), "text-ids")
    scratch.clear(keep=2)  # the result reads these two
    # the most frequent copies are a bounded list, broadcast; all others meet by digest
    bar = _bar(ids.count())
    often = F.broadcast(done.where(F.col("n") > bar))
    rare = ids.join(often.select("digest"), "digest", "left_anti").join(done.where(F.col("n") <= bar).hint("merge"), "digest")
    return ids.join(often, "digest").unionByName(rare).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
