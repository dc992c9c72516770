"""BPE encoding and decoding with a contiguous rank array.

A word is held as its part boundaries and the merge ranks of adjacent parts.
The smallest rank is found by a scan (the leftmost of equals), its boundary is
deleted and the ranks to either side are refreshed, until no pair may merge.
That is quadratic, and fast for short words; a word of more than ``LONG`` characters takes the same merges
from a heap instead. Words met before come from a bounded cache.

The vocabulary file is one of the public ``tokenizers`` files of the
word kind: special tokens split the raw text, then NFC, one blank for blanks,
lower case, a split into words, and bytes shown as letters, the last with the
word-end mark. Texts of Latin letters and ASCII are prepared by a plain pattern;
any other text is prepared by the file's own normaliser and splitter, as their
Unicode tables decide there. Merging and decoding are always done here. Decoding
joins the tokens with one space, as a file without a decoder does.

Defined cases: null text is empty and gives no ids and an empty text; repeated
rows and ids are each encoded; a null id stays null; texts are encoded whole; an empty
table gives an empty result. Only the id and text columns are read, so
further columns cannot clash.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
LONG = 128                # characters from which merges come from a heap
CACHE_CHARS = 1 << 25     # size of the cached words a worker holds at most: about 250 MB

# Fixed value: the splitting pattern of the file, for Latin letters.
PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+")
UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]")
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The letter that shows each byte: itself where it prints, else the next free one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordCache(dict):
    """Ids by word, merged when first asked for, in two generations: when the
    young one holds half of ``CACHE_CHARS`` it becomes the old one, and words
    asked for again come back from there."""

    def __init__(self, merge, shown: list[str] | None):
        super().__init__()
        self.merge, self.shown, self.held, self.old = merge, shown, 0, {}

    def __missing__(self, word: str) -> list[int]:
        ids = self.old.get(word)
        if ids is None:
            ids = self.merge("".join([self.shown[b] for b in word.encode()]) if self.shown else word)
        self.held += len(word) + 8 * len(ids)
        if 2 * self.held > CACHE_CHARS:
            self.old, self.held = self.copy(), len(word)
            self.clear()
        self[word] = ids
        return ids


class RankBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.tokens = [""] * (1 + max([*self.vocab.values(), *self.special.values()]))
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        exact = Tokenizer.from_file(path)
        self.normalizer, self.splitter = exact.normalizer, exact.pre_tokenizer
        self.plain = WordCache(self.merge, byte_letters())  # by word as it stands in the text
        self.shown = WordCache(self.merge, None)            # by word of shown bytes

    def merge(self, word: str) -> list[int]:
        """Ids of one word of shown bytes."""
        if len(word) > LONG:
            return self.merge_long(word)
        get, vocab = self.rank.get, self.vocab
        n, w = len(word), word + self.end
        cuts = [*range(n), len(w)]  # part i is w[cuts[i]:cuts[i + 1]]
        ranks = [get(pair, NEVER) for pair in zip(word, word[1:-1], strict=False)]
        if n > 1:
            ranks.append(get((w[n - 2], w[n - 1:]), NEVER))
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            del cuts[i + 1], ranks[i]
            a, z = cuts[i], cuts[i + 1]
            if i < len(ranks):
                ranks[i] = get((w[a:z], w[z:cuts[i + 2]]), NEVER)
            if i:
                ranks[i - 1] = get((w[cuts[i - 1]:a], w[a:z]), NEVER)
        return [vocab[w[a:z]] for a, z in zip(cuts, cuts[1:], strict=False)]

    def merge_long(self, word: str) -> list[int]:
        """The same merges from a heap of (rank, place), stale entries skipped."""
        n = len(word)
        parts: list[str | None] = [*word[:-1], word[-1] + self.end]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := self.rank.get((parts[i], parts[i + 1]), NEVER)) < NEVER]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or self.rank.get((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (x := self.rank.get((parts[i], parts[after[i]]), NEVER)) < NEVER:
                    heapq.heappush(heap, (x, i))
            if before[i] >= 0 and (x := self.rank.get((parts[before[i]], parts[i]), NEVER)) < NEVER:
                heapq.heappush(heap, (x, before[i]))
        return [self.vocab[p] for p in parts if p is not None]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for segment in self.special_split.split(text):
            if segment in self.special:
                out.append(self.special[segment])
            elif UNUSUAL.search(segment):
                words = [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(segment))]
                out.extend(chain.from_iterable(map(self.shown.__getitem__, words)))
            elif segment:
                words = PLAIN_WORD.findall(unicodedata.normalize("NFC", segment).lower())
                out.extend(chain.from_iterable(map(self.plain.__getitem__, words)))
        return out

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


@lru_cache(maxsize=2)
def codec(path: str = TOKENIZER) -> RankBpe:
    return RankBpe(path)


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            docs, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            for a in range(0, len(texts), 256):  # ids and decoded texts of few rows at a time
                ids = [bpe.encode(t or "") for t in texts[a:a + 256]]
                yield pa.RecordBatch.from_arrays(
                    [docs[a:a + 256], pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([np.array(x, "<u4").tobytes() for x in ids], pa.binary()),
                     pa.array([bpe.decode(x) for x in ids], pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"])
    return run


def encode_documents(docs: DataFrame, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded (text)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encoded(tokenizer), "doc_id long, n_tokens long, ids binary, decoded string")


def digest_columns(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
