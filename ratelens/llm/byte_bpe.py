"""Ids of the public byte-level BPE vocabulary, one encoder per worker.

The rank file holds the vocabulary of the ``tokenizers`` file; its encoder
gives the same ids several times faster. It is used for texts made of Latin
letters, ASCII and common punctuation, where both libraries split alike
whatever Unicode version they carry; any other text goes through ``tokenizers`` itself.
So does a text with a long run of blanks: the other library's pattern
fails on a run of more than about a million.
"""

from __future__ import annotations

import base64
import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e¡-¬®-ɏ‐-‧‰-⁞€]")
LONG_RUN = 100_000
BLANK_RUN = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")  # tried once a run


class Encoder:
    def __init__(self, tokenizer: str, ranks: str):
        import tiktoken
        self.tokenizer = tokenizer
        with open(tokenizer, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        with open(ranks, "rb") as f:
            merged = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merged,
                                      special_tokens=special)

    @cached_property
    def exact(self):
        """The ``tokenizers`` encoder, loaded when a text first needs it."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        exact = Tokenizer.from_file(self.tokenizer)
        exact.no_truncation()
        exact.no_padding()
        return exact

    def ids(self, text: str | None) -> np.ndarray:
        """All ids of a text as unsigned 32-bit integers; null is empty."""
        if not text:
            return np.empty(0, np.uint32)
        if UNUSUAL.search(text) or len(text) >= LONG_RUN and BLANK_RUN.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all").astype(np.uint32)


@lru_cache(maxsize=2)
def encoder(tokenizer: str = TOKENIZER, ranks: str = RANKS) -> Encoder:
    return Encoder(tokenizer, ranks)
