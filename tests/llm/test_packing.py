import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ratelens.llm import byte_bpe, packing

TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(text, end):
    return [*TOK.encode(text or "", add_special_tokens=False).ids, end]


def check(rows, pieces, window, end=0):
    by_seq, by_doc = {}, {}
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert len(ids) == p.length > 0
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append((p.start, ids, p.doc_tokens))
    padding = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    want = {}
    for k, t in rows:
        want.setdefault(k, []).append(expected(t, end))
    assert set(by_doc) == set(want)
    for k, texts in want.items():
        if len(texts) == 1:
            got = sorted(by_doc[k])
            assert sum((ids for _, ids, _ in got), []) == texts[0]
            assert [s for s, _, _ in got] == list(np.cumsum([0] + [len(i) for _, i, _ in got])[:-1])
            assert {n for _, _, n in got} == {len(texts[0])}
        else:
            assert sum(len(i) for _, i, _ in by_doc[k]) == sum(map(len, texts))
    return padding


ODD = [(1, None), (2, ""), (3, " "), (4, "x" * 5000), (None, "null id"), (6, "<|endoftext|> inside"),
       (7, "日本 Ωmega \x1c  ١٢ ǅ"), (8, "twice"), (8, "twice"), (9, "don't  stop\n\n now' s")]


@pytest.mark.parametrize("window", [16, 1024])
def test_every_id_in_one_piece_without_padding(spark, window):
    rows = ODD + [(100 + i, "word " * (i * 7 % 400)) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert check(rows, packing.pack(df, window=window).collect(), window) == 0


def test_small_open_bound_and_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in df.collect()]
    assert check(rows, packing.pack(df, max_open=3).collect(), 1024) == 0


@pytest.mark.parametrize("blank", [" ", "\n", "\t", "\r\n", "\xa0"])
def test_long_runs_of_blanks(blank):
    for text in ("a" + blank * (1_200_000 // len(blank)) + "word", blank * 1_100_000, ("x" + blank * 99_999) * 3):
        assert byte_bpe.encoder().ids(text).tolist() == TOK.encode(text, add_special_tokens=False).ids


def test_document_with_a_long_run_is_packed(spark):
    rows = [(1, "before"), (2, "a" + " " * 1_200_000 + "word"), (3, "after")]
    assert check(rows, packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect(), 1024) == 0


def test_level_choice_equals_brute_force():
    rng = random.Random(3)
    p = packing.SumOfSquares(window=32, max_open=10**6)
    for i in range(400):
        size = rng.randrange(1, 32)
        counts = p.level.copy()

        def squares(h):
            c = counts.copy()
            if h:
                c[h] -= 1
            if h + size < 32:
                c[h + size] += 1
            return int((c[:32] ** 2).sum())

        allowed = [0] + [h for h in range(1, 33 - size) if counts[h]]
        best = min(squares(h) for h in allowed)
        assert p.best_level(size) == max(h for h in allowed if squares(h) == best)
        p.place((i, 0, np.zeros(size, np.uint32), size))


def test_digest_columns_empty_table_and_further_columns(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(1, "a b", 5, "z")], "doc_id long, text string, start int, ids string")
    row = packing.digest_columns(packing.pack(df)).collect()
    ids = expected("a b", 0)
    assert sum(r.length for r in row) == len(ids)
    assert {r.ids_crc32 for r in row if r.length == len(ids)} <= {zlib.crc32(np.array(ids, "<u4").tobytes())}
